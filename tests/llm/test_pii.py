"""Base spans against plain regular expressions, and spans found by context."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from leadmill.llm import pii

# The patterns as they are stated.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _want(text):
    spans = sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(STATED.items())
        for m in re.finditer(pattern, text or "")
        if _good(kind, m[0])
    )
    said = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
    counts = tuple(sum(s[3] == kind for s in spans) for kind in STATED)
    return counts, hashlib.sha256(said.encode()).hexdigest(), said


def _texts():
    chance = random.Random(8)
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "255.256.1.1", "4111 1111 1111 1111", "-", " ", "+", "1"]
    pieces += ["+1 (202) 555-0100", "00", "x_y%z", "a.b@c-d.e.f", "..", "é😀", "4111-1111-1111-1112"]
    pieces += ["\n", "()", "99999", "b@c", "001.002.003.0255", "1.1.1.1.1.1.1.1"]
    texts = ["".join(chance.choices(pieces, k=chance.randint(1, 14))) for _ in range(400)]
    return texts + [None, "", "a@b.c_d@e.f@g.h", "no personal data here", texts[0]]


def test_base_spans_equal_plain_patterns(documents):
    texts = _texts()
    ids = [*range(len(texts) - 2), None, 3]
    rows = pii.digest(pii.find_personal_data(documents(texts, ids), rounds=1, support=10**6)).collect()
    got = sorted(
        (str(r.doc_id), (r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256, r.spans)
        for r in rows
    )
    assert got == sorted((str(i), *_want(t)) for i, t in zip(ids, texts, strict=True))


@pytest.mark.parametrize("unit", ["1.", "a.", "1 ", "a", "1", "+1", "@a.", "1-", "(at)", "a@"])
def test_very_long_runs(documents, unit):
    text = "x@y." + unit * 20_000 + "z +1 202 555 0100"
    (row,) = pii.digest(pii.find_personal_data(documents([text]))).collect()
    assert (row.base_sha256,) == (_want(text)[1],)


def test_context_finds_unseen_spellings(documents, by_id):
    texts = [f"Please mail to: user{n}@site{n}.com for {n} more" for n in range(30)]
    texts += [f"my card number 4111 1111 1111 1111 item {n}" for n in range(3)]
    texts += ["Please mail to: jane (at) example (dot) org for 7 more"]
    texts += ["He was at (at) home (dot) com once", "version 12 34 56 78 is out"]
    found = by_id(pii.digest(pii.find_personal_data(documents(texts))))
    row = found[33]
    start = texts[33].index("jane")
    assert row.n_added == 1 and row.spans == f"email:{start}:{start + len('jane (at) example (dot) org')}"
    assert row.n_email == 0
    assert all(found[n].n_added == 0 for n in found if n != 33)


def test_many_candidates_do_not_hide_a_pattern(documents, by_id):
    texts = [f"mail to: user{n}@site{n}.com now" for n in range(30)]
    texts += [f"mail to: u{n} (at) s{n} (dot) org now" for n in range(30)]
    found = by_id(pii.digest(pii.find_personal_data(documents(texts))))
    assert [found[n].n_added for n in range(60)] == [0] * 30 + [1] * 30


def test_later_rounds_build_on_earlier_ones(documents, by_id):
    texts = [f"mail to: user{n}@site{n}.com now" for n in range(9)]
    known = [f"u{n} (at) s{n} (dot) org" for n in range(9)]
    # The same spellings after words that only three seeds, too few alone, were seen after.
    texts += [f"mail to: {x} now" for x in known] + [f"reach us by {x} soon" for x in known]
    texts += [f"reach us by a{n}@b{n}.net soon" for n in range(3)]
    texts += ["reach us by zoe (at) far (dot) org soon"]
    docs = documents(texts)
    once, more = (
        by_id(pii.digest(pii.find_personal_data(docs, rounds=rounds)))[30].n_added
        for rounds in (1, 3)
    )
    assert (once, more) == (0, 1)


def test_empty_table(documents):
    assert pii.find_personal_data(documents([])).collect() == []


def test_no_python_in_the_plan(documents):
    found = pii.digest(pii.find_personal_data(documents(["a@b.c"])))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_tens_of_thousands_of_matches_in_one_text(spark):
    """Places are right and the work does not grow with the square of the matches."""
    parts = [f"n{n % 7} 10.0.{n % 256}.{n % 251}," for n in range(40_000)]
    text = " ".join(parts)
    start = time.monotonic()
    rows = spark.createDataFrame([(1, text), (2, "no"), (3, None)], "doc_id long, text string")
    found = {row["doc_id"]: row for row in pii.find_personal_data(rows).collect()}
    assert time.monotonic() - start < 150
    spans = [(m.start(), m.end()) for m in re.finditer(r"10\.0\.\d+\.\d+", text)]
    ips = [(s["start"], s["end"]) for s in found[1]["base"] if s["kind"] == "ip"]
    assert ips == spans
    assert found[2]["base"] == [] and found[3]["base"] == []
