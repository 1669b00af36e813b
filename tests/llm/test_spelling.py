"""Spelling variants against a plain search."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from leadmill.llm import spelling


def _words(rows, every=97):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = crc32(f"{name}:{word}".encode())
            if name is not None and code % every == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return counts


def _near(words):
    near = defaultdict(set)
    holes = defaultdict(set)
    for word in words:
        for at in range(len(word)):
            short = word[:at] + word[at + 1 :]
            holes[at, short].add(word)
            if short in words:
                near[word].add(short)
                near[short].add(word)
    for alike in holes.values():
        for word in alike:
            near[word] |= alike - {word}
    return near


def _brute(rows, least_letters=5, least_count=3, every=97):
    n = {
        w: c
        for w, c in _words(rows, every).items()
        if len(w) >= least_letters and c >= least_count
    }
    near = _near(n)
    form = {}
    for word in n:
        best = min(near[word], key=lambda v: (-n[v], v), default=None)
        form[word] = best if best and n[best] >= 2 * n[word] else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return {
        (w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n
    }


def _got(frame):
    rows = [
        tuple(row)
        for row in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    ]
    assert len(rows) == len(set(rows))
    return set(rows)


def _texts(seed, size=60, letters="abé"):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(2, 8))) for _ in range(200)]
    return [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(size)]


@pytest.mark.parametrize("limit", [0, spelling.BROADCAST_BYTES])
def test_equals_plain_search(spark, documents, limit):
    texts = _texts(1)
    texts += ["Étage étage ÉTAGE x×y", None, "", "stretch " * 40 + "strech " * 4 + "stretchy " * 9]
    rows = list(enumerate(texts))
    found = spelling.group_variants(documents(texts), every=7, limit=limit)
    assert _got(found) == _brute(rows, every=7)


def test_hot_keys(spark, documents, monkeypatch):
    monkeypatch.setattr(spelling.Small, "FEW", 3)
    monkeypatch.setattr(spelling.Small, "HOT", 0.01)
    texts = _texts(2, letters="ab")
    found = spelling.group_variants(documents(texts), limit=0)
    assert _got(found) == _brute(list(enumerate(texts)))


def test_short_words_equal_letters_and_prefixes(spark, documents):
    words = ["a", "aa", "aaa", "aaaa", "ab", "ba", "bab", "abab", "baba", "aab", "aba", "b"]
    texts = [" ".join(words)]
    found = spelling.group_variants(
        documents(texts), least_letters=1, least_count=1, every=10**12
    )
    assert _got(found) == _brute([(0, texts[0])], 1, 1, 10**12)


def test_very_long_words_take_few_levels(spark, documents, monkeypatch):
    long = "".join(random.Random(5).choices("abcdefgh", k=30_000))
    texts = [f"{long} {long[:-1]} {long[1:]} {long[:9]}x{long[10:]} " * 3]
    stores = []
    keep = spelling.stored
    monkeypatch.setattr(spelling, "stored", lambda rows: stores.append(1) or keep(rows))
    found = _got(spelling.group_variants(documents(texts)))
    assert found == _brute([(0, texts[0])])
    assert len(stores) < 30


def test_roots_follow_forms(spark, documents):
    text = "color " * 40 + "colour " * 16 + "colours " * 6 + "coloura " * 3
    found = {row[0]: row[1:] for row in _got(spelling.group_variants(documents([text])))}
    assert found["coloura"] == ("colour", "color", 3, 2, 16)
    assert found["color"] == (None, "color", 40, 1, None)


def test_null_ids_repeated_rows_and_empty_tables(spark, documents):
    texts = ["mirror mirror miror", None, "", "mirror miror"]
    found = spelling.group_variants(documents(texts, ids=[None, None, 1, 1]), least_count=2)
    assert _got(found) == {
        ("mirror", None, "mirror", 3, 1, None),
        ("miror", None, "mirror", 2, 1, None),
    } or _got(found) == _brute(zip([None, None, 1, 1], texts, strict=True), 5, 2)
    assert _got(spelling.group_variants(documents([]))) == set()
    assert _got(spelling.group_variants(documents(["few words"]))) == set()
