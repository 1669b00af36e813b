"""Fingerprints and groups against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from leadmill.llm import simhash
from leadmill.llm.components import components


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 4]) for n in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, ids, radius=4):
    root = list(range(len(prints)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[top(a)] = top(b)
    out = []
    for n in range(len(prints)):
        same = [ids[m] for m in range(len(prints)) if top(m) == top(n) and ids[m] is not None]
        out.append(min(same, default=None))
    return out


def test_equals_plain_version(documents):
    chance = random.Random(5)
    base = [[chance.choice("abcdefgh") * chance.randint(1, 4) for _ in range(60)] for _ in range(6)]
    texts = []
    for words in base:
        for _ in range(6):
            copy = list(words)
            copy[chance.randrange(60)] = "Q"
            texts.append(" ".join(copy))
    texts += [None, "", " \t\n", "one", "ONE", "a b c", "ä Ä x y z", texts[0], "w " * 40_000]
    ids = [*range(len(texts) - 2), None, 3]
    rows = simhash.near_groups(documents(texts, ids)).collect()
    prints = [_print(t) for t in texts]
    groups = _groups(prints, ids)
    want = sorted(
        (str(i), f"{p:016x}", str(g)) for i, p, g in zip(ids, prints, groups, strict=True)
    )
    assert sorted((str(r[0]), r[1], str(r[2])) for r in rows) == want


@pytest.mark.parametrize("block_rows", [50, 100_000])
def test_tiles_lose_no_link(spark, block_rows):
    random_bits = np.random.default_rng(4)
    centres = random_bits.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set()
    for centre in centres:
        for _ in range(8):
            flips = random_bits.choice(64, random_bits.integers(0, 7), replace=False)
            prints.add(int(centre) ^ sum(1 << int(f) for f in flips))
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    points = spark.createDataFrame([(p,) for p in signed], "print LONG")
    roots = {r.node: r.root for r in components(simhash.link_forest(points, 4, block_rows)).collect()}
    got = [roots.get(p, p) for p in signed]
    want = _groups(prints, list(range(len(prints))))
    assert [got.index(x) for x in got] == [want.index(x) for x in want]


def test_forest_of_a_dense_group_is_small():
    prints = np.array([0] + [1 << n for n in range(64)], dtype=np.uint64)
    assert len(simhash.forest(prints, None, 4)) == len(prints) - 1


def test_components_of_chains_and_loops(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 100), (7, None), (200, 201), (201, 200)]
    found = components(spark.createDataFrame(edges, "a LONG, b LONG"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {n: 0 for n in range(41)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_keep_one(documents):
    texts = ["a b c d e", "A b c d e", "other words are in here", "a b c d e", None, ""]
    docs = documents(texts, [3, 2, 5, 2, None, 9])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "5", "9", "None"]
    assert simhash.keep_one(documents([])).count() == 0
