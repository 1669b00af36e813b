"""Entropy balancing against a plain solution."""

from __future__ import annotations

import math
import random

import pytest

from leadmill.llm import mixing


def _targets(sizes, weights=(5, 2, 1), most=3):
    """Shares dealt out again and again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        goal = {
            s: most * sizes[s] if s in capped else left * weight[s] / open_weight for s in names
        }
        above = {s for s in names if s not in capped and goal[s] > most * sizes[s]}
        if not above:
            return goal
        capped |= above


def _rows(texts, sources):
    sizes = {}
    for text, source in zip(texts, sources, strict=True):
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    return sizes


@pytest.mark.parametrize("slice_rows", [20, 50_000])
def test_targets_and_words_taken(documents, slice_rows):
    chance = random.Random(6)
    sources = [chance.choice(["a", "b", "c", "d", "é", None, "hot", "hot", "hot"]) for _ in range(900)]
    sources[:3] = ["tiny"] * 3
    texts = ["w " * int(chance.lognormvariate(3, 1)) for _ in sources]
    texts[5], texts[6], texts[7] = None, "", " \t "
    docs = documents(texts, sources=sources)
    rows = mixing.mix(docs, slice_rows=slice_rows).collect()
    sizes = _rows(texts, sources)
    goals = _targets(sizes)
    assert len(rows) == len(texts)
    longest = max(r["size"] for r in rows)
    taken = {}
    for r in rows:
        source = sources[r.doc_id]
        assert r["size"] == len((texts[r.doc_id] or "").split())
        assert r.source_size == sizes[source]
        assert math.isclose(r.target, goals[source], rel_tol=1e-9)
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= 0.02 * goal + longest / 2, source
    again = mixing.mix(docs, slice_rows=slice_rows).collect()
    assert sorted(again) == sorted(rows)


def test_rates_follow_the_tilt(spark):
    counts = [("a", n, 10) for n in range(1, 40)] + [("b", 5, 7), ("c", 9, 1), ("d", 0, 4)]
    frame = spark.createDataFrame(counts, "source STRING, size LONG, docs LONG")
    whole = {s: sum(n * d for t, n, d in counts if t == s) for s in "abcd"}
    goals = [("a", whole["a"] * 1.7), ("b", whole["b"] * 0.2), ("c", whole["c"] * 3.0), ("d", 0.0)]
    goals = spark.createDataFrame(goals, "source STRING, target DOUBLE")
    tilts = {r.source: r for r in mixing.balance(frame, goals).collect()}
    for source, ratio in (("a", 1.7), ("b", 0.2), ("c", 3.0)):
        t = tilts[source]
        words = sum(
            d * n * min(3, math.exp(t.tilt * n / t["mean"])) for s, n, d in counts if s == source
        )
        assert math.isclose(words, ratio * whole[source], rel_tol=1e-8)


def test_documents_of_the_mix(documents):
    texts = ["a b c", "d e f", "g h i", None, "", "a b c"] * 4
    sources = ["x", "y", "z", "x", "y", None] * 4
    docs = documents(texts, sources=sources)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    found = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == docs.columns
    assert sorted(found) == sorted(i for i, n in copies.items() for _ in range(n))


def test_empty_and_wordless_tables(documents):
    assert mixing.mix(documents([])).collect() == []
    rows = mixing.mix(documents([None, "", None], [None, 1, 1], sources=["a", None, "a"])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 3


def test_a_single_source_takes_everything_once(documents):
    rows = mixing.mix(documents(["a b", "c", "d e f"])).collect()
    assert all(r.taken == r["size"] for r in rows)


def test_rows_that_share_ids_and_words_keep_their_own_copies(documents):
    texts = ["a b c d"] * 220 + ["one two three", "one two three", None]
    ids = [None] * 220 + [5, 5, 5]
    docs = documents(texts, ids, sources=["x"] * 20 + ["y"] * 200 + ["z", "x", None])
    taken = {}
    for row in mixing.mix(docs, row_column="source").collect():
        taken[row["row"]] = taken.get(row["row"], 0) + row.taken
    found = {}
    for row in mixing.mixed_documents(docs).collect():
        found[row.source] = found.get(row.source, 0) + len((row.text or "").split())
    assert taken["x"] > 100 and taken["y"] < 700
    assert found == taken
