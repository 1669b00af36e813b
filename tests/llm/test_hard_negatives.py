"""Hard negatives against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import hard_negatives as h

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, id INT, vec INT, row INT, key INT"


def _table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], SCHEMA)


def _label(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def _brute(rows, every):
    good = {}
    for i, v, label in rows:
        if i is None or v is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (_label(i, label), [math.floor(256 * float(np.float32(x))) for x in v])
        good[i] = min(good.get(i, row), row)
    out = set()
    for a, (label, vec) in good.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vec, other, strict=False)), i, own)
            for i, (own, other) in good.items()
            if i != a
        )
        for ps, p, _ in [row for row in scored if row[2] == label][:5]:
            fits = [
                row for row in scored if row[2] != label and -80 * ps <= -100 * row[0] <= -100 * ps
            ]
            out |= {(a, p, n + 1, i, -ps, -s) for n, (s, i, _) in enumerate(fits[:5])}
    return out


def _got(frame):
    rows = [tuple(row) for row in frame.select(*[c.split()[0] for c in h.COLUMNS.split(", ")]).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_all_pairs(spark):
    random = np.random.default_rng(3)
    centre = random.normal(size=6)
    vectors = (random.normal(size=(300, 6)) * 0.4 + centre).round(1).tolist()
    rows = [(i, v, int(random.integers(0, 4))) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], i % 2) for i in range(80)]  # ties
    rows += [(20, vectors[3], 1), (20, vectors[3], 1), (-10, vectors[1], 2)]
    want = _brute(rows, 10)
    assert want
    found = h.mine_labelled(_table(spark, rows), every=10)
    assert _got(found) == want


def test_several_waves_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(h, "ROWS", 7)
    monkeypatch.setattr(h, "ANCHORS", 3)
    random = np.random.default_rng(4)
    vectors = random.normal(size=(120, 4)).round(1).tolist()
    rows = [(i, v, int(random.integers(0, 3))) for i, v in enumerate(vectors)]
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    found = h.mine(_table(spark, rows), F.col("vec_id") % 5 == 0, label, wave=9)
    assert _got(found) == _brute(rows, 5)


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 1.0], 1),
        (1, [1.0, 1.0], 2),  # the label of anchor 0 is 2
        (2, [0.9, 0.9], 5),
        (3, None, 5),
        (4, [1.0, 0.8], None),
        (5, [float("nan"), 1.0], 5),
        (6, [float("inf"), 1.0], 5),
        (8, [1.0, None], 5),
        (None, [1.0, 0.9], 5),
        (9, [1.9], 5),  # as if filled up with zeros
        (10, [], 5),
    ]
    want = _brute(rows, 100)
    assert {row[3] for row in want} == {2, 9}
    assert _got(h.mine_labelled(_table(spark, rows))) == want


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(100, [1.0], 1)], [(0, [0.0], 1), (2, [0.0], 2)]])
def test_without_anchors_or_positives(spark, rows):
    assert _got(h.mine_labelled(_table(spark, rows))) == set()


def test_scores_below_zero_open_no_window(spark):
    rows = [(0, [1.0], 1), (1, [-1.0], 2), (2, [-1.0], 3)]
    assert _got(h.mine_labelled(_table(spark, rows))) == set() == _brute(rows, 100)


def test_keys_sort_by_anchor_score_kind_and_id():
    pairs = [(-5, 9, 1, 3), (-5, 2, 0, 1), (-5, 2, 0, 7), (-5, 2, 1, -9), (4, -3, 0, 0), (4, -3, 1, 2)]
    keys = [h.pack(*pair) for pair in pairs]
    assert keys == sorted(keys)
    assert [h.unpack(key) for key in keys] == pairs


def test_large_components_stay_exact():
    left = np.array([[2**40, 3], [1, 2]])
    right = np.array([[2**20, 5], [7, -1]])
    assert h.products(left, right).tolist() == [
        [2**60 + 15, 7 * 2**40 - 3],
        [2**20 + 10, 5],
    ]
