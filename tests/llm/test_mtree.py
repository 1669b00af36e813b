"""Top-k inner products against all products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from leadmill.llm import mtree


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, v INT, subtree INT")


def _brute(rows, k, every):
    good = {
        (i, tuple(math.floor(64 * float(np.float32(x))) for x in v))
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = set()
    for q, a in good:
        if q % every == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q
            )
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def _got(frame):
    return {tuple(row) for row in frame.select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("subtree_rows", [16, 8192])
def test_equals_all_products(spark, subtree_rows):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(150, 6)).round(1).tolist()
    rows = [(i, v, 0, 0) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], 0, 0) for i in range(60)]  # many equal vectors
    rows += [(5, vectors[5], 0, 0), (200, [0.0] * 6, 0, 0)]
    found = mtree.top_products(_table(spark, rows), 7, 10, subtree_rows=subtree_rows)
    assert _got(found) == _brute(rows, 7, 10)


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0], 0, 0),
        (1, None, 0, 0),
        (2, [1.0, None], 0, 0),
        (3, [float("nan"), 1.0], 0, 0),
        (4, [float("inf"), 1.0], 0, 0),
        (None, [9.0, 9.0], 0, 0),
        (6, [-0.01], 0, 0),
        (7, [], 0, 0),
    ]
    assert _got(mtree.top_products(_table(spark, rows), 20, 20)) == {
        (0, 1, 7, 0),
        (0, 2, 6, -64),
    }


def test_empty_table(spark):
    assert mtree.top_products(_table(spark, [])).collect() == []


def test_bounds_leave_out_far_pages():
    random = np.random.default_rng(2)
    centres = random.normal(size=(20, 8)) * 100
    points = np.concatenate([c + random.normal(size=(50, 8)) for c in centres])
    points = np.floor(points)
    square = float((points**2).sum(axis=1).max())
    tree = mtree.Subtree(points[0], np.arange(1000), points, square, page_rows=50)
    scores, ids = tree.search(-1, points[3], 5, -np.inf)
    want = np.lexsort((np.arange(1000), -(points @ points[3])))[:5]
    assert ids.tolist() == want.tolist() and tree.computed < 1000
