"""Exact top-k inner products by best-first search of M-trees.

Vectors become points of a metric space: with M the largest squared norm, x is
extended by sqrt(M - |x|^2) and a query by 0, so that the squared distance is
|q|^2 + M - 2 q.x and the nearest points have the largest products.

The top level of the tree is laid out over Spark: every vector belongs to the subtree
of its nearest pivot, which has a covering radius. A task holds one subtree as paged
nodes: each page has a routing point, its covering radius and its distance to the
subtree's pivot (the parent distance), and each entry its distance to the page's
routing point. The triangle inequality turns these into lower bounds, so pages and
entries are left out without computing a distance. A query first visits the most
promising subtree; its k-th score there is the bound for all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.llm.shared import mapped, stored

SUBTREE_ROWS = 8192
MAX_SUBTREES = 4096
PAGE_ROWS = 512
QUERY_BLOCK = 4096
#: Slack for rounding in bounds; the scores themselves are exact integers.
SLACK = 1e-6
_EXACT = 2.0**53


def scaled_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v``: components floor(64 x), for vectors of finite components only.

    Rows without id, null vectors and those that hold null, NaN or infinity take no
    part. Repeated rows count once.
    """
    vector = F.col(vector_column)
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return (
        rows.where(F.col(id_column).isNotNull() & vector.isNotNull() & ~bad)
        .select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * 64)).alias("v"),
        )
        .distinct()
    )


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for at, vector in enumerate(vectors):
        out[at, : len(vector)] = vector
    return out


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """As doubles where all products stay exact, else as integers."""
    width = matrices[0].shape[1]
    peak = max((float(np.abs(m).max()) for m in matrices if m.size), default=0.0)
    kind = np.float64 if width * peak * peak < _EXACT else np.int64
    return [m.astype(kind) for m in matrices]


def _lift(points: np.ndarray, square: float) -> np.ndarray:
    """The extra coordinate of each point."""
    norms = (points.astype(np.float64) ** 2).sum(axis=1)
    return np.sqrt(np.maximum(square - norms, 0.0))


class Subtree:
    """Pages of one subtree, and the search in them."""

    def __init__(self, pivot, ids, points, square, page_rows=PAGE_ROWS):
        self.ids, self.points, self.square = ids, points, square
        extra = _lift(points, square)
        full = np.column_stack([points.astype(np.float64), extra])
        top = np.append(pivot.astype(np.float64), _lift(pivot[None], square)[0])
        count = max(1, -(-len(ids) // page_rows))
        # Routing points: an even spread over the distances to the pivot.
        to_pivot = np.sqrt(((full - top) ** 2).sum(axis=1))
        order = np.argsort(to_pivot, kind="stable")
        centres = full[order[np.linspace(0, len(ids) - 1, count).astype(int)]]
        squares = (centres**2).sum(axis=1)
        home = np.empty(len(ids), dtype=np.int64)
        for at in range(0, len(ids), 4096):
            part = full[at : at + 4096]
            home[at : at + 4096] = (squares - 2 * part @ centres.T).argmin(axis=1)
        self.pages = []
        self.centres = []
        for page in range(count):
            inside = np.flatnonzero(home == page)
            if not len(inside):
                continue
            centre = centres[page]
            reach = np.sqrt(((full[inside] - centre) ** 2).sum(axis=1))
            self.pages.append((inside, reach))
            self.centres.append(centre)
        self.centres = np.array(self.centres)
        self.radii = np.array([reach.max() for _, reach in self.pages])
        self.parents = np.sqrt(((self.centres - top) ** 2).sum(axis=1))
        self.top = top
        self.computed = 0

    def search(self, own_id: int, query: np.ndarray, k: int, least: float):
        """The k best (score, id) with scores of at least ``least``."""
        plain = np.append(query.astype(np.float64), 0.0)
        base = float(plain @ plain) + self.square

        def widest(score: float) -> float:
            return np.sqrt(max(base - 2 * score, 0.0)) + SLACK

        to_top = np.sqrt(((plain - self.top) ** 2).sum())
        bound = widest(least) if np.isfinite(least) else np.inf
        # The parent distances alone rule pages out, before their own distances.
        alive = np.flatnonzero(np.abs(to_top - self.parents) - self.radii <= bound)
        near = np.sqrt(((self.centres[alive] - plain) ** 2).sum(axis=1))
        lowest = near - self.radii[alive]
        scores = np.empty(0, dtype=self.points.dtype)
        ids = np.empty(0, dtype=np.int64)
        for at in np.argsort(lowest, kind="stable"):
            if lowest[at] > bound:
                break
            inside, reach = self.pages[alive[at]]
            if np.isfinite(bound):
                inside = inside[np.abs(near[at] - reach) <= bound]
            found = self.points[inside] @ query
            self.computed += len(inside)
            keep = self.ids[inside] != own_id
            if len(scores) == k:
                keep &= found >= scores[-1]
            if not keep.any():
                continue
            scores = np.concatenate([scores, found[keep]])
            ids = np.concatenate([ids, self.ids[inside][keep]])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            if len(scores) == k:
                bound = min(bound, widest(float(scores[-1])))
        return scores, ids


def _visits(pivots: list, radii: list, square: float, width: int, nearest: bool):
    """Which subtrees each query visits: the most promising one, or the others."""
    names = [name for name, _ in pivots]
    centres = _matrix([vector for _, vector in pivots], width).astype(np.float64)
    full = np.column_stack([centres, _lift(centres, square)])
    covers = np.array(radii)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            queries = _matrix(rows["v"], width).astype(np.float64)
            plain = np.column_stack([queries, np.zeros(len(queries))])
            out: dict[str, list] = {name: [] for name in ("subtree", *rows)}
            for at, point in enumerate(plain):
                lowest = np.sqrt(((full - point) ** 2).sum(axis=1)) - covers
                first = int(lowest.argmin())
                if nearest:
                    chosen = [first]
                else:
                    least = rows["least"][at]
                    bound = np.inf
                    if least is not None:
                        base = float(point @ point) + square
                        bound = np.sqrt(max(base - 2 * least, 0.0)) + SLACK
                    chosen = [
                        int(s) for s in np.flatnonzero(lowest <= bound) if s != first
                    ]
                for subtree in chosen:
                    out["subtree"].append(names[subtree])
                    for name in rows:
                        out[name].append(rows[name][at])
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("subtree", pa.int64()), *((f.name, f.type) for f in batch.schema)]
                ),
            )

    return visit


def _search(visits: DataFrame, members: DataFrame, pivots: dict, square, width, k):
    """``query_id, query_key, vec_id, score``: the k best of each visit."""

    def run(key: tuple, asked: pd.DataFrame, inside: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if len(asked) and len(inside):
            points, queries = _exact(
                _matrix(inside["v"].tolist(), width), _matrix(asked["v"].tolist(), width)
            )
            pivot = _matrix([pivots[int(key[0])]], width)[0]
            tree = Subtree(pivot, inside["vec_id"].to_numpy(), points, square)
            bounds = asked["least"].astype(float).to_numpy()
            for at, query in enumerate(queries):
                own = asked["query_id"].iat[at]
                least = bounds[at] if np.isfinite(bounds[at]) else -np.inf
                scores, ids = tree.search(own, query, k, least)
                out["query_id"] += [own] * len(ids)
                out["query_key"] += [asked["query_key"].iat[at]] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += [int(score) for score in scores]
        return pd.DataFrame(out).astype("int64")

    # A subtree with many queries is read once for each block of them.
    counts = visits.groupBy("subtree").agg(
        F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks")
    )
    asked = visits.join(F.broadcast(counts), "subtree").withColumn(
        "block", F.pmod(F.hash("query_id", "query_key"), F.col("blocks"))
    )
    inside = members.join(F.broadcast(counts), "subtree").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    return (
        asked.drop("blocks")
        .groupBy("subtree", "block")
        .cogroup(inside.drop("blocks").groupBy("subtree", "block"))
        .applyInPandas(run, "query_id long, query_key long, vec_id long, score long")
    )


def top_products(
    rows: DataFrame,
    k: int = 20,
    every: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    subtree_rows: int = SUBTREE_ROWS,
) -> DataFrame:
    """The k largest inner products of each query with all other rows, exactly.

    Queries are the rows whose id is divisible by ``every``. Returns ``query_id, rank,
    vec_id, score``; ties go to the smaller id. Vectors are scaled by
    ``scaled_vectors``, which says which rows take no part. Shorter vectors count as
    filled up with zeros. If an id has several vectors, each of them is searched, and
    ranks start anew for each. With fewer rows than k, all are returned; an empty table
    gives an empty result.

    Rows with equal vectors tie in every query, so only the k + 1 smallest ids of each
    vector can be in a result (one may be the query's own); the others are not laid out.
    """
    spark = rows.sparkSession
    clean = stored(scaled_vectors(rows, id_column, vector_column))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = clean.agg(
        F.count("*").alias("n"), F.max(norm).alias("square"), F.max(F.size("v")).alias("w")
    ).first()
    n, square, width = facts["n"], facts["square"] or 0.0, facts["w"] or 0
    queries = clean.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query_key"), "v"
    )
    ranks = Window.partitionBy("v").orderBy("vec_id")
    candidates = (
        clean.withColumn("place", F.row_number().over(ranks))
        .where(F.col("place") <= k + 1)
        .drop("place")
    )
    wanted = min(MAX_SUBTREES, max(1, -(-n // subtree_rows)))
    # A bounded number of pivots, by hash: any choice gives the same result.
    chosen = (
        clean.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
    )
    pivots = [(at, list(row["v"])) for at, row in enumerate(chosen)]
    if not pivots:
        return spark.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long"
        )
    centres = _matrix([vector for _, vector in pivots], width).astype(np.float64)
    full = np.column_stack([centres, _lift(centres, square)])
    squares = (full**2).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            plain = _matrix(vectors, width).astype(np.float64)
            points = np.column_stack([plain, _lift(plain, square)])
            home = (squares - 2 * points @ full.T).argmin(axis=1)
            reach = np.sqrt(((points - full[home]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(home.astype(np.int64)),
                    batch.column("vec_id"),
                    batch.column("v"),
                    pa.array(reach),
                ],
                names=["pivot", "vec_id", "v", "reach"],
            )

    placed = stored(
        candidates.transform(
            mapped,
            assign, "pivot long, vec_id long, v array<long>, reach double"
        )
    )
    # A region with far more rows than others is split into several subtrees.
    sizes = placed.groupBy("pivot").agg(F.count("*").alias("rows"))
    members = placed.join(F.broadcast(sizes), "pivot").withColumn(
        "subtree",
        F.col("pivot") * 2**32
        + F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("rows") / (2 * subtree_rows))),
    )
    nodes = (
        members.groupBy("subtree", "pivot").agg(F.max("reach").alias("radius")).collect()
    )
    by_name = {node["subtree"]: pivots[node["pivot"]][1] for node in nodes}
    listed = [(node["subtree"], pivots[node["pivot"]][1]) for node in nodes]
    radii = [node["radius"] + SLACK for node in nodes]
    members = members.select("subtree", "vec_id", "v")

    asked = queries.withColumn("least", F.lit(None).cast("long"))
    schema = (
        "subtree long, query_id long, query_key long, v array<long>, least long"
    )
    first = asked.transform(mapped, _visits(listed, radii, square, width, True), schema)
    found = stored(_search(first, members, by_name, square, width, k))
    bounds = found.groupBy("query_id", "query_key").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("least")
    )
    rest = queries.join(bounds, ["query_id", "query_key"], "left").select(
        "query_id", "query_key", "v", "least"
    )
    others = rest.transform(mapped, _visits(listed, radii, square, width, False), schema)
    every_one = found.unionByName(_search(others, members, by_name, square, width, k))
    best = Window.partitionBy("query_id", "query_key").orderBy(
        F.desc("score"), "vec_id"
    )
    return (
        every_one.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
