"""SimHash fingerprints and their exact near-duplicate groups.

Fingerprints within ``radius`` bits of each other are found by comparing tiles of
fingerprints with numpy: exclusive-or and bit counts. Fingerprints are sorted by how many
bits are set, in total and in each sixteenth of the fingerprint. The counts of two
fingerprints differ by no more than their bits do, so a pair of tiles is skipped where the
ranges of their counts lie further apart than the radius: in total, or summed over the
parts.

The tiles are spread over Spark as a grid: sorted blocks of fingerprints against each
other, each pair of blocks one task, leaving out the pairs whose counts are too far apart.
A task gives back not its links but a spanning forest of them, at most one edge for each
of its fingerprints, which keeps what is connected and grows with the fingerprints, not
with the links. Equal fingerprints are one point from the start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.llm.components import components, spread_join
from leadmill.llm.shared import LOWER_ASCII, fresh_name, mapped, stored

SHINGLE = 4
RADIUS = 4
BLOCK_ROWS = 65_536
TILE_ROWS = 256
# A fixed value: white space between words.
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_PARTS = 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles; zero for a text without words."""
    words = [w for w in _SPACE.split(text.translate(LOWER_ASCII)) if w] if text else []
    if not words:
        return 0
    encoded = [word.encode("utf-8", "surrogatepass") for word in words]
    joined = b" ".join(encoded)
    ends = np.cumsum([len(word) + 1 for word in encoded])
    starts = ends - [len(word) + 1 for word in encoded]
    stop = (ends - 1)[size - 1 :] if len(words) >= size else ends[-1:] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts.tolist(), stop.tolist(), strict=False)),
        np.uint64,
        len(stop),
    )
    # Bits of blocks are added up bytewise, which needs no table of all bits at once.
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(chosen.view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``<id>, print``: the fingerprint of every row, as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed)], names=["id", "print"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return (
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
        .transform(mapped, run, f"id {kind}, print long")
        .withColumnRenamed("id", id_column)
    )


def part_counts(prints: np.ndarray) -> np.ndarray:
    """How many bits are set in each sixteenth of each fingerprint."""
    nibbles = prints[:, None] >> (np.arange(_PARTS, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_count(nibbles & np.uint64(15)).astype(np.int16)


class _Tiles:
    """A sorted block of fingerprints cut into tiles, with the ranges of their counts."""

    def __init__(self, prints: np.ndarray, rows: int = TILE_ROWS):
        counts = part_counts(prints)
        quarters = counts.reshape(-1, 4, 4).sum(axis=2)
        keys = [*counts.T[::-1], *quarters.T[::-1], counts.sum(axis=1)]
        order = np.lexsort(keys)
        self.prints, self.at = prints[order], order
        counts = counts[order]
        columns = np.column_stack(
            [counts, counts.reshape(-1, 4, 4).sum(axis=2), counts.sum(axis=1)]
        )
        self.edges = np.arange(0, len(prints), rows)
        self.rows = rows
        self.low = np.minimum.reduceat(columns, self.edges)
        self.high = np.maximum.reduceat(columns, self.edges)

    def near(self, tile: int, other: _Tiles, radius: int) -> np.ndarray:
        """Tiles of ``other`` whose counts may lie within the radius of a tile's."""
        gaps = np.maximum(
            np.maximum(other.low - self.high[tile], self.low[tile] - other.high), 0
        )
        lowest = np.maximum(
            np.maximum(gaps[:, :16].sum(axis=1), gaps[:, 16:20].sum(axis=1)), gaps[:, 20]
        )
        return np.flatnonzero(lowest <= radius)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Edges (as rows of two fingerprints) that connect what links within the radius.

    ``right`` None: links inside ``left``. Pairs that are already connected by earlier
    edges are passed over, so there are fewer edges than fingerprints.
    """
    a = _Tiles(left)
    b = a if right is None else _Tiles(right)
    shift = 0 if right is None else len(left)
    root = np.arange(len(left) + (0 if right is None else len(right)))

    def top(node: int) -> int:
        while root[node] != node:
            root[node] = root[root[node]]
            node = root[node]
        return node

    edges: list[tuple[int, int]] = []
    for tile in range(len(a.edges)):
        rows = slice(a.edges[tile], a.edges[tile] + a.rows)
        mine, names = a.prints[rows], a.at[rows]
        for other in a.near(tile, b, radius):
            if right is None and other < tile:
                continue
            columns = slice(b.edges[other], b.edges[other] + b.rows)
            theirs, others = b.prints[columns], b.at[columns] + shift
            close = np.bitwise_count(mine[:, None] ^ theirs[None, :]) <= radius
            if right is None and other == tile:
                close &= ~np.eye(len(mine), dtype=bool)
            if not close.any():
                continue
            while True:
                tops = np.array([top(n) for n in names])
                ends = np.array([top(n) for n in others])
                close &= tops[:, None] != ends[None, :]
                hit = np.flatnonzero(close.any(axis=1))
                if not len(hit):
                    break
                for row, column in zip(hit, close[hit].argmax(axis=1), strict=True):
                    x, y = top(names[row]), top(others[column])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        edges.append((int(mine[row]), int(theirs[column])))
    return np.array(edges, dtype=np.uint64).reshape(-1, 2)


def link_forest(
    points: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``a, b``: edges that connect the fingerprints of ``points(print)`` wherever a
    chain of links within the radius does. Fingerprints must be distinct."""
    ones = points.select("print", F.bit_count("print").alias("ones"))
    # Blocks are ranges of the bit count; a count with many fingerprints has several.
    sizes = {row["ones"]: row["count"] for row in ones.groupBy("ones").count().collect()}
    blocks: list[tuple[int, int, int, int]] = []  # first and last count, part, parts
    run: list[int] = []
    for count in sorted(sizes):
        if run and sum(sizes[c] for c in run) + sizes[count] > block_rows:
            blocks.append((run[0], run[-1], 0, 1))
            run = []
        if sizes[count] > block_rows:
            parts = -(-sizes[count] // block_rows)
            blocks += [(count, count, part, parts) for part in range(parts)]
        else:
            run.append(count)
    if run:
        blocks.append((run[0], run[-1], 0, 1))
    return _grid(ones, blocks, radius)


def _grid(ones: DataFrame, blocks: list, radius: int) -> DataFrame:
    spark = ones.sparkSession
    of_count = [
        (count, first, parts)
        for first, last, part, parts in blocks
        if part == 0
        for count in range(first, last + 1)
    ]
    firsts: dict[int, int] = {}
    for at, (first, _, part, _) in enumerate(blocks):
        if part == 0:
            firsts[first] = at
    # At most 65 rows: the first block and the number of blocks of each bit count.
    places = spark.createDataFrame(
        [(count, firsts[first], parts) for count, first, parts in of_count],
        "ones int, first long, parts long",
    )
    placed = ones.join(F.broadcast(places), "ones").select(
        "print",
        "ones",
        (F.col("first") + F.pmod(F.xxhash64("print"), F.col("parts"))).alias("block"),
    )
    # Blocks follow the bit count, so those within reach of a block are a range.
    lows, highs = [b[0] for b in blocks], [b[1] for b in blocks]
    reach = spark.createDataFrame(
        [
            (
                at,
                min(i for i in range(len(blocks)) if highs[i] >= lows[at] - radius),
                max(i for i in range(len(blocks)) if lows[i] <= highs[at] + radius),
            )
            for at in range(len(blocks))
        ],
        "block long, least long, most long",
    )
    cells = placed.join(F.broadcast(reach), "block").select(
        "print",
        "block",
        F.explode(F.sequence("least", "most")).alias("other"),
    )
    cells = cells.select(
        "print",
        (F.col("block") > F.col("other")).alias("second"),
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["print"].to_numpy().view(np.uint64)
        second = rows["second"].to_numpy()
        if key[0] == key[1]:
            edges = forest(prints, None, radius)
        elif second.all() or not second.any():
            edges = np.empty((0, 2), dtype=np.uint64)
        else:
            edges = forest(prints[~second], prints[second], radius)
        signed = edges.view(np.int64)
        return pd.DataFrame({"a": signed[:, 0], "b": signed[:, 1]})

    return cells.groupBy("x", "y").applyInPandas(compare, "a long, b long")


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``<id>, fingerprint, component_id`` of every row.

    Rows link if their fingerprints differ in at most ``radius`` bits; the component is
    the smallest id that is reachable. Texts without words, null ones included, have
    fingerprint zero and link like any other. A row without id links others, but is no
    component's id; a component without any id has a null one. Repeated rows all stay.
    """
    prints = stored(fingerprints(docs, id_column, text_column))
    points = stored(prints.groupBy("print").agg(F.min(id_column).alias("least")))
    edges = link_forest(points, radius, block_rows)
    roots = stored(components(edges))
    # Only fingerprints with links are in ``roots``; the others stand for themselves.
    joined = stored(
        points.join(roots, points["print"] == roots["node"], "left").select(
            "print", "least", F.coalesce("root", "print").alias("root")
        )
    )
    top = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spread_join(joined, top, "root", F.xxhash64("print"), joined.count())
    row = F.monotonically_increasing_id()
    return spread_join(
        prints, named.select("print", "component_id"), "print", row, prints.count()
    ).select(
        id_column,
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    radius: int = RADIUS,
) -> DataFrame:
    """One document of each group of near duplicates, with the same columns.

    The document with the smallest id stays; of several rows with that id the one with the
    smallest text, then that with the smallest hash of its columns other than maps. Rows
    without id cannot be told apart and all stay.
    """
    groups = near_groups(docs.where(F.col(id_column).isNotNull()), id_column, text_column, radius)
    heads = (
        groups.where(F.col(id_column) == F.col("component_id"))
        .select(F.col(id_column).alias("_head"))
        .distinct()
    )
    mine = docs.join(heads, docs[id_column] == heads["_head"], "left_semi")
    hashed = [
        F.col(f"`{name}`")
        for name, kind in docs.dtypes
        if "map<" not in kind and kind != "variant"
    ]
    first = Window.partitionBy(id_column).orderBy(text_column, F.xxhash64(*hashed))
    place = fresh_name(docs, "place")
    single = (
        mine.withColumn(place, F.row_number().over(first))
        .where(F.col(place) == 1)
        .drop(place)
    )
    return single.unionByName(docs.where(F.col(id_column).isNull()))
