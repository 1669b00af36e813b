"""Hard negatives by a secondary sort.

Anchors are dealt into waves of bounded size and meet all rows in blocks. A first pass
keeps each task's best positives of every anchor; a second one, knowing the positives,
keeps each task's first negatives of every window. What is kept, a bounded number of pairs
a task and anchor, is packed into keys of anchor, descending score, kind and id, dealt by
anchor and sorted on the way (``repartitionAndSortWithinPartitions``). One iterator then
reads the stream: a positive opens its window, a negative is emitted to the open windows
that reach it. No anchor's pairs are ever held together.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import mapped, stored

#: Anchors of one wave, and rows and anchors of one block of scores. A wave's vectors are
#: sent to all tasks: 8 MB at 64 components.
WAVE, ROWS, ANCHORS = 16_384, 1_024, 1_024
POSITIVE, NEGATIVE = 0, 1
COLUMNS = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)
_KEY = struct.Struct(">QQBQ")
_TOP = 1 << 63
_ALL = (1 << 64) - 1


def pack(anchor: int, score: int, kind: int, other: int) -> bytes:
    """A key whose byte order is anchor, best score first, positives first, smaller id."""
    return _KEY.pack((anchor + _TOP) & _ALL, (_TOP - 1 - score) & _ALL, kind, (other + _TOP) & _ALL)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, other = _KEY.unpack(key)
    return anchor - _TOP, _TOP - 1 - score, kind, other - _TOP


def usable_rows(
    vectors: DataFrame, scale: int, id_column: str, vector_column: str, label: Column
) -> DataFrame:
    """``id, label, vec`` with whole components; one row for each id.

    Rows with a null id, label, vector or component, or a component that is not finite,
    are left out. Of rows that share an id the least by label and vector stays.
    """
    vec = F.col(vector_column)
    good = (
        F.col(id_column).isNotNull()
        & label.isNotNull()
        & vec.isNotNull()
        & F.forall(
            vec, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
        )
    )
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (
        vectors.where(good)
        .select(
            F.col(id_column).cast("long").alias("id"),
            F.struct(label.cast("long").alias("label"), whole.alias("vec")).alias("row"),
        )
        .groupBy("id")
        .agg(F.min("row").alias("row"))
        .select("id", "row.label", "row.vec")
    )


@dataclass(frozen=True)
class Block:
    """Rows as arrays; shorter vectors are filled up with zeros."""

    ids: np.ndarray
    labels: np.ndarray
    vecs: np.ndarray

    @classmethod
    def of(cls, rows: pa.RecordBatch) -> Block:
        """From ``id, label, vec``."""
        ids, labels = (rows.column(at).to_numpy(zero_copy_only=False) for at in (0, 1))
        sizes = pc.list_value_length(rows.column(2)).to_numpy(zero_copy_only=False)
        sizes = sizes.astype(np.int64)
        flat = rows.column(2).flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        vecs = np.zeros((len(sizes), sizes.max(initial=0)), dtype=np.int64)
        vecs[row, place] = flat
        return cls(ids.astype(np.int64), labels.astype(np.int64), vecs)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products, exact while they fit a long (beyond, they wrap).

    Doubles hold whole numbers up to 2^53 exactly, and multiply faster.
    """
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), dtype=np.int64)
    most = float(np.abs(left.astype(float)).max()) * float(np.abs(right.astype(float)).max())
    if most * width < 2.0**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left @ right.T


class Best:
    """The first ``size`` ids of every list by descending score and id."""

    def __init__(self, lists: int, size: int):
        self.size = size
        self.lists = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        #: A pair that is not better than its list's bar is out.
        self.bar = np.full(lists, np.iinfo(np.int64).min)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        lists = np.concatenate([self.lists, lists])
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        first = np.searchsorted(lists, lists, "left")
        kept = np.arange(len(lists)) - first < self.size
        self.lists, self.scores, self.ids = lists[kept], scores[kept], ids[kept]
        full = np.flatnonzero(np.arange(len(lists)) - first == self.size - 1)
        self.bar[lists[full]] = scores[full]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        yield from zip(
            self.lists.tolist(), self.scores.tolist(), self.ids.tolist(), strict=True
        )


def _tiles(
    batches: Iterator[pa.RecordBatch], anchors: Block
) -> Iterator[tuple[Block, slice, np.ndarray]]:
    """Blocks of rows by blocks of anchors with their scores."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            block = Block.of(batch.slice(at, ROWS))
            for start in range(0, len(anchors.ids), ANCHORS):
                part = slice(start, start + ANCHORS)
                yield block, part, products(block.vecs, anchors.vecs[part])


def best_positives(rows: Iterator[pa.RecordBatch], anchors: Block, size: int) -> Iterator[bytes]:
    """Keys of a task's best rows of each anchor's label, without the anchor itself."""
    best = Best(len(anchors.ids), size)
    for block, part, scores in _tiles(rows, anchors):
        fits = block.labels[:, None] == anchors.labels[None, part]
        fits &= block.ids[:, None] != anchors.ids[None, part]
        fits &= scores >= best.bar[None, part]
        row, anchor = np.nonzero(fits)
        best.add(anchor + part.start, scores[row, anchor], block.ids[row])
    for at, score, other in best.rows():
        yield pack(int(anchors.ids[at]), score, POSITIVE, other)


def window(score: int, low: int, high: int) -> tuple[int, int] | None:
    """Bounds of the negative scores that go with a positive score, or none.

    A negative fits where low * score <= 100 * its score <= high * score.
    """
    least, most = -((-low * score) // 100), (high * score) // 100
    return (least, most) if least <= most else None


def first_negatives(
    rows: Iterator[pa.RecordBatch], anchors: Block, tops: np.ndarray, low: int, high: int, size: int
) -> Iterator[bytes]:
    """Keys of a task's first rows of other labels within any window of each anchor.

    ``tops`` holds each anchor's windows as ``least, most``; empty ones have least > most.
    """
    count = tops.shape[1]
    best = Best(len(anchors.ids) * count, size)
    bars = best.bar.reshape(len(anchors.ids), count)
    for block, part, scores in _tiles(rows, anchors):
        other = block.labels[:, None] != anchors.labels[None, part]
        for at in range(count):
            least, most = tops[part, at, 0], tops[part, at, 1]
            fits = other & (scores <= most) & (scores >= np.maximum(least, bars[part, at]))
            row, anchor = np.nonzero(fits)
            best.add((anchor + part.start) * count + at, scores[row, anchor], block.ids[row])
    # A pair may lie in several windows.
    yield from {
        pack(int(anchors.ids[at // count]), score, NEGATIVE, other)
        for at, score, other in best.rows()
    }


def _keys(rows: DataFrame, found: Callable[..., Iterator[bytes]]) -> DataFrame:
    """The keys that a function finds in a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = found(batches)
        while held := list(islice(keys, 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["key"])

    return rows.transform(mapped, run, "key binary")


def sorted_pairs(pairs: DataFrame, tasks: int) -> RDD:
    """Keys dealt by anchor, each task's in order."""
    return (
        pairs.rdd.map(lambda row: (bytes(row["key"]), None))
        .repartitionAndSortWithinPartitions(tasks, partitionFunc=lambda key: crc32(key[:8]))
        .keys()
    )


def first_of_anchor(keys: Iterator[bytes], size: int) -> Iterator[tuple[bytes]]:
    """The first keys of every anchor in a sorted stream."""
    current, taken = None, 0
    for key in keys:
        if key[:8] != current:
            current, taken = key[:8], 0
        if taken < size:
            taken += 1
            yield (key,)


def emit(
    keys: Iterator[bytes], low: int, high: int, positives: int, negatives: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Negatives of the windows that positives open, from a sorted stream.

    Held at a time: the open windows of one anchor.
    """
    current, opened, windows = None, 0, []
    for key in keys:
        anchor, score, kind, other = unpack(key)
        if anchor != current:
            current, opened, windows = anchor, 0, []
        if kind == POSITIVE:
            bounds = window(score, low, high)
            opened += 1
            if bounds and opened <= positives:
                windows.append([other, score, *bounds, 0])
            continue
        for entry in windows:
            positive, top, least, most, taken = entry
            if least <= score <= most and taken < negatives:
                entry[4] += 1
                yield anchor, positive, taken + 1, other, top, score
        # Scores only fall from here, so a full or passed window stays closed.
        windows = [entry for entry in windows if entry[4] < negatives and entry[2] <= score]


def mine(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    low: int = 80,
    high: int = 100,
    positives: int = 5,
    negatives: int = 5,
    wave: int = WAVE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows meeting ``anchor``, a condition on the columns of ``vectors``;
    ``label`` gives each row's label. Scores are integer inner products of components
    taken as ``floor(scale * x)``; higher ones come first, ties by smaller id. Each of an
    anchor's first ``positives`` other rows of its label opens a window from ``low`` to
    ``high`` percent of its score; the first ``negatives`` rows of other labels in it are
    returned, ranked from 1.

    Rows with a null id, label, vector or component, or a component that is not finite,
    take no part; of rows that share an id the least by label and vector does. A vector
    shorter than another one counts as filled up with zeros. Scores wrap where they do not
    fit a long. An anchor without positives or without fitting negatives gives no rows.
    Further columns are not read.
    """
    spark = vectors.sparkSession
    ids = (
        vectors.where(F.coalesce(anchor, F.lit(False)))
        .select(F.col(id_column).cast("long").alias("id"))
        .distinct()
    )
    rows = stored(usable_rows(vectors, scale, id_column, vector_column, label))
    anchors = stored(rows.join(ids, "id", "left_semi"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    waves = max(1, math.ceil(anchors.count() / wave))
    number = F.pmod(F.xxhash64("id"), F.lit(waves))
    # About ``wave`` rows each: every id is there once, so its hash deals them evenly.
    found = [
        _mine_wave(
            rows, anchors.where(number == at), tasks, low, high, positives, negatives
        )
        for at in range(waves)
    ]
    return reduce(DataFrame.unionAll, found)


def _mine_wave(
    rows: DataFrame,
    anchors: DataFrame,
    tasks: int,
    low: int,
    high: int,
    positives: int,
    negatives: int,
) -> DataFrame:
    spark = rows.sparkSession
    columns = [column.combine_chunks() for column in anchors.toArrow().columns]
    block = Block.of(pa.RecordBatch.from_arrays(columns, names=["id", "label", "vec"]))
    shared = spark.sparkContext.broadcast(block)
    close = _keys(rows, lambda mine: best_positives(mine, shared.value, positives))
    first = sorted_pairs(close, tasks).mapPartitions(
        lambda keys: first_of_anchor(keys, positives)
    )
    chosen = stored(spark.createDataFrame(first, "key binary"))
    tops = np.zeros((len(block.ids), positives, 2), dtype=np.int64)
    tops[:, :, 0] = 1  # no window
    places = {anchor_id: at for at, anchor_id in enumerate(block.ids.tolist())}
    taken = dict.fromkeys(places, 0)
    # At most ``positives`` keys for each anchor of the wave.
    for row in chosen.collect():
        anchor, score, _, _ = unpack(bytes(row["key"]))
        if bounds := window(score, low, high):
            tops[places[anchor], taken[anchor]] = bounds
            taken[anchor] += 1
    known = spark.sparkContext.broadcast(tops)
    far = _keys(
        rows,
        lambda mine: first_negatives(mine, shared.value, known.value, low, high, negatives),
    )
    found = sorted_pairs(chosen.unionAll(far), tasks).mapPartitions(
        lambda keys: emit(keys, low, high, positives, negatives)
    )
    result = stored(spark.createDataFrame(found, COLUMNS))
    shared.unpersist()
    known.unpersist()
    return result


def mine_labelled(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    every: int = 100,
    moved: int = 7,
    labels: int = 10,
) -> DataFrame:
    """``mine`` for anchors whose id ``every`` divides.

    Where ``moved`` divides the id, the label first becomes the next one of ``labels``.
    """
    shifted = (F.col(label_column) + 1) % labels
    label = F.when(F.col(id_column) % moved == 0, shifted).otherwise(F.col(label_column))
    return mine(
        vectors, F.col(id_column) % every == 0, label, id_column, vector_column
    )
