"""CSV files with line breaks inside cells, read by many tasks.

A split begins at a line, but that line may lie inside a quoted cell. Which it is depends
on all splits before it, so files are read in two passes. The first one runs each split
from both beginnings, at a record and inside a cell, and notes how it would end. These
functions of two states are put together along each file, with one small row a split. The
second pass then starts every split in its true state and cuts it into records; the two
ends of a record that spans splits are put together by a shuffle of just these pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Encodings in which a line break is one byte that is part of no other character.
SPLITTABLE = ("utf-8", "utf8", "us-ascii", "ascii", "iso-8859-1", "latin-1", "latin1")
_NAMES = {"utf8": "utf-8", "ascii": "us-ascii", "latin-1": "iso-8859-1", "latin1": "iso-8859-1"}
# The rest of a quoted cell, up to its closing quote and on to the next comma.
_REST = re.compile(r'[^"]*(?:""[^"]*)*("(?!")[^,]*(,|$))?', re.DOTALL)
_ROWS = 10_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line break after this line lies inside a quoted cell."""
    at = 0
    while True:
        if not inside:
            # Only a quote at the beginning of a cell opens one.
            while line[at : at + 1] != '"':
                comma = line.find(",", at)
                if comma < 0:
                    return False
                at = comma + 1
            at, inside = at + 1, True
        found = _REST.match(line, at)
        if found[1] is None:
            return True
        if not found[2]:
            return False
        at, inside = found.end(), False


def _lines(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    text, name = F.col("value"), _NAMES.get(encoding.lower(), encoding.lower())
    if name != "utf-8":
        text = F.decode(text.cast("binary"), name)
    return (
        spark.read.option("lineSep", "\n")
        .text(files)
        .select(
            text.alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Lines of one split after another; a batch may hold the lines of several."""
    for batch in batches:
        lines, files, blocks = (batch.column(name) for name in ("line", "file", "block"))
        if not batch.num_rows:
            continue
        same = pc.and_(
            pc.equal(files.slice(1), files.slice(0, batch.num_rows - 1)),
            pc.equal(blocks.slice(1), blocks.slice(0, batch.num_rows - 1)),
        )
        cuts = [0, *(pc.indices_nonzero(pc.invert(same)).to_numpy() + 1).tolist()]
        for start, stop in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield files[start].as_py(), blocks[start].as_py(), lines.slice(start, stop - start)


def _quoted(lines: pa.Array) -> list[int]:
    """The places of lines that hold a quote; all others end as they begin."""
    return pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How every split ends, from both beginnings."""
    held: dict[tuple[str, int], list[bool]] = {}  # a few splits a task
    for file, block, lines in _splits(batches):
        states = held.setdefault((file, block), [False, True])
        for at in _quoted(lines):
            line = lines[at].as_py()
            states[:] = [ends_inside(line, state) for state in states]
    yield pa.RecordBatch.from_pydict(
        {
            "file": pa.array([file for file, _ in held], pa.string()),
            "block": pa.array([block for _, block in held], pa.int64()),
            "outside": pa.array([states[0] for states in held.values()], pa.bool_()),
            "inside": pa.array([states[1] for states in held.values()], pa.bool_()),
        }
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """``file, block, starts_inside`` of every split.

    A split either ends the same from both beginnings, or keeps or turns the state. So the
    state behind some splits is that of the last one of the first kind, turned as often as
    splits after it turn it.
    """
    ends = lines.mapInArrow(
        _ends, "file STRING, block BIGINT, outside BOOLEAN, inside BOOLEAN"
    )
    # One row for each split of a file, 128 MB by default.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    until = Window.partitionBy("file").orderBy("block")
    turns = F.sum(F.expr("cast(outside AND NOT inside AS INT)"))
    known = ends.withColumn("turned", turns.over(until))
    fixed = F.when(
        F.col("outside") == F.col("inside"),
        F.struct("block", F.col("outside").cast("int").alias("state"), "turned"),
    )
    return (
        known.withColumn("last", F.max(fixed).over(before))
        .withColumn("so_far", F.coalesce(F.max("turned").over(before), F.lit(0)))
        .select(
            "file",
            "block",
            (
                (
                    F.coalesce("last.state", F.lit(0))
                    + F.col("so_far")
                    - F.coalesce("last.turned", F.lit(0))
                )
                % 2
                == 1
            ).alias("starts_inside"),
        )
    )


# A record within one split, or a part of one that spans splits.
WHOLE, FIRST, MIDDLE, LAST = "whole", "first", "middle", "last"
_PIECES = "file STRING, block BIGINT, kind STRING, header BOOLEAN, text STRING"


class _Cutter:
    """Cuts the lines of one split, in order, into records and parts of records."""

    def __init__(self, inside: bool, begins_file: bool) -> None:
        self.inside = self.cut_off = inside
        self.header = begins_file
        self.held: list[str] = []

    def read(self, lines: list[str], quoted: set[int]) -> Iterator[tuple[str, bool, str]]:
        """``kind, header, text`` of what ends within these lines."""
        for at, line in enumerate(lines):
            if not self.inside and not self.held and not line.strip("\r"):
                continue  # an empty line between records
            self.held.append(line)
            if at in quoted:
                self.inside = ends_inside(line, self.inside)
            if not self.inside:
                yield self._out(LAST if self.cut_off else WHOLE)

    def rest(self) -> Iterator[tuple[str, bool, str]]:
        """What is open at the end of the split."""
        if self.held:
            yield self._out(MIDDLE if self.cut_off else FIRST)

    def _out(self, kind: str) -> tuple[str, bool, str]:
        text = "\n".join(self.held)
        out = kind, self.header and not self.cut_off, text
        self.header &= self.cut_off
        self.held, self.cut_off = [], False
        return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of every split, and the parts of those that span splits."""

    def pieces() -> Iterator[tuple[str, int, str, bool, str]]:
        split, cutter = None, None
        for batch in batches:
            states = batch.column("starts_inside")
            done = 0
            for file, block, part in _splits([batch]):
                if (file, block) != split:
                    if cutter:
                        yield from ((*split, *piece) for piece in cutter.rest())
                    inside = states[done].as_py()
                    if inside is None:
                        raise RuntimeError(f"{file} was split otherwise in the first pass")
                    split, cutter = (file, block), _Cutter(inside, block == 0)
                for piece in cutter.read(part.to_pylist(), set(_quoted(part))):
                    yield *split, *piece
                done += len(part)
        if cutter:
            yield from ((*split, *piece) for piece in cutter.rest())

    found = pieces()
    kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    names = ["file", "block", "kind", "header", "text"]
    while held := list(islice(found, _ROWS)):
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def csv_records(spark: SparkSession, files: list[str], encoding: str = "utf-8") -> DataFrame:
    """``file, block, text`` of every CSV record, headers left out.

    ``block`` is the split in which the record begins. Within a split, records come in
    file order, one that goes on in the next split last.
    """
    lines = _lines(spark, files, encoding)
    key = F.xxhash64("file").alias("in_file")
    # 17 bytes for each split of 128 MB.
    starts = split_starts(lines).select(key, F.col("block"), "starts_inside")
    placed = lines.withColumn("in_file", key).join(
        F.broadcast(starts), ["in_file", "block"], "left"
    )
    cut = placed.select("line", "file", "block", "starts_inside").mapInArrow(_cut, _PIECES)
    whole = cut.where((F.col("kind") == WHOLE) & ~F.col("header"))
    # At most two parts for each split.
    parts = cut.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == FIRST)
    begins = F.last(F.when(F.col("kind") == FIRST, F.col("block")), ignorenulls=True)
    joined = (
        parts.withColumn("begins", begins.over(order))
        .groupBy("file", F.col("begins").alias("block"))
        .agg(
            F.bool_or("header").alias("header"),
            F.sort_array(F.collect_list(F.struct(F.col("block").alias("at"), "text"))).alias(
                "parts"
            ),
        )
        .where(~F.col("header"))
        .select("file", "block", F.array_join("parts.text", "\n").alias("text"))
    )
    records = whole.select("file", "block", "text").unionAll(joined)
    # The end of a line in files with CR LF; inside cells it stays.
    return records.withColumn("text", F.regexp_replace("text", "\r$", ""))


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of every file, null if it does not end in the first split."""
    found: dict[str, str | None] = {}
    cutter = None
    for batch in batches:
        for file, block, part in _splits([batch]):
            if block or found.get(file) is not None:
                continue
            if file not in found:
                cutter, found[file] = _Cutter(False, True), None
            for _, _, text in cutter.read(part.to_pylist(), set(_quoted(part))):
                found[file] = text
                break
    yield pa.RecordBatch.from_pydict(
        {
            "file": pa.array(found, pa.string()),
            "header": pa.array(found.values(), pa.string()),
        }
    )


def file_headers(
    spark: SparkSession, path: str | list[str], encoding: str
) -> dict[str, str | None]:
    """The header record of each file that is not empty.

    Like the listing of the files itself, one row a file reaches the driver.
    """
    lines = _lines(spark, path, encoding).where(F.col("block") == 0)
    rows = lines.mapInArrow(_headers, "file STRING, header STRING").collect()
    return {row["file"]: row["header"] for row in rows}
