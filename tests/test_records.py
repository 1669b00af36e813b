"""CSV files cut into records by many tasks, against a plain reader."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from leadmill.sources.csv import (
    BLOCK_COLUMN,
    FILE_COLUMN,
    LINE_COLUMN,
    csv_options,
    read_csv_groups,
    read_csv_source,
)
from leadmill.sources.records import csv_records, ends_inside


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _cell(draw):
    return draw.choice(
        [
            "plain",
            "",
            "with, comma",
            'a "quoted" word',
            "two\nlines",
            "\n\n",
            'ends"\n"starts',
            "x" * draw.randint(0, 400),
            "line\n" * draw.randint(0, 120),
            "é ü",
        ]
    )


def _text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def _write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("line", ['a,b', '"a,b"', '"a', 'a,"b', 'a"b,c', '"a""', '"a"",b', '"a"x,"b', '"', '""', '"",""', '5" pipe,"x', 'a,"b""'])
@pytest.mark.parametrize("inside", [False, True])
def test_state_at_the_end_of_a_line(line, inside):
    """As a machine that reads letter by letter says."""
    state = "quoted" if inside else "start"
    at = 0
    while at < len(line):
        letter = line[at]
        if state == "start":
            state = "quoted" if letter == '"' else "start" if letter == "," else "plain"
        elif state == "plain":
            state = "start" if letter == "," else "plain"
        elif letter == '"' and line[at + 1 : at + 2] == '"':
            at += 1
        elif letter == '"':
            state = "plain"
        at += 1
    assert ends_inside(line, inside) == (state == "quoted")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_rows_of_split_files_equal_a_plain_reader(spark, tmp_path, small_splits, seed, end):
    draw = random.Random(seed)
    files, want = [], []
    for number in range(3):
        rows = [[f"{number}-{n}", _cell(draw), _cell(draw), "z"] for n in range(60)]
        files.append(_write(tmp_path, f"{number}.csv", _text([["id", "a", "b", "c"], *rows], end)))
        want += [tuple(row) for row in rows]
    (group,) = read_csv_groups(spark, files)
    got = [(r["id"], r["a"] or "", r["b"] or "", r["c"]) for r in group.collect()]
    assert sorted(got) == sorted(want)
    assert group.where(F.col(LINE_COLUMN).isNotNull()).count() == 0
    # Several tasks read a file, and order within a file is kept.
    assert group.select(FILE_COLUMN, BLOCK_COLUMN).distinct().count() > 12
    ordered = group.withColumn("seq", F.monotonically_increasing_id()).orderBy(
        FILE_COLUMN, BLOCK_COLUMN, "seq"
    )
    numbers = [r["id"] for r in ordered.where("id LIKE '1-%'").collect()]
    assert numbers == [f"1-{n}" for n in range(60)]


def test_as_the_unsplit_reader(spark, tmp_path, small_splits):
    """Stray quotes, ragged rows, blank lines and an open cell at the end."""
    rows = ['5" pipe,x,1', 'Jo "J" Hay,y', 'a,b,c,d', '', '"q"r,s,t', '  ,,', '"open\nto, the', "end"]
    text = "one,two,three\n" + "\n".join(f"{row}" for row in rows * 1)
    text = "one,two,three\n" + "\n".join(rows[:6] * 40) + '\n"open\nto, the\nend'
    path = _write(tmp_path, "odd.csv", text)
    options = {**csv_options(), "enforceSchema": True, "columnNameOfCorruptRecord": LINE_COLUMN}
    schema = f"one STRING, two STRING, three STRING, {LINE_COLUMN} STRING"
    want = spark.read.options(**options).schema(schema).csv(path)
    got = read_csv_source(spark, path).select("one", "two", "three", LINE_COLUMN)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_record_over_many_splits_and_headers_with_breaks(spark, tmp_path, small_splits):
    long = "word\n" * 2000
    rows = [["1", "x"], ["2", long], ["3", "y"]]
    text = _text([["id", "a\nname"], *rows])
    found = read_csv_source(spark, _write(tmp_path, "long.csv", text))
    assert {(r["id"], r["a\nname"]) for r in found.collect()} == {tuple(row) for row in rows}


def test_headers_empty_files_marks_and_encodings(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    assert read_csv_source(spark, str(folder)).collect() == []
    (folder / "empty.csv").write_text("")
    assert read_csv_source(spark, str(folder)).collect() == []
    assert read_csv_groups(spark, str(folder)) == []
    (folder / "marked.csv").write_bytes("﻿name,b\r\nA,\"x\r\ny\"\r\n".encode())
    (folder / "other.csv").write_text("b,name\n1,B\n")
    (folder / "only {header} [1].csv").write_text("b,name\n")
    found = read_csv_source(spark, str(folder))
    assert {(r["name"], r["b"]) for r in found.collect()} == {("A", "x\r\ny"), ("B", "1")}
    path = _write(tmp_path, "latin.csv", 'n\n"José\nO"\n', "latin-1")
    assert [r["n"] for r in read_csv_source(spark, path, "ISO-8859-1").collect()] == ["José\nO"]
    path = _write(tmp_path, "wide.csv", 'n\n"José\nO"\n', "utf-16")
    assert [r["n"] for r in read_csv_source(spark, path, "UTF-16").collect()] == ["José\nO"]
    path = _write(tmp_path, "mac.csv", "n,m\r1,2\r3,4\r")
    assert [r["n"] for r in read_csv_source(spark, path).collect()] == ["1", "3"]


def test_records_keep_their_text(spark, tmp_path, small_splits):
    path = _write(tmp_path, "t.csv", 'h\n"a\nb"\nc\n')
    rows = csv_records(spark, [path]).orderBy("block").collect()
    assert [row["text"] for row in rows] == ['"a\nb"', "c"]
