"""CSV listings: every cell stays text."""

from __future__ import annotations

import re
from collections import defaultdict
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.sources.records import SPLITTABLE, csv_records, file_headers

# Where a row came from, added next to the CSV columns.
FILE_COLUMN = "__file"
BLOCK_COLUMN = "__block"
# The whole line of a row with more or fewer cells than its header, else null.
LINE_COLUMN = "__line"


def csv_options(encoding: str = "utf-8", multi_line: bool = True) -> dict[str, Any]:
    """How listings are read, as files and as a stream."""
    return {
        "header": True,
        "quote": '"',
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "enforceSchema": False,
        "multiLine": multi_line,
        "encoding": encoding,
    }


def _first_lines(spark: SparkSession, path: str | list[str], encoding: str) -> dict[str, str]:
    """The first line of each file, in any encoding. Reads the first split of each."""
    lines = (
        spark.read.schema("line STRING")
        .options(sep="\x01", quote="", encoding=encoding)
        .csv(path)
        .select(
            "line",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )
        .where(F.col("block") == 0)
    )
    rows = lines.groupBy("file").agg(F.min_by("line", "at").alias("line")).collect()
    return {row["file"]: row["line"] for row in rows}


def _path_of(file: str) -> str:
    """The path to read a file by whose address a scan has given."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _by_header(
    spark: SparkSession, path: str | list[str], encoding: str, by_record: bool
) -> dict[tuple[str, bool], list[str]]:
    """Files by the text of their header, and whether they can be read by records.

    A file whose lines end in CR alone is one line, and one whose header does not end in
    its first split cannot be told apart from others; both are read as a whole.
    """
    found: dict[tuple[str, bool], list[str]] = defaultdict(list)
    odd = []
    if by_record:
        for file, header in file_headers(spark, path, encoding).items():
            text = None if header is None else header.strip("\ufeff").removesuffix("\r")
            if text is None or re.search("\r(?!\n)", text):
                odd.append(_path_of(file))
            else:
                found[text, True].append(_path_of(file))
    if odd or not by_record:
        for file, line in _first_lines(spark, odd or path, encoding).items():
            found[line.strip("\ufeff\r"), False].append(_path_of(file))
    return found


def _columns(names: list[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` STRING" for name in names)


def read_csv_groups(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "utf-8",
    multi_line: bool = True,
) -> list[DataFrame]:
    """Header CSV, one frame for each different header: all columns as strings, the
    position of each split, and the line of rows that do not fit their header.

    ``multi_line`` allows line breaks inside quoted cells. Files are split all the same,
    at the price of a second pass over them; only in encodings other than UTF-8, ASCII and
    Latin-1 a file is one task. Switch it off for files known to have none.

    Empty files and folders give no frame.
    """
    groups = []
    options = csv_options(encoding, multi_line)
    by_record = multi_line and encoding.lower() in SPLITTABLE
    for (_, split), files in _by_header(spark, path, encoding, by_record).items():
        first = spark.read.options(**options).option("inferSchema", False).csv(files[0])
        schema = _columns([*first.columns, LINE_COLUMN])
        corrupt = {"columnNameOfCorruptRecord": LINE_COLUMN}
        if split:
            cells = {**options, **corrupt, "header": False, "mode": "PERMISSIVE"}
            cells = {name: str(value).lower() if isinstance(value, bool) else value
                     for name, value in cells.items() if name not in ("multiLine", "encoding")}
            rows = csv_records(spark, files, encoding)
            parsed = F.from_csv("text", schema, cells)
            groups.append(
                rows.select(
                    parsed.alias("cells"),
                    F.col("file").alias(FILE_COLUMN),
                    F.col("block").alias(BLOCK_COLUMN),
                ).select("cells.*", FILE_COLUMN, BLOCK_COLUMN)
            )
            continue
        rows = (
            spark.read.options(**{**options, **corrupt, "enforceSchema": True})
            .schema(schema)
            .csv(files)
        )
        groups.append(
            rows.select(
                "*",
                F.col("_metadata.file_path").alias(FILE_COLUMN),
                F.col("_metadata.file_block_start").alias(BLOCK_COLUMN),
            )
        )
    return groups


def read_csv_source(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "utf-8",
    multi_line: bool = True,
) -> DataFrame:
    """``read_csv_groups`` as one frame; columns that a file lacks are null."""
    groups = read_csv_groups(spark, path, encoding, multi_line)
    if not groups:
        return spark.createDataFrame(
            [], f"{LINE_COLUMN} STRING, {FILE_COLUMN} STRING, {BLOCK_COLUMN} BIGINT"
        )
    whole = groups[0]
    for group in groups[1:]:
        whole = whole.unionByName(group, allowMissingColumns=True)
    return whole
