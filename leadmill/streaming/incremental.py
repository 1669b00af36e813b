"""The stages as an available-now stream of listing files."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill import schemas
from leadmill.functions.rules import DEFAULT_RULES
from leadmill.plans import jobs
from leadmill.sources.csv import (
    BLOCK_COLUMN,
    FILE_COLUMN,
    csv_options,
    read_csv_groups,
)
from leadmill.sources.mappings import DEFAULT_REGISTRY, Registry
from leadmill.sources.raw import wrap_raw
from leadmill.sources.warehouse import Warehouse


def csv_stream(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    encoding: str = "utf-8",
    files_per_step: int = 1000,
    multi_line: bool = True,
) -> DataFrame:
    """New CSV files of a folder; ``columns`` names the header's columns.

    A file with another header fails the stream rather than mixing up its cells; use
    ``csv_files`` for folders whose files differ in their columns.
    """
    schema = ", ".join("`" + name.replace("`", "``") + "` STRING" for name in columns)
    reader = (
        spark.readStream.schema(schema)
        .options(**csv_options(encoding, multi_line))
        .option("maxFilesPerTrigger", files_per_step)
    )
    return reader.csv(folder).select(
        "*",
        F.col("_metadata.file_path").alias(FILE_COLUMN),
        F.col("_metadata.file_block_start").alias(BLOCK_COLUMN),
    )


def csv_files(spark: SparkSession, folder: str, files_per_step: int = 1000) -> DataFrame:
    """New CSV files of a folder, one row each, for ``wrap_csv_files``; no file is read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("maxFilesPerTrigger", files_per_step)
        .load(folder)
        .select("path")
    )


def wrap_csv_files(
    source: str, encoding: str = "utf-8", multi_line: bool = True
) -> Callable[[DataFrame, str], DataFrame]:
    """Raw rows of the files of a step, each file read by its own header.

    At most ``files_per_step`` paths reach the driver.
    """

    def wrap(files: DataFrame, batch: str) -> DataFrame:
        spark = files.sparkSession
        paths = sorted(row["path"] for row in files.collect())
        groups = read_csv_groups(spark, paths, encoding, multi_line) if paths else []
        now = F.current_timestamp()
        parts = [wrap_raw(rows, F.lit(source), F.lit(batch), now) for rows in groups]
        empty = spark.createDataFrame([], schemas.RAW)
        return reduce(DataFrame.unionByName, parts) if parts else empty

    return wrap


def wrap_csv_rows(source: str) -> Callable[[DataFrame, str], DataFrame]:
    def wrap(rows: DataFrame, batch: str) -> DataFrame:
        return wrap_raw(rows, F.lit(source), F.lit(batch), F.current_timestamp())

    return wrap


def run_available(
    store: Warehouse,
    stream: DataFrame,
    wrap: Callable[[DataFrame, str], DataFrame],
    name: str,
    checkpoint: str,
    registry: Registry = DEFAULT_REGISTRY,
    rules: Mapping[str, Any] = DEFAULT_RULES,
) -> None:
    """Ingest, normalize and score all that is new in ``stream``, then return.

    Each step calls the batch jobs under names made from the stream's id, which its
    checkpoint keeps, and the step's number, so a step repeated after a failure finds
    its finished parts done. There is no watermark: a duplicate counts however long
    ago its first copy came.
    """

    def step(rows: DataFrame, number: int) -> None:
        context = rows.sparkSession.sparkContext
        stream_id = context.getLocalProperty("sql.streaming.queryId")
        batch = f"{name}:{stream_id}:{number}"
        jobs.ingest_raw(store, wrap(rows, batch), batch)
        jobs.normalize_new(store, registry, run=f"normalize-{batch}")
        jobs.score_new(store, rules, run=f"score-{batch}")

    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
