"""Runs catalog queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value: object) -> str:
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.6f}"
    return repr(value)


def _sorted_rows(names: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(_cell(row[at]) for at in order) for row in rows)


def difference(spark, connection, sf_dir: str, function, sql: str) -> str | None:
    """What differs, or None."""
    result = function(spark, sf_dir)
    got = _sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    want = _sorted_rows(names, cursor.fetchall())
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    pairs = [pair for pair in zip(got, want, strict=True) if pair[0] != pair[1]]
    if pairs:
        return f"{len(pairs)} rows differ, first {pairs[0]} in {sorted(names)}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = entries.oracle_sql()
    for name, function in entries.queries().items():
        if name not in oracles or wanted and name not in wanted:
            continue
        started = time.time()
        try:
            found = difference(spark, connection, sf_dir, function, oracles[name])
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {time.time() - started:6.1f}s  {found or 'equal'}", flush=True)


if __name__ == "__main__":
    main()
