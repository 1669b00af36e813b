"""The raw layer: source rows wrapped verbatim."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.identity import record_id
from leadmill.sources.csv import BLOCK_COLUMN, FILE_COLUMN, LINE_COLUMN

_POSITION = (FILE_COLUMN, BLOCK_COLUMN, LINE_COLUMN)
# The cell that holds a record which could not be taken apart.
MALFORMED = "__malformed"


def batch_id(source: Column, at: Column, suffix: Column) -> Column:
    """``<source>:<yyyyMMddTHHmmssZ>:<suffix>``."""
    stamp = F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")
    return F.concat_ws(":", source, stamp, suffix)


def new_batch_id(source: str, at: datetime | None = None, suffix: str | None = None) -> str:
    """Batch id of one run."""
    at = (at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{source}:{at:%Y%m%dT%H%M%SZ}:{suffix or uuid4().hex[:8]}"


def json_cells(text: Column) -> Column:
    """Cells of a JSON object; a nested value stays JSON text.

    Text that is no JSON object is kept whole in the cell ``MALFORMED``.
    """
    cells = F.from_json(text, "map<string,string>")
    whole = F.create_map(F.lit(MALFORMED), text)
    return F.when(cells.isNull() & text.isNotNull(), whole).otherwise(cells)


def wrap_raw(
    rows: DataFrame,
    source: Column,
    file_batch_id: Column,
    ingested_at: Column,
    cells: list[str] | None = None,
    seq: Column | None = None,
    raw_data: Column | None = None,
) -> DataFrame:
    """Raw rows ``(id, source, raw_data, ingested_at, file_batch_id, origin, ingest_seq)``.

    ``origin`` and ``ingest_seq`` give the record order within a batch. For files
    they are the split and the row's position in the reading task, which a retried
    task repeats; other sources pass a sortable ``seq``. Ids depend on both, so a
    batch is wrapped once and read back from where it was written. ``raw_data``
    replaces the map of cells, for sources whose record is one JSON text.
    """
    names = cells or [name for name in rows.columns if name not in _POSITION]
    if raw_data is None:
        pairs: list[Column] = []
        for name in names:
            quoted = "`" + name.replace("`", "``") + "`"
            pairs += [F.lit(name), F.coalesce(F.col(quoted).cast("string"), F.lit(""))]
        raw_data = F.create_map(*pairs)
        if LINE_COLUMN in rows.columns:
            # A row that does not fit its header keeps its line, so no cell is lost.
            line = F.create_map(F.lit(LINE_COLUMN), F.col(LINE_COLUMN))
            raw_data = F.when(
                F.col(LINE_COLUMN).isNotNull(), F.map_concat(raw_data, line)
            ).otherwise(raw_data)

    if seq is None:
        block = F.lpad(F.col(BLOCK_COLUMN).cast("string"), 20, "0")
        origin = F.concat_ws("@", F.col(FILE_COLUMN), block)
        seq = F.monotonically_increasing_id()
    else:
        origin = F.lit("")

    located = rows.select(
        source.alias("source"),
        raw_data.alias("raw_data"),
        ingested_at.alias("ingested_at"),
        file_batch_id.alias("file_batch_id"),
        origin.alias("origin"),
        seq.cast("bigint").alias("ingest_seq"),
    )
    identity = record_id(
        F.col("source"),
        F.col("file_batch_id"),
        F.col("origin"),
        F.col("ingest_seq").cast("string"),
    )
    return located.select(identity.alias("id"), *located.columns)
