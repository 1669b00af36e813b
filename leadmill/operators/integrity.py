"""Audits of the layers and removal of a batch with all that came from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.rules import ENTITY_TYPES, PRIORITIES

# The longest text each column may hold.
RAW_LENGTHS = {"source": 128, "file_batch_id": 128}
NORMALIZED_LENGTHS = {
    "owner_name_normalized": 512,
    "address_line1": 512,
    "city": 128,
    "state": 8,
    "zip": 16,
    "property_type": 128,
    "source": 128,
    "dedup_hash": 64,
}
SCORED_LENGTHS = {"crm_record_id": 64}

RAW_REQUIRED = ("id", "source", "raw_data", "ingested_at")
NORMALIZED_REQUIRED = (
    "id",
    "raw_record_id",
    "entity_type",
    "keywords_found",
    "source",
)
SCORED_REQUIRED = (
    "id",
    "normalized_record_id",
    "score",
    "priority",
    "score_breakdown",
    "exported_to_crm",
)


def _count_breaches(rows: DataFrame, breaches: dict[str, Column]) -> DataFrame:
    """``(check, rows)`` with one pass over the data."""
    counts = rows.agg(
        *[F.count_if(breach).alias(name) for name, breach in breaches.items()]
    )
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("breaches"))
            for name in breaches
        ]
    )
    return counts.select(F.inline(entries))


def audit_columns(
    rows: DataFrame,
    required: tuple[str, ...],
    lengths: dict[str, int],
    domains: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    breaches: dict[str, Column] = {}
    for name in required:
        breaches[f"{name} missing"] = F.col(name).isNull()
    for name, limit in lengths.items():
        breaches[f"{name} over {limit}"] = F.length(name) > limit
    for name, values in (domains or {}).items():
        breaches[f"{name} outside domain"] = ~F.col(name).isin(*values)
    return _count_breaches(rows, breaches)


def audit_raw(raw: DataFrame) -> DataFrame:
    return audit_columns(raw, RAW_REQUIRED, RAW_LENGTHS)


def audit_normalized(normalized: DataFrame) -> DataFrame:
    return audit_columns(
        normalized,
        NORMALIZED_REQUIRED,
        NORMALIZED_LENGTHS,
        {"entity_type": ENTITY_TYPES},
    )


def audit_scored(scored: DataFrame) -> DataFrame:
    return audit_columns(
        scored, SCORED_REQUIRED, SCORED_LENGTHS, {"priority": PRIORITIES}
    )


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Non-null keys held by more than one row, with the number of rows.

    Counting the key leaves the null group at zero. A null test would be pushed
    down and make Spark compute a derived key twice.
    """
    counts = rows.groupBy(key).agg(F.count(key).alias("copies"))
    return counts.where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose parent is missing."""
    ids = parent.select(F.col("id").alias(parent_key))
    return child.join(ids, parent_key, "left_anti")


def cascade(
    raw: DataFrame,
    normalized: DataFrame,
    scored: DataFrame,
    condition: Column,
    remove: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three layers without the raw rows meeting ``condition`` and their
    descendants, or with ``remove=False`` just those rows, as a preview.
    """
    how = "left_anti" if remove else "left_semi"
    meets = F.coalesce(condition, F.lit(False))
    raw_ids = raw.where(meets).select(F.col("id").alias("raw_record_id"))
    record_ids = normalized.join(raw_ids, "raw_record_id", "left_semi").select(
        F.col("id").alias("normalized_record_id")
    )
    return (
        raw.where(~meets if remove else meets),
        normalized.join(raw_ids, "raw_record_id", how),
        scored.join(record_ids, "normalized_record_id", how),
    )
