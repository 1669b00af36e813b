"""Normalized records to scored leads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.identity import lead_id
from leadmill.functions.rules import (
    DEFAULT_RULES,
    PRIORITIES,
    priority_of,
    rule_entries,
    total_points,
)

SCORED_COLUMNS = (
    "id",
    "normalized_record_id",
    "score",
    "priority",
    "score_breakdown",
    "exported_to_crm",
    "exported_at",
    "crm_record_id",
    "created_at",
)


def record_columns() -> list[Column]:
    """Columns of the normalized record that a lead shows."""
    return [
        F.col("raw_record_id"),
        F.col("owner_name_normalized").alias("owner_name"),
        *map(
            F.col,
            (
                "entity_type",
                "address_line1",
                "city",
                "state",
                "zip",
                "claim_amount",
                "property_type",
                "keywords_found",
                "source",
                "dedup_hash",
            ),
        ),
    ]


def not_yet_scored(normalized: DataFrame, scored: DataFrame) -> DataFrame:
    """Normalized rows without a score; only ids are shuffled for the test."""
    children = scored.select(F.col("normalized_record_id").alias("id"))
    pending = normalized.select("id").join(children, "id", "left_anti")
    return normalized.join(pending, "id", "left_semi")


def apply_rules(
    normalized: DataFrame, rules: Mapping[str, Any] = DEFAULT_RULES
) -> DataFrame:
    """Add ``score``, ``priority`` and ``score_breakdown`` to each record."""
    entries = rule_entries(rules)
    names = [f"rule_{name}" for name in entries]
    fired = normalized.withColumns(dict(zip(names, entries.values(), strict=True)))
    scored = fired.withColumn(
        "score", total_points({name: F.col(name) for name in names})
    )
    return scored.withColumns(
        {
            "priority": priority_of(F.col("score"), rules),
            "score_breakdown": F.struct(
                *[F.col(f"rule_{name}").alias(name) for name in entries],
                F.col("score").alias("total"),
            ),
        }
    ).drop(*names)


def _scored_columns(created_at: Column | None) -> list[Column]:
    at = F.current_timestamp() if created_at is None else created_at
    return [
        lead_id(F.col("id")).alias("id"),
        F.col("id").alias("normalized_record_id"),
        F.col("score"),
        F.col("priority"),
        F.col("score_breakdown"),
        F.lit(False).alias("exported_to_crm"),
        F.lit(None).cast("timestamp").alias("exported_at"),
        F.lit(None).cast("string").alias("crm_record_id"),
        at.alias("created_at"),
    ]


def score(
    normalized: DataFrame,
    rules: Mapping[str, Any] = DEFAULT_RULES,
    created_at: Column | None = None,
) -> DataFrame:
    """Score rows in the shape of the scored layer, none exported yet."""
    return apply_rules(normalized, rules).select(*_scored_columns(created_at))


def score_leads(
    normalized: DataFrame,
    rules: Mapping[str, Any] = DEFAULT_RULES,
    created_at: Column | None = None,
) -> DataFrame:
    """Scores with the record columns beside them, as ``join_leads`` gives.

    The record is at hand when its score is computed, so this costs no join, then
    or when leads are listed.
    """
    return apply_rules(normalized, rules).select(
        *_scored_columns(created_at), *record_columns()
    )


def count_by_priority(scored: DataFrame) -> DataFrame:
    """``(priority, leads)`` for every priority, zero where there are none."""
    counts = scored.agg(
        *[F.count_if(F.col("priority") == name).alias(name) for name in PRIORITIES]
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("priority"), F.col(name).alias("leads"))
            for name in PRIORITIES
        ]
    )
    return counts.select(F.inline(rows))


def score_summary(scored: DataFrame) -> DataFrame:
    """One row: processed and the count of each priority."""
    return scored.agg(
        F.count("*").alias("processed"),
        *[F.count_if(F.col("priority") == name).alias(name) for name in PRIORITIES],
    )
