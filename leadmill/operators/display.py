"""Columns as a dashboard shows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.amounts import NO_VALUE, format_money, show_money
from leadmill.functions.text import null_if_empty

# Dashboard page size and the name shown for a nameless owner.
DISPLAY_PAGE = 25
UNNAMED = "(unnamed)"


def _or_dash(text: Column) -> Column:
    return F.coalesce(null_if_empty(text), F.lit(NO_VALUE))


def _joined(*names: str) -> Column:
    """Non-blank values joined by comma, or a dash."""
    return _or_dash(F.concat_ws(", ", *[null_if_empty(F.col(name)) for name in names]))


def display_rows(leads: DataFrame) -> DataFrame:
    """One line of the lead table per lead."""
    return leads.select(
        "id",
        F.coalesce(null_if_empty(F.col("owner_name")), F.lit(UNNAMED)).alias("owner"),
        "entity_type",
        _joined("city", "state").alias("place"),
        show_money(F.col("claim_amount"), 0).alias("amount"),
        "score",
        "priority",
        F.when(F.col("exported_to_crm"), "exported").otherwise("pending").alias("crm"),
    )


def display_details(leads: DataFrame) -> DataFrame:
    """The detail card of each lead."""
    return leads.select(
        "id",
        F.coalesce(null_if_empty(F.col("owner_name")), F.lit(UNNAMED)).alias("owner"),
        "entity_type",
        _joined("address_line1", "city", "state", "zip").alias("address"),
        show_money(F.col("claim_amount"), 2).alias("amount"),
        _or_dash(F.col("property_type")).alias("property_type"),
        "source",
        _or_dash(F.array_join("keywords_found", ", ")).alias("keywords"),
        F.when(F.col("exported_to_crm"), "exported")
        .otherwise("pending export")
        .alias("crm"),
    )


def display_stats(stats: DataFrame) -> DataFrame:
    """The head line: totals with the amount in whole dollars."""
    return stats.select(
        "total_leads",
        "high",
        format_money(F.col("total_claim_amount"), 0).alias("amount"),
        "pending_export",
    )


def page_ranges(
    totals: DataFrame, offset: Column, size: int = DISPLAY_PAGE
) -> DataFrame:
    """First and last position shown, and whether pages lie before and after."""
    total = F.col("total")
    return totals.select(
        "*",
        F.when(total == 0, F.lit(0)).otherwise(offset + 1).alias("start"),
        F.least(offset + size, total).alias("end"),
        (offset > 0).alias("has_prev"),
        (offset + size < total).alias("has_next"),
    )
