"""Read side: listing, looking up and counting leads."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from uuid import UUID

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from leadmill.functions.rules import PRIORITIES
from leadmill.operators.scoring import record_columns

# Page sizes and the longest state filter.
DEFAULT_LIMIT = 50
MAX_LIMIT = 200
MAX_STATE_LENGTH = 8

# Leading hex digits of the id that slice the leads of one score: 4096 slices,
# so even a score shared by a third of all leads is numbered by many tasks.
SLICE_DIGITS = 3

SUMMARY_COLUMNS = (
    "id",
    "owner_name",
    "entity_type",
    "city",
    "state",
    "claim_amount",
    "score",
    "priority",
    "exported_to_crm",
)


def join_leads(scored: DataFrame, normalized: DataFrame) -> DataFrame:
    """Each scored lead with the columns of its normalized record."""
    record = normalized.select(
        F.col("id").alias("normalized_record_id"), *record_columns()
    )
    return scored.join(record, "normalized_record_id", "inner")


@dataclass(frozen=True)
class LeadFilter:
    """Optional conditions on leads, all of which must hold.

    An empty state is no filter; a minimum of zero is one, and like any minimum
    leaves out leads without an amount.
    """

    priority: str | None = None
    state: str | None = None
    min_amount: Decimal | int | str | None = None

    def __post_init__(self) -> None:
        if self.priority is not None and self.priority not in PRIORITIES:
            raise ValueError(f"priority must be one of {PRIORITIES}")
        if self.state is not None and len(self.state) > MAX_STATE_LENGTH:
            raise ValueError(f"state must have at most {MAX_STATE_LENGTH} characters")
        if self.min_amount is not None:
            amount = Decimal(str(self.min_amount))
            if not amount.is_finite() or amount < 0:
                raise ValueError("min_amount must be at least 0")

    def conditions(self) -> list[Column]:
        conditions = []
        if self.priority is not None:
            conditions.append(F.col("priority") == self.priority)
        if self.state:
            conditions.append(F.col("state") == self.state.upper())
        if self.min_amount is not None:
            amount = F.lit(Decimal(str(self.min_amount)))
            conditions.append(F.col("claim_amount") >= amount)
        return conditions

    def apply(self, leads: DataFrame) -> DataFrame:
        for condition in self.conditions():
            leads = leads.where(condition)
        return leads


@dataclass(frozen=True)
class Page:
    limit: int = DEFAULT_LIMIT
    offset: int = 0

    def __post_init__(self) -> None:
        if not 1 <= self.limit <= MAX_LIMIT:
            raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
        if self.offset < 0:
            raise ValueError("offset must be at least 0")


def pending(leads: DataFrame) -> DataFrame:
    return leads.where(~F.col("exported_to_crm"))


def exported_count(leads: DataFrame) -> DataFrame:
    return leads.agg(F.count_if("exported_to_crm").alias("exported"))


def ranked(leads: DataFrame) -> DataFrame:
    """Best score first, ties by id."""
    return leads.orderBy(F.desc("score"), "id")


def summaries(leads: DataFrame) -> DataFrame:
    return leads.select(*SUMMARY_COLUMNS)


def list_leads(
    leads: DataFrame, where: LeadFilter = LeadFilter(), page: Page = Page()
) -> DataFrame:
    """One page of summaries; planned as a top-k, not as a full sort."""
    rows = summaries(where.apply(leads))
    return ranked(rows).offset(page.offset).limit(page.limit)


def rank_counts(leads: DataFrame, digits: int = SLICE_DIGITS) -> DataFrame:
    """How many leads there are by priority, score and beginning of the id.

    At most as many rows as scores times ``16 ** digits`` and priorities, however many
    leads: each task adds up its own before they meet. Counts of parts of the leads can be
    put together, as ``seek`` adds them up.
    """
    key = F.substring("id", 1, digits).alias("slice")
    return leads.groupBy("priority", "score", key).agg(F.count("*").alias("leads_in"))


@dataclass(frozen=True)
class Place:
    """Where an offset is: so many leads after the first one of a slice."""

    score: int
    slice: str
    skip: int


def seek(ranks: DataFrame, offset: int) -> Place | None:
    """Turn an offset into a place of the order, from ``rank_counts`` alone.

    None if there are no more leads than ``offset``. First the score is found, then the
    slice in that score, so no window runs over more than the slices of one score.
    """
    if offset < 0:
        raise ValueError("offset must be at least 0")
    in_score = ranks.groupBy("score").agg(F.sum("leads_in").alias("leads_in"))
    score = _cell(in_score, F.desc("score"), offset)
    if score is None:
        return None
    offset -= score["before"]
    of_score = ranks.where(F.col("score") == score["score"])
    slices = of_score.groupBy("slice").agg(F.sum("leads_in").alias("leads_in"))
    found = _cell(slices, F.asc("slice"), offset)
    return Place(score["score"], found["slice"], offset - found["before"])


def _cell(counts: DataFrame, order: Column, offset: int) -> Row | None:
    """The row of small counts in which the lead after ``offset`` others lies."""
    above = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("leads_in").over(above), F.lit(0))
    rows = counts.withColumn("before", before)
    inside = (F.col("before") <= offset) & (F.col("before") + F.col("leads_in") > offset)
    return rows.where(inside).first()


def list_at(
    leads: DataFrame,
    ranks: DataFrame,
    where: LeadFilter = LeadFilter(),
    page: Page = Page(),
) -> DataFrame:
    """The page of ``list_leads``, at the same cost for every offset.

    ``ranks`` are the ``rank_counts`` of the leads that meet the filter. The rows before
    the slice of the first lead are filtered out, so the top-k holds a page and what it
    skips of one slice.
    """
    rows = summaries(where.apply(leads))
    place = seek(ranks, page.offset)
    if place is None:
        return rows.limit(0)
    later = (F.col("score") < place.score) | (
        (F.col("score") == place.score) & (F.col("id") >= place.slice)
    )
    return ranked(rows.where(later)).offset(place.skip).limit(page.limit)


def list_after(
    leads: DataFrame,
    score: int,
    lead_id: str,
    where: LeadFilter = LeadFilter(),
    limit: int = Page().limit,
) -> DataFrame:
    """The page that follows the lead with this score and id.

    For deep pages: the rows before it are filtered out, not gathered and dropped, so
    every page costs the same.
    """
    rows = summaries(where.apply(leads))
    later = (F.col("score") < score) | (
        (F.col("score") == score) & (F.col("id") > lead_id)
    )
    return ranked(rows.where(later)).limit(Page(limit=limit).limit)


def filtered_count(leads: DataFrame, where: LeadFilter = LeadFilter()) -> DataFrame:
    return where.apply(leads).agg(F.count("*").alias("total"))


def lead_page(
    leads: DataFrame,
    where: LeadFilter = LeadFilter(),
    page: Page = Page(),
    ranks: DataFrame | None = None,
) -> DataFrame:
    """One row: items in order, total, limit and offset.

    The page is at most ``MAX_LIMIT`` rows, so gathering it is bounded. With ``ranks``, as
    ``list_at`` takes them, the page is found and the total added up from these counts.
    """
    if ranks is None:
        rows, total = list_leads(leads, where, page), filtered_count(leads, where)
    else:
        rows = list_at(leads, ranks, where, page)
        total = ranks.agg(F.coalesce(F.sum("leads_in"), F.lit(0)).alias("total"))
    best_first = F.struct((-F.col("score")).alias("rank"), *SUMMARY_COLUMNS)
    items = rows.agg(F.sort_array(F.collect_list(best_first)).alias("gathered")).select(
        F.transform("gathered", lambda item: item.dropFields("rank")).alias("items")
    )
    halves = items.unionByName(total, allowMissingColumns=True)
    return halves.agg(
        F.any_value("items", ignoreNulls=True).alias("items"),
        F.max("total").alias("total"),
    ).select(
        "items",
        "total",
        F.lit(page.limit).alias("limit"),
        F.lit(page.offset).alias("offset"),
    )


def lead_detail(leads: DataFrame, lead_id: str | None = None) -> DataFrame:
    """Full detail of all leads, or of the one with the given id."""
    if lead_id is not None:
        leads = leads.where(F.col("id") == str(UUID(lead_id)))
    return leads.select(
        *SUMMARY_COLUMNS,
        "address_line1",
        "zip",
        "property_type",
        F.coalesce("keywords_found", F.array().cast("array<string>")).alias(
            "keywords_found"
        ),
        "source",
        "score_breakdown",
        "created_at",
    )


def stats(leads: DataFrame) -> DataFrame:
    """One row: totals, counts by priority, amount, exported and pending."""
    exported = F.count_if("exported_to_crm")
    return leads.agg(
        F.count("*").alias("total_leads"),
        *[F.count_if(F.col("priority") == name).alias(name) for name in PRIORITIES],
        F.coalesce(F.sum("claim_amount"), F.lit(0)).alias("total_claim_amount"),
        exported.alias("exported"),
        (F.count("*") - exported).alias("pending_export"),
    )


def of_batch(leads: DataFrame, raw: DataFrame, file_batch_id: str) -> DataFrame:
    """Leads whose raw row came with one ingest batch."""
    batch = raw.where(F.col("file_batch_id") == file_batch_id).select(
        F.col("id").alias("raw_record_id"), "file_batch_id"
    )
    return leads.join(batch, "raw_record_id", "inner")
