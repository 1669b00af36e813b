"""Raw rows to typed records, duplicates removed across all sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.functions.address import address_pieces, merge_address
from leadmill.functions.amounts import to_money, wide_amount
from leadmill.functions.identity import hash_of_upper, normalized_id, packed
from leadmill.functions.names import detect_entity_type
from leadmill.functions.text import clean_state, clean_text, clean_zip, normalize_name
from leadmill.sources.mappings import Registry, extract, unregistered

NORMALIZED_COLUMNS = (
    "id",
    "raw_record_id",
    "owner_name_normalized",
    "entity_type",
    "address_line1",
    "city",
    "state",
    "zip",
    "claim_amount",
    "property_type",
    "record_age_years",
    "keywords_found",
    "source",
    "dedup_hash",
)
ORDER = ("ingested_at", "origin", "ingest_seq")

# A duplicate group with more rows than this is matched by broadcast, as all of its
# rows in one task would be too many. There is at most one such group for so many rows
# of input, and each takes some 150 bytes.
HOT_ROWS = 1_000_000

# Bits that tell which rows may be duplicates, 32,768 to a bitmap.
BITS = 1 << 26


def not_yet_normalized(raw: DataFrame, normalized: DataFrame) -> DataFrame:
    """Raw rows without a normalized child; rows without an id stay out.

    One anti join, so the rows are computed and shuffled once, and only against ids.
    """
    children = normalized.select(F.col("raw_record_id").alias("id"))
    return raw.where(F.col("id").isNotNull()).join(children, "id", "left_anti")


def leftover(
    raw: DataFrame, registry: Registry, normalized: DataFrame, bits: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``not_yet_normalized`` in two parts: rows of other sources, and duplicates.

    The first have no child for sure and are not shuffled. With ``bits`` from
    ``childless_bits`` mostly duplicates are, of the rest.
    """
    known = F.coalesce(F.col("source").isin(*registry), F.lit(False))
    others = raw.where(~known & F.col("id").isNotNull())
    mine = raw.where(known)
    if bits is None:
        return others, not_yet_normalized(mine, normalized)
    # Not an anti join: Spark would do that first, on all rows.
    children = normalized.select(F.col("raw_record_id").alias("__child"))
    joined = _with_bit_set(mine, bits).join(children, F.col("id") == F.col("__child"), "left")
    return others, joined.where(F.col("__child").isNull()).select(*raw.columns)


def childless_bits(raw: DataFrame, registry: Registry, normalized: DataFrame) -> DataFrame:
    """Bitmaps in which every row of a registered source without a child has its bit set.

    Whole rows are wide, so only ids are joined here, as bytes. The bitmaps take eight
    megabytes at most, whatever the input. The more rows have no child, the more others share
    their bits; these are told apart by the join of whole rows that follows.
    """
    mine = raw.where(F.col("source").isin(*registry) & F.col("id").isNotNull())
    ids = mine.select(packed(F.col("id")).alias("id"))
    children = normalized.select(packed(F.col("raw_record_id")).alias("id"))
    place = _bit_of(F.col("id"))
    return (
        ids.join(children, "id", "left_anti")
        .groupBy(F.bitmap_bucket_number(place).alias("__bitmap"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits"))
    )


def _bit_of(key: Column) -> Column:
    """The place of a key among the bits, from 1."""
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1


def _with_bit_set(raw: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows whose bit is set; rows without an id stay out."""
    place = _bit_of(packed(F.col("id")))
    marked = raw.where(F.col("id").isNotNull()).withColumns(
        {"__bitmap": F.bitmap_bucket_number(place), "__at": F.bitmap_bit_position(place)}
    )
    byte = F.hex(F.substring(F.col("__bits"), F.expr("cast(__at div 8 AS INT) + 1"), F.lit(1)))
    value = F.conv(byte, 16, 10).cast("int")
    is_set = F.getbit(value, (F.col("__at") % 8).cast("int")) == 1
    return marked.join(F.broadcast(bits), "__bitmap").where(is_set).select(*raw.columns)


def work_order(raw: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """Add ``position``: from 1, in the order in which a run takes the rows.

    Rows are sliced by time, origin and ranges of their number; slice counts give each
    slice its start, so only one small row a slice is ordered as a whole.
    """
    cut = raw.withColumn("slice", F.expr(f"ingest_seq div {int(slice_rows)}"))
    keys = ["ingested_at", "origin", "slice"]
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*keys)
        .agg(F.count("*").alias("rows_in"))
        .withColumn("start", F.coalesce(F.sum("rows_in").over(before), F.lit(0)))
        .drop("rows_in")
    )
    inside = Window.partitionBy(*keys).orderBy("ingest_seq", "source", "id")
    return (
        cut.join(starts, keys)
        .withColumn("position", F.col("start") + F.row_number().over(inside))
        .drop("slice", "start")
    )


def build_normalized(
    raw: DataFrame,
    registry: Registry,
    as_of_year: Column | None = None,
    year_key: str = "reported_year",
) -> DataFrame:
    """Apply all field rules to the rows of registered sources.

    Besides ``NORMALIZED_COLUMNS`` the result keeps the order columns for
    ``first_of_each``. Each ``select`` uses the results of the one before, which
    keeps costly expressions from being evaluated twice. The record age stays
    null unless ``as_of_year`` is given.
    """
    age = F.lit(None)
    if as_of_year is not None:
        reported = F.try_element_at(F.col("raw_data"), F.lit(year_key)).try_cast("int")
        age = as_of_year - reported
    aged = raw.withColumn("record_age_years", age.cast("int"))
    fields = extract(aged, registry, "record_age_years")
    cleaned = fields.select(
        F.col("id").alias("raw_record_id"),
        "source",
        *ORDER,
        normalize_name(F.col("owner_name")).alias("owner_name_normalized"),
        clean_text(F.col("address_line1")).alias("address_line1"),
        clean_text(F.col("city")).alias("city"),
        clean_state(F.col("state")).alias("state"),
        clean_zip(F.col("zip")).alias("zip"),
        wide_amount(F.col("claim_amount_text")).alias("amount"),
        clean_text(F.col("property_type")).alias("property_type"),
        "keywords_found",
        "record_age_years",
    )
    address = [F.col(name) for name in ("address_line1", "city", "state", "zip")]
    split = cleaned.withColumn("pieces", address_pieces(*address))
    merged = split.withColumns(
        {
            **merge_address(F.col("pieces"), *address),
            "claim_amount": to_money(F.col("amount")),
        }
    )
    keyed = merged.select(
        normalized_id(F.col("raw_record_id")).alias("id"),
        "raw_record_id",
        "owner_name_normalized",
        detect_entity_type(F.col("owner_name_normalized")).alias("entity_type"),
        "address_line1",
        "city",
        "state",
        "zip",
        "claim_amount",
        "property_type",
        "record_age_years",
        "keywords_found",
        "source",
        hash_of_upper(
            F.col("owner_name_normalized"),
            F.upper("address_line1"),
            F.when(F.col("claim_amount").isNotNull(), F.col("amount")),
        ).alias("dedup_hash"),
        *ORDER,
    )
    return keyed


def _group_key() -> Column:
    """The hash, or a value of its own for a row without one.

    The literal only tells Spark that the key is never null. Else a join on it adds
    a null test, which is pushed down and computes the hash a second time.
    """
    return F.coalesce("dedup_hash", F.concat(F.lit("#"), "raw_record_id"), F.lit(""))


def _hashes(existing: DataFrame) -> DataFrame:
    return existing.where(F.col("dedup_hash").isNotNull()).select(
        F.col("dedup_hash").alias("group_key")
    )


def _with_known(groups: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Mark the groups whose hash ``existing`` holds."""
    if existing is None:
        return groups.withColumn("known", F.lit(False))
    marked = _hashes(existing).withColumn("seen_before", F.lit(True))
    joined = groups.join(marked, "group_key", "left")
    known = F.coalesce("seen_before", F.lit(False))
    return joined.withColumn("known", known).drop("seen_before")


def first_of_each(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The first row of each duplicate group; rows without a hash all stay.

    ``min_by`` combines before the shuffle, so a hash shared by a large part of
    the input arrives as one row per task. With ``existing`` given, groups whose hash it
    already holds are left out by one anti join on its one column. Where ``existing`` is
    bucketed by hash, as ``Warehouse.hashes`` gives it, it is not shuffled: the groups
    are dealt into its buckets.
    """
    return _firsts(rows, rows.columns, existing).select("first.*")


def _firsts(
    rows: DataFrame, columns: list[str], existing: DataFrame | None = None
) -> DataFrame:
    """``group_key, first``: some columns of the first row of each new group."""
    firsts = rows.groupBy(_group_key().alias("group_key")).agg(
        F.min_by(F.struct(*columns), F.struct(*ORDER, "raw_record_id")).alias("first")
    )
    if existing is not None:
        firsts = firsts.join(_hashes(existing), "group_key", "left_anti")
    return firsts


def normalize(
    raw: DataFrame, registry: Registry, existing: DataFrame | None = None
) -> DataFrame:
    """New normalized rows for pending raw rows.

    Ids follow from the raw ids and hashes are the keys of the groups, so neither is sorted
    and shuffled with the rows.
    """
    rows = build_normalized(raw, registry)
    columns = [name for name in NORMALIZED_COLUMNS if name not in ("id", "dedup_hash")]
    key = F.col("group_key")
    hashed = F.when((key != "") & ~key.startswith("#"), key)
    return (
        _firsts(rows, columns, existing)
        .select("first.*", hashed.alias("dedup_hash"))
        .select(
            *[
                normalized_id(F.col("raw_record_id")).alias(name) if name == "id" else name
                for name in NORMALIZED_COLUMNS
            ]
        )
    )


def tag_duplicates(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Each row's ``raw_record_id``, ``dedup_hash`` and its ``outcome``.

    ``dup_existing``: the hash was there before this run; ``dup_in_run``: an
    earlier row of this run has it; ``kept``: neither.
    """
    # Rows without a hash share one group that is never contested. A null test
    # instead would be pushed down and make Spark compute the hash twice.
    groups = rows.groupBy(F.coalesce("dedup_hash", F.lit("")).alias("group_key")).agg(
        F.min(F.struct(*ORDER, "raw_record_id")).alias("first"),
        F.count("dedup_hash").alias("copies"),
    )
    groups = _with_known(groups, existing)
    contested = groups.where("copies > 1 OR known").select(
        "group_key",
        F.struct(F.col("first.raw_record_id").alias("winner"), "known").alias("verdict"),
        "copies",
    )
    hot = contested.where(F.col("copies") > HOT_ROWS).select(
        F.col("group_key").alias("dedup_hash"), F.col("verdict").alias("hot_verdict")
    )
    # Rows settled by the broadcast, like rows without a hash, get a key of their
    # own, which spreads them evenly and matches nothing.
    settled = F.col("hot_verdict").isNotNull() | F.col("dedup_hash").isNull()
    keyed = (
        rows.select("raw_record_id", "dedup_hash")
        .join(F.broadcast(hot), "dedup_hash", "left")
        .withColumn(
            "group_key",
            F.when(settled, F.concat(F.lit("#"), "raw_record_id")).otherwise(
                F.col("dedup_hash")
            ),
        )
    )
    judged = keyed.join(contested.drop("copies"), "group_key", "left").withColumn(
        "verdict", F.coalesce("hot_verdict", "verdict")
    )
    outcome = (
        F.when(F.col("verdict").isNull(), "kept")
        .when(F.col("verdict.known"), "dup_existing")
        .when(F.col("verdict.winner") == F.col("raw_record_id"), "kept")
        .otherwise("dup_in_run")
    )
    return judged.select("raw_record_id", "dedup_hash", outcome.alias("outcome"))


def run_summary(
    raw: DataFrame, registry: Registry, existing: DataFrame | None = None
) -> DataFrame:
    """One row: processed, skipped_no_normalizer, skipped_duplicate, total_seen."""
    rows = build_normalized(raw, registry)
    groups = rows.groupBy(_group_key().alias("group_key")).agg(
        F.count("*").alias("seen")
    )
    groups = _with_known(groups, existing)
    counted = groups.agg(
        F.count_if(~F.col("known")).alias("processed"),
        F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"),
        F.lit(0).cast("bigint").alias("unknown"),
    ).unionByName(
        unregistered(raw, registry).agg(
            F.lit(0).cast("bigint").alias("processed"),
            F.lit(0).cast("bigint").alias("seen"),
            F.count("*").alias("unknown"),
        )
    )
    return counted.agg(
        F.sum("processed").alias("processed"),
        F.sum("unknown").alias("skipped_no_normalizer"),
        (F.sum("seen") - F.sum("processed")).alias("skipped_duplicate"),
        (F.sum("seen") + F.sum("unknown")).alias("total_seen"),
    )
