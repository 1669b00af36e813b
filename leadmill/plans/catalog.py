"""One query per operator, over listings derived from the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from uuid import UUID, uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.functions import address, amounts, identity, names, rules, text
from leadmill.operators import display, export, integrity, leads, normalize, scoring
from leadmill.plans import claims, jobs
from leadmill.plans.session import shared_folder, tune
from leadmill.sources import mappings
from leadmill.sources.csv import LINE_COLUMN, read_csv_source
from leadmill.sources.raw import batch_id, json_cells, wrap_raw
from leadmill.sources.warehouse import HASHES, LEADS, NORMALIZED, RAW, SCORED, Warehouse
from leadmill.streaming.incremental import run_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REGISTRY = claims.REGISTRY
# Rows listed before it count as normalized by an earlier run.
CUTOFF = "1997-01-01 00:00:00"
CREATED = "2000-01-01 00:00:00"
BATCH = "src_a:19960101T000000Z:00000000"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(tune(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


def plain(rows: DataFrame) -> DataFrame:
    """Columns of types every engine shows alike."""
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


# The stages over the derived listings.


def ntz(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claims(spark, sf_dir)


def earlier(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("ingested_at") < ntz(CUTOFF))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(raw_rows(spark, sf_dir), REGISTRY)


def earlier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(earlier(raw_rows(spark, sf_dir)), REGISTRY)


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(records(spark, sf_dir), created_at=ntz(CREATED))


def lead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads, those with a score divisible by three exported already."""
    rows = scoring.score_leads(records(spark, sf_dir), created_at=ntz(CREATED))
    return rows.withColumn("exported_to_crm", F.col("score") % 3 == 0)


def store_in(spark: SparkSession) -> Warehouse:
    """A store of its own for a query, removed when the session ends."""
    root = f"{shared_folder(spark)}/leadmill-{uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return Warehouse(spark, root)


def with_points(rows: DataFrame) -> list[Column]:
    """The breakdown as flat columns."""
    part = F.col("score_breakdown")
    return [
        part["amount_tier"]["matched"].alias("amount_label"),
        part["amount_tier"]["points"].alias("amount_points"),
        part["entity_type"]["points"].alias("entity_points"),
        F.array_join(part["keywords"]["matched"], ",").alias("keywords_matched"),
        part["keywords"]["points"].alias("keyword_points"),
        part["age_years"]["matched_min"].alias("age_min"),
        part["age_years"]["points"].alias("age_points"),
        part["has_address"]["points"].alias("address_points"),
        part["total"].alias("total_points"),
    ]


# Sources and sinks.


@query
def s1_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as CSV files and read back as text cells."""
    path = f"{store_in(spark).root}/csv"
    listings = claims.order_listings(spark, sf_dir).select(*claims.LISTING_CELLS)
    writer = listings.write.option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    cells = read_csv_source(spark, path).select(*claims.LISTING_CELLS)
    return cells.na.fill("")


@query
def s1_csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with columns in another order, and with a cell too many in each row."""
    path = f"{store_in(spark).root}/csv"
    listings = claims.order_listings(spark, sf_dir)
    own = F.col("source") == "src_a"
    for name, rows, cells in (
        ("one", listings.where(own), claims.LISTING_CELLS),
        ("two", listings.where(~own), claims.LISTING_CELLS[::-1]),
    ):
        writer = rows.select(*cells).write.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer.option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{name}")
    suppliers = claims.table(spark, sf_dir, "supplier")
    header = spark.range(1).select(F.lit("owner_name,property_id").alias("line"))
    lines = suppliers.select(F.concat_ws(",", "s_name", "s_suppkey", F.lit("more")).alias("line"))
    sorted_lines = header.withColumn("n", F.lit(0)).unionByName(lines.withColumn("n", F.lit(1)))
    sorted_lines.coalesce(1).sortWithinPartitions("n").select("line").write.text(f"{path}/three")
    rows = read_csv_source(spark, [f"{path}/{name}" for name in ("one", "two", "three")])
    return rows.select(*claims.LISTING_CELLS, F.col(LINE_COLUMN).alias("line")).na.fill("")


@query
def s1_multi_line_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and suppliers as CSV with line breaks, quotes and commas in cells, ingested
    from splits of 128 kB, so that records begin in one split and end in another."""
    store = store_in(spark)
    orders = claims.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("P-"), F.col("o_orderkey").cast("string")).alias("property_id"),
        F.concat(
            F.lit('said "'), "o_orderpriority", F.lit('",\n\n"'), "o_orderstatus", F.lit("\n")
        ).alias("note"),
    )
    suppliers = claims.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("property_id"),
        F.concat("s_name", F.lit("\n,\n"), F.repeat(F.lit("more\n"), 50)).alias("note"),
    )
    writer = orders.unionByName(suppliers).coalesce(2).write.option("header", True)
    writer = writer.option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(f"{store.root}/csv")
    sizes = {
        "spark.sql.files.maxPartitionBytes": str(128 << 10),
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {name: spark.conf.get(name) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        jobs.ingest_csv(store, f"{store.root}/csv", "s")
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)
    cells = F.col("raw_data")
    return store.read(RAW).select(
        cells["property_id"].alias("property_id"),
        F.rtrim(cells["note"], F.lit("\n")).alias("note"),
        F.length(cells["note"]).alias("n_chars"),
        F.size(cells).alias("cells"),
    )


@query
def s2_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_rows(spark, sf_dir)
    owner = F.coalesce(
        F.try_element_at("raw_data", F.lit("owner_name")),
        F.try_element_at("raw_data", F.lit("payee")),
    )
    return raw.select(
        "id",
        "source",
        "ingested_at",
        "file_batch_id",
        "ingest_seq",
        F.size("raw_data").alias("cells"),
        owner.alias("owner_cell"),
    )


@query
def s2_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive as one JSON text each."""
    events = claims.table(spark, sf_dir, "events")
    month = F.date_trunc("month", "ts")
    raw = wrap_raw(
        events,
        source=F.lit("events"),
        file_batch_id=batch_id(F.lit("events"), month, F.lit("00000000")),
        ingested_at=F.col("ts"),
        seq=F.col("event_id"),
        raw_data=json_cells(F.col("props")),
    )
    cell = F.try_element_at("raw_data", F.lit("k"))
    return raw.select("id", "file_batch_id", "ingest_seq", cell.alias("cell"))


@query
def s3_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = claims.order_listings(spark, sf_dir)
    day = F.date_trunc("day", "listed_at")
    made = batch_id(F.col("source"), day, F.substring(F.md5("source"), 1, 8))
    return listings.groupBy(made.alias("file_batch_id")).agg(
        F.count("*").alias("records")
    )


@query
def s4_committed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended whole; one written but never committed stays invisible."""
    store = store_in(spark)
    raw = raw_rows(spark, sf_dir)
    jobs.ingest_raw(store, earlier(raw), "first")
    jobs.ingest_raw(store, raw.where(F.col("ingested_at") >= ntz(CUTOFF)), "second")
    store.write(raw, RAW, "never committed")
    return store.read(RAW).groupBy("source").agg(F.count("*").alias("records"))


@query
def s5_s6_s8_stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized and scored rows appended by two runs and scanned back."""
    store = store_in(spark)
    raw = raw_rows(spark, sf_dir)
    for name, rows in (
        ("first", earlier(raw)),
        ("second", raw.where(F.col("ingested_at") >= ntz(CUTOFF))),
    ):
        jobs.ingest_raw(store, rows, name)
        jobs.normalize_new(store, REGISTRY)
        jobs.score_new(store)
    scored = store.read(SCORED).select("normalized_record_id", "score", "exported_to_crm")
    stored = store.read(NORMALIZED).select(
        F.col("id").alias("normalized_record_id"), "source", "claim_amount"
    )
    return scored.join(stored, "normalized_record_id")


@query
def s7_p6_crm_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload written as JSON lines and read back."""
    store = store_in(spark)
    batched = export.assign_batches(lead_rows(spark, sf_dir))
    export.write_payload(batched, f"{store.root}/payload")
    schema = export.payload_rows(batched).schema
    rows = spark.read.schema(schema).json(f"{store.root}/payload")
    breakdown = F.get_json_object("Score Breakdown", "$.total").cast("int")
    lines = spark.read.text(f"{store.root}/payload")
    keys = F.array_join(F.json_object_keys("value"), ",").alias("keys")
    lead = F.get_json_object("value", "$.lead_id").alias("lead_id")
    return (
        rows.withColumn("breakdown_total", breakdown)
        .drop("Score Breakdown")
        .join(lines.select(lead, keys), "lead_id")
    )


# Projections and extraction.


@query
def p1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = mappings.extract(raw_rows(spark, sf_dir), REGISTRY)
    return fields.select("id", *mappings.COMMON_COLUMNS).na.fill("")


@query
def p2_registry_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_rows(spark, sf_dir)
    known = mappings.extract(raw, REGISTRY).select("source", F.lit(True).alias("known"))
    skipped = mappings.unregistered(raw, REGISTRY).select(
        "source", F.lit(False).alias("known")
    )
    return (
        known.unionByName(skipped)
        .groupBy("source", "known")
        .agg(F.count("*").alias("records"))
    )


@query
def p3_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.build_normalized(raw_rows(spark, sf_dir), REGISTRY)
    return rows.select(*normalize.NORMALIZED_COLUMNS)


@query
def p3_record_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages from the reported year, and the points they earn."""
    aged = normalize.build_normalized(
        raw_rows(spark, sf_dir), REGISTRY, as_of_year=F.lit(2004)
    )
    scored = scoring.apply_rules(aged)
    return scored.groupBy("record_age_years").agg(
        F.count("*").alias("records"),
        F.sum(F.coalesce("score_breakdown.age_years.points", F.lit(0))).alias("points"),
    )


@query
def p4_lead_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.summaries(lead_rows(spark, sf_dir))


@query
def p5_lead_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.lead_detail(lead_rows(spark, sf_dir))
    return rows.select("*", *with_points(rows)).drop("score_breakdown")


@query
def p7_f14_display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.display_rows(lead_rows(spark, sf_dir))


@query
def p7_f14_display_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.display_details(lead_rows(spark, sf_dir))


@query
def p7_display_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head line, of all leads and of none."""
    rows = lead_rows(spark, sf_dir)
    shown = display.display_stats(leads.stats(rows))
    none = display.display_stats(leads.stats(rows.where(F.col("score") < 0)))
    return shown.unionByName(none)


@query
def p8_page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of the leads of each state."""
    totals = lead_rows(spark, sf_dir).groupBy("state").agg(F.count("*").alias("total"))
    return display.page_ranges(totals, F.lit(25))


# Filters.


@query
def w1_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.LeadFilter(priority="high").apply(lead_rows(spark, sf_dir))
    return leads.summaries(rows)


@query
def w2_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.summaries(leads.LeadFilter(state="tx").apply(lead_rows(spark, sf_dir)))


@query
def w3_by_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A minimum of zero leaves out leads without an amount."""
    return leads.summaries(leads.LeadFilter(min_amount=0).apply(lead_rows(spark, sf_dir)))


@query
def w4_w8_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = leads.LeadFilter(priority="medium", state="NY", min_amount="1000.00")
    return leads.summaries(where.apply(lead_rows(spark, sf_dir)))


@query
def w5_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.summaries(leads.pending(lead_rows(spark, sf_dir)))


@query
def w6_exported_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.exported_count(lead_rows(spark, sf_dir))


@query
def w7_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lead of the stored layer, by the id that follows from its raw row's key."""
    store = store_in(spark)
    store.write(lead_rows(spark, sf_dir), SCORED, "all")
    wanted = "|".join(["src_s", "src_s:19990101T000000Z:00000000", "", "0"])
    for step in ("", "normalized|", "lead|"):
        wanted = str(UUID(hashlib.md5(f"{step}{wanted}".encode()).hexdigest()))
    found = leads.lead_detail(store.read(LEADS, ["all"]), wanted)
    return found.select("*", *with_points(found)).drop("score_breakdown")


@query
def w9_j4_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.of_batch(lead_rows(spark, sf_dir), raw_rows(spark, sf_dir), BATCH)
    return rows.select("file_batch_id", "id", "owner_name", "score", "priority")


# Joins.


@query
def j1_not_yet_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = normalize.not_yet_normalized(
        raw_rows(spark, sf_dir), earlier_records(spark, sf_dir)
    )
    return pending.select("id", "source", "ingest_seq")


@query
def j2_c10_not_yet_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the records that an earlier run has not scored."""
    done = scoring.score(earlier_records(spark, sf_dir))
    pending = scoring.not_yet_scored(records(spark, sf_dir), done)
    return scoring.score(pending).select("id", "normalized_record_id", "score", "priority")


@query
def j3_p4_scored_with_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.join_leads(scored_rows(spark, sf_dir), records(spark, sf_dir))
    return leads.summaries(rows)


@query
def j4_three_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.join_leads(scored_rows(spark, sf_dir), records(spark, sf_dir))
    raw = raw_rows(spark, sf_dir).select(
        F.col("id").alias("raw_record_id"), "file_batch_id"
    )
    return (
        rows.join(raw, "raw_record_id")
        .groupBy("file_batch_id", "priority")
        .agg(F.count("*").alias("leads"), F.max("score").alias("best"))
    )


@query
def j5_a3_claim_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = leads.join_leads(scored_rows(spark, sf_dir), records(spark, sf_dir))
    total = F.coalesce(F.sum("claim_amount"), F.lit(0)).cast("decimal(24,2)")
    return rows.agg(total.alias("total_claim_amount"))


@query
def j6_new_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run keeps when an earlier one is stored already."""
    done = earlier_records(spark, sf_dir)
    pending = normalize.not_yet_normalized(raw_rows(spark, sf_dir), done)
    kept = normalize.normalize(pending, REGISTRY, done)
    return kept.select("id", "raw_record_id", "dedup_hash", "source")


@query
def j7_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left in each layer, and rows gone, when one source is removed."""
    layers = (
        raw_rows(spark, sf_dir),
        records(spark, sf_dir),
        scored_rows(spark, sf_dir),
    )
    condition = F.col("source") == "src_b"
    sides = (("left", True), ("removed", False))
    parts = []
    for side, remove in sides:
        results = integrity.cascade(*layers, condition, remove=remove)
        for layer, rows in zip((RAW, NORMALIZED, SCORED), results, strict=True):
            parts.append(
                rows.agg(F.count("*").alias("records")).select(
                    F.lit(layer).alias("layer"), F.lit(side).alias("side"), "records"
                )
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def j7_removed_and_loaded_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each layer and pending leads after a batch was exported, removed, loaded
    again and taken through all stages once more."""
    store = store_in(spark)
    jobs.ingest_raw(store, claims.order_claims(spark, sf_dir), "orders")
    jobs.ingest_raw(store, claims.supplier_claims(spark, sf_dir), "suppliers")
    counts = []

    def note(step: str) -> None:
        layers = [(name, store.read(name)) for name in (RAW, NORMALIZED, SCORED)]
        layers.append(("pending", leads.pending(jobs.current_leads(store))))
        counts.extend(
            rows.agg(F.count("*").alias("records")).select(
                F.lit(step).alias("step"), F.lit(name).alias("layer"), "records"
            )
            for name, rows in layers
        )

    jobs.normalize_new(store, REGISTRY)
    jobs.score_new(store)
    pushed = jobs.current_leads(store).select(
        F.col("id").alias("lead_id"), F.col("id").alias("external_id"), F.lit(True).alias("ok")
    )
    jobs.record_results(store, pushed)
    note("exported")
    jobs.remove_raw(store, F.col("source") == "src_s")
    note("removed")
    jobs.ingest_raw(store, claims.supplier_claims(spark, sf_dir), "suppliers")
    jobs.normalize_new(store, REGISTRY)
    jobs.score_new(store)
    note("again")
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


# Aggregations.


@query
def a1_a4_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.stats(lead_rows(spark, sf_dir))


@query
def a2_count_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leads, by default rules and by rules under which none is high."""
    found = records(spark, sf_dir)
    strict = {**rules.DEFAULT_RULES, "priority_thresholds": {"high": 1000, "medium": 25}}
    parts = [
        scoring.count_by_priority(scoring.score(found, chosen)).withColumn("rules", F.lit(name))
        for name, chosen in (("default", rules.DEFAULT_RULES), ("strict", strict))
    ]
    return parts[0].unionByName(parts[1])


@query
def a5_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = leads.LeadFilter(state="ca", min_amount=5000)
    return leads.filtered_count(lead_rows(spark, sf_dir), where)


@query
def a6_normalize_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = earlier_records(spark, sf_dir)
    pending = normalize.not_yet_normalized(raw_rows(spark, sf_dir), done)
    return normalize.run_summary(pending, REGISTRY, done)


@query
def a7_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_summary(scored_rows(spark, sf_dir))


@query
def a8_export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pushed = export.assign_batches(lead_rows(spark, sf_dir))
    return export.export_summary(pushed, pushed_results(pushed))


@query
def a9_ingest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_rows(spark, sf_dir).groupBy("file_batch_id").agg(F.count("*").alias("records"))
    )


# Duplicates, numbering, order.


@query
def n1_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("id", "raw_record_id", "dedup_hash", "source")


@query
def n2_duplicate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = earlier_records(spark, sf_dir)
    pending = normalize.not_yet_normalized(raw_rows(spark, sf_dir), done)
    return normalize.tag_duplicates(normalize.build_normalized(pending, REGISTRY), done)


@query
def n3_e2_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = export.assign_batches(lead_rows(spark, sf_dir))
    return batched.select("id", "score", "position", "export_batch")


@query
def o1_o2_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = leads.Page(limit=50, offset=100)
    return leads.list_leads(lead_rows(spark, sf_dir), page=page)


@query
def o2_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that starts after a place in the order instead of a number of rows."""
    return leads.list_after(lead_rows(spark, sf_dir), 30, "8", limit=50)


@query
def o3_page_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = leads.LeadFilter(priority="medium")
    page = leads.lead_page(lead_rows(spark, sf_dir), where, leads.Page(25, 25))
    ids = F.array_join(F.transform("items", lambda item: item["id"]), ",")
    return page.select(ids.alias("ids"), "total", "limit", "offset")


@query
def o4_work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every raw row in the order a run takes them."""
    ordered = normalize.work_order(raw_rows(spark, sf_dir))
    return ordered.select("id", "ingested_at", "position")


# Field rules.


@query
def f1_f6_clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = mappings.extract(raw_rows(spark, sf_dir), REGISTRY)
    return fields.select(
        "id",
        text.normalize_name(F.col("owner_name")).alias("name"),
        amounts.parse_amount(F.col("claim_amount_text")).alias("amount"),
        text.clean_text(F.col("property_type")).alias("property_type"),
        text.clean_state(F.col("state")).alias("state"),
        text.clean_zip(F.col("zip")).alias("zip"),
    )


@query
def f2_entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = mappings.extract(raw_rows(spark, sf_dir), REGISTRY)
    named = fields.select(text.normalize_name(F.col("owner_name")).alias("name"))
    return named.groupBy(
        names.detect_entity_type(F.col("name")).alias("entity_type")
    ).agg(F.count("*").alias("records"), F.count("name").alias("named"))


@query
def f7_split_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = mappings.extract(raw_rows(spark, sf_dir), REGISTRY)
    split = fields.withColumn("parts", address.split_address(F.col("address_line1")))
    return split.select("id", "parts.*")


@query
def f7_freeform_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of all orders, put together in ten forms and taken apart again."""
    orders = claims.table(spark, sf_dir, "orders")
    forms = claims.freeform_addresses(spark, sf_dir, orders)
    split = forms.withColumn("parts", address.split_address(F.col("written")))
    return split.select("o_orderkey", "parts.*")


@query
def f8_merged_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.build_normalized(raw_rows(spark, sf_dir), REGISTRY)
    return rows.select("raw_record_id", "address_line1", "city", "state", "zip")


@query
def f9_dedup_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = mappings.extract(raw_rows(spark, sf_dir), REGISTRY)
    key = identity.dedup_hash(
        F.col("owner_name"),
        F.col("address_line1"),
        amounts.parse_amount(F.col("claim_amount_text")),
    )
    return fields.select("id", key.alias("dedup_hash"))


@query
def f10_amount_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = claims.order_listings(spark, sf_dir)
    return listings.select(
        "seq", amounts.lower_bound_text(F.col("claim_amount")).alias("amount_text")
    )


@query
def f11_f12_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords found in names, and their points when spelled in capitals."""
    listings = claims.order_listings(spark, sf_dir)
    found = listings.select(
        "seq", names.find_name_keywords(F.col("owner_name")).alias("keywords_found")
    )
    capitals = F.transform("keywords_found", F.upper)
    entry = rules.keyword_entry(F.col("capitals"), rules.DEFAULT_RULES)
    return (
        found.withColumn("capitals", capitals)
        .select("seq", "keywords_found", entry.alias("entry"))
        .select("seq", "keywords_found", "entry.matched", "entry.points")
    )


@query
def f13_breakdown_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breakdown as JSON text: only rules that fired appear in it."""
    rows = scored_rows(spark, sf_dir)
    document = F.to_json("score_breakdown")
    return rows.select(
        "id",
        F.get_json_object(document, "$.total").cast("int").alias("total"),
        document.contains('"amount_tier"').alias("has_amount"),
        document.contains('"keywords"').alias("has_keywords"),
        document.contains('"age_years"').alias("has_age"),
    )


# Scoring.


@query
def c1_c8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_rows(spark, sf_dir)
    return rows.select("id", "score", "priority", *with_points(rows))


@query
def c4_c9_custom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other rules: unsorted tiers, ages, no address section, one threshold."""
    custom = {
        "amount_tiers": [
            {"min": 100, "points": 3, "label": "some"},
            {"min": 10000, "points": 30, "label": "never reached"},
        ],
        "entity_type": {"business": 7, "estate": 9},
        "keywords": {"Heir": 11, "trust": 2},
        "age_years": [{"min": 8, "points": 6}, {"min": 6, "points": 4}],
        "priority_thresholds": {"medium": 12},
    }
    aged = normalize.build_normalized(
        raw_rows(spark, sf_dir), REGISTRY, as_of_year=F.lit(2004)
    )
    rows = scoring.apply_rules(normalize.first_of_each(aged), custom)
    return rows.select("id", "score", "priority", *with_points(rows))


@query
def c11_rescore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scores replaced under lower thresholds, in a stored warehouse."""
    store = store_in(spark)
    jobs.ingest_raw(store, raw_rows(spark, sf_dir), "all")
    jobs.normalize_new(store, REGISTRY)
    jobs.score_new(store)
    lower = {**rules.DEFAULT_RULES, "priority_thresholds": {"high": 30, "medium": 15}}
    jobs.rescore_all(store, lower)
    return scoring.count_by_priority(store.read(SCORED))


# Export.


def pushed_results(batched: DataFrame) -> DataFrame:
    """Outcome of a push in which every third batch fails."""
    return batched.select(
        F.col("id").alias("lead_id"),
        F.concat(F.lit("rec"), "id").alias("external_id"),
        (F.col("export_batch") % 3 != 1).alias("ok"),
        ntz(CREATED).alias("exported_at"),
    )


@query
def e1_o5_pending_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.select_pending(lead_rows(spark, sf_dir)).select("id", "score")


@query
def e3_payload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = export.payload_batches(export.assign_batches(lead_rows(spark, sf_dir)))
    ids = F.array_join(F.transform("records", lambda record: record["lead_id"]), ",")
    return batches.select("export_batch", "leads", ids.alias("ids"))


@query
def e4_applied_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_rows(spark, sf_dir)
    results = pushed_results(export.assign_batches(scored))
    applied = export.apply_results(
        scored.withColumn("exported_at", F.col("exported_at").cast("timestamp_ntz")),
        results,
    )
    return applied.select("id", "exported_to_crm", "exported_at", "crm_record_id")


def pushed_store(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All leads stored by two runs, pushed, the results recorded and folded in."""
    store = store_in(spark)
    raw = raw_rows(spark, sf_dir)
    for name, rows in (
        ("first", earlier(raw)),
        ("second", raw.where(F.col("ingested_at") >= ntz(CUTOFF))),
    ):
        jobs.ingest_raw(store, rows, name)
        jobs.normalize_new(store, REGISTRY)
        jobs.score_new(store)
    results = pushed_results(jobs.export_batches(store)).drop("exported_at").persist()
    # Each half of the batches is recorded by itself.
    for half in (0, 1):
        jobs.record_results(store, results.where(F.crc32("lead_id") % 2 == half))
    results.unpersist()
    jobs.fold_results(store)
    return store


@query
def e4_folded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads of a store whose export results are folded in."""
    rows = jobs.current_leads(pushed_store(spark, sf_dir))
    exported = F.col("exported_at").isNotNull().alias("has_time")
    return rows.select("id", "exported_to_crm", exported, "crm_record_id")


@query
def a1_a4_stored_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of that store, added up from its log."""
    return jobs.current_stats(pushed_store(spark, sf_dir))


@query
def o2_o3_stored_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far down the list of that store: its items, and the total."""
    store = pushed_store(spark, sf_dir)
    where, page = leads.LeadFilter(priority="low"), leads.Page(limit=200, offset=1500)
    row = jobs.lead_page(store, where, page)
    return row.select(F.explode("items").alias("item"), "total").select("item.*", "total")


@query
def j6_n1_stored_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed hashes after two runs and a merge of their folders."""
    store = store_in(spark)
    raw = raw_rows(spark, sf_dir)
    for name, rows in (
        ("first", earlier(raw)),
        ("second", raw.where(F.col("ingested_at") >= ntz(CUTOFF))),
    ):
        jobs.ingest_raw(store, rows, name)
        jobs.normalize_new(store, REGISTRY)
    jobs.merge_folders(store, most=1)
    return store.hashes(store.state())


@query
def e5_next_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second export selects: the leads of the failed batches."""
    rows = lead_rows(spark, sf_dir)
    results = pushed_results(export.assign_batches(rows))
    applied = export.apply_results(rows, results)
    return export.assign_batches(applied).select("id", "position", "export_batch")


# Integrity.


@query
def k1_column_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule on columns of each layer; the store name is checked tightly too."""
    rows = normalize.build_normalized(raw_rows(spark, sf_dir), REGISTRY)
    audits = {
        RAW: integrity.audit_raw(raw_rows(spark, sf_dir)),
        NORMALIZED: integrity.audit_normalized(rows),
        SCORED: integrity.audit_scored(scored_rows(spark, sf_dir)),
        "strict": integrity.audit_columns(
            rows,
            ("dedup_hash", "state"),
            {"owner_name_normalized": 22},
            {"entity_type": ("individual", "business")},
        ),
    }
    parts = [
        audit.select(F.lit(layer).alias("layer"), "check", "breaches")
        for layer, audit in audits.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def k2_repeated_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.build_normalized(raw_rows(spark, sf_dir), REGISTRY)
    return integrity.repeated(rows, "dedup_hash")


@query
def k2_new_repeated_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of orders listed again late, stored past the probe after a clean check."""
    store = store_in(spark)
    done = earlier_records(spark, sf_dir)
    late = raw_rows(spark, sf_dir).where(F.col("ingested_at") >= ntz(CUTOFF))
    fresh = normalize.normalize(late, REGISTRY)
    for name, rows in (("first", done), ("second", fresh)):
        folder = store.write_hashes(rows, store.buckets(store.state()))
        store.commit(name, add={HASHES: [folder]})
        if name == "first":
            jobs.check_hashes(store)
    return jobs.repeated_hashes(store)


@query
def k2_repeated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records scored twice, when late rows are scored by two runs."""
    rows = records(spark, sf_dir)
    twice = rows.unionByName(rows.where(F.col("source") == "src_s"))
    return integrity.repeated(scoring.score(twice), "normalized_record_id")


@query
def k3_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = earlier(raw_rows(spark, sf_dir))
    rows = integrity.orphans(records(spark, sf_dir), lost, "raw_record_id")
    return rows.groupBy("source").agg(F.count("*").alias("orphans"))


# The stages as one stream.


@query
def m1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, then suppliers, as streams, run twice; the second runs find nothing new."""
    store = store_in(spark)

    def orders(rows: DataFrame, batch: str) -> DataFrame:
        return claims.order_claims(spark, sf_dir, rows)

    def suppliers(rows: DataFrame, batch: str) -> DataFrame:
        return claims.supplier_claims(spark, sf_dir, rows)

    for _ in range(2):
        for name, wrap in (("orders", orders), ("supplier", suppliers)):
            stream = (
                spark.readStream.schema(claims.table(spark, sf_dir, name).schema)
                .option("pathGlobFilter", f"{name}.parquet")
                .parquet(sf_dir)
            )
            checkpoint = f"{store.root}/checkpoint-{name}"
            run_available(store, stream, wrap, name, checkpoint, REGISTRY)
    return leads.summaries(jobs.current_leads(store))


@query
def m1_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches through all stages, then one run more that adds nothing."""
    store = store_in(spark)
    raw = raw_rows(spark, sf_dir)
    summaries = []
    for name, rows in (
        ("first", earlier(raw)),
        ("second", raw.where(F.col("ingested_at") >= ntz(CUTOFF))),
        ("third", None),
    ):
        if rows is not None:
            jobs.ingest_raw(store, rows, name)
        done = jobs.normalize_new(store, REGISTRY)
        scored = jobs.score_new(store)
        summaries.append(
            (
                name,
                done.processed,
                done.skipped_no_normalizer,
                done.skipped_duplicate,
                done.total_seen,
                scored.processed,
            )
        )
    return spark.createDataFrame(
        summaries,
        "run STRING, processed BIGINT, skipped_no_normalizer BIGINT,"
        " skipped_duplicate BIGINT, total_seen BIGINT, scored BIGINT",
    )


@query
def top_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best fifty leads of all listings."""
    return leads.list_leads(lead_rows(spark, sf_dir))
