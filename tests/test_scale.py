"""Hot groups, numbering against brute force, and the plans behind them."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from leadmill.operators import export, integrity, leads, normalize
from leadmill.plans import jobs
from leadmill.sources.warehouse import LEADS, Warehouse

_ROWS = (
    "raw_record_id STRING, dedup_hash STRING, ingested_at TIMESTAMP, origin STRING,"
    " ingest_seq BIGINT"
)


def _plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def _hot_rows(spark, count=3000):
    """A third in one group, a third without a hash, the rest in small groups."""
    at = F.col("id")
    small = F.concat(F.lit("h"), (at % 400).cast("string"))
    hash_ = F.when(at % 3 == 0, "hot").when(at % 3 == 1, small)
    return spark.range(count).select(
        F.md5(at.cast("string")).alias("raw_record_id"),
        hash_.alias("dedup_hash"),
        F.timestamp_seconds((at * 7) % 50).alias("ingested_at"),
        F.lit("").alias("origin"),
        ((at * 31) % count).alias("ingest_seq"),
    )


def _brute_force(rows, existing):
    seen, outcomes = set(), {}
    ordered = sorted(
        rows.collect(), key=lambda r: (r.ingested_at, r.origin, r.ingest_seq))
    for row in ordered:
        key = row.dedup_hash
        if key is None:
            outcome = "kept"
        elif key in existing:
            outcome = "dup_existing"
        else:
            outcome = "dup_in_run" if key in seen else "kept"
            seen.add(key)
        outcomes[row.raw_record_id] = outcome
    return outcomes


@pytest.mark.parametrize("existing", [set(), {"hot", "h1"}, {"h3", "other"}])
@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_duplicates_of_hot_groups(spark, monkeypatch, existing, hot_rows):
    monkeypatch.setattr(normalize, "HOT_ROWS", hot_rows)
    rows = _hot_rows(spark)
    known = spark.createDataFrame([(h,) for h in existing] + [(None,)], "dedup_hash STRING")
    expected = _brute_force(rows, existing)
    tags = normalize.tag_duplicates(rows, known).collect()
    assert len(tags) == len(expected)
    assert {row.raw_record_id: row.outcome for row in tags} == expected
    kept = normalize.first_of_each(rows, known).collect()
    assert {row.raw_record_id for row in kept} == {
        key for key, outcome in expected.items() if outcome == "kept"}
    assert len(kept) == len({row.raw_record_id for row in kept})


def test_first_of_each_combines_before_one_shuffle(spark):
    rows = _hot_rows(spark)
    plan = _plan(normalize.first_of_each(rows))
    assert plan.count("Exchange") == 1
    assert "partial_min_by" in plan.split("Exchange")[1]
    existing = rows.select("dedup_hash").where("dedup_hash like 'h%'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(normalize.first_of_each(rows, existing))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the rows and, as these are not bucketed, one for the stored hashes; the rows
    # are used once.
    assert plan.count("Exchange") == 2 and "LeftAnti" in plan and "LeftSemi" not in plan


def test_a_small_increment_only_scans_the_stored_hashes(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("dedup_hash"),
                             F.lit("x").alias("other")).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = _plan(normalize.first_of_each(_hot_rows(spark), stored))
    assert "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<dedup_hash:string>" in plan


def _leads(spark, count=5000):
    """A third of all leads share one score."""
    at = F.col("id")
    score = F.when(at % 3 == 0, 20).otherwise(at % 40).cast("int")
    return spark.range(count).select(
        F.md5(at.cast("string")).alias("id"),
        score.alias("score"),
        (at % 11 == 0).alias("exported_to_crm"),
    )


@pytest.mark.parametrize("digits", [1, 3])
def test_numbering_equals_a_plain_sort(spark, monkeypatch, digits):
    monkeypatch.setattr(export, "SLICE_DIGITS", digits)
    rows = _leads(spark)
    wanted = sorted(
        (r for r in rows.collect() if not r.exported_to_crm), key=lambda r: (-r.score, r.id))
    got = export.assign_batches(rows, 7).orderBy("position").collect()
    assert [r.id for r in got] == [r.id for r in wanted]
    assert [r.position for r in got] == list(range(1, len(wanted) + 1))
    assert [r.export_batch for r in got] == [n // 7 for n in range(len(wanted))]


def test_numbering_gathers_only_score_totals(spark):
    plan = _plan(export.number_by_score(_leads(spark)))
    single = [m.start() for m in re.finditer("SinglePartition", plan)]
    # The only gathered input is one row per distinct score.
    for at in single:
        below = plan[at:].split("\n")[1:4]
        assert any("HashAggregate(keys=[score" in line for line in below)
    assert "cartesian" not in plan.lower() and "NestedLoop" not in plan


def test_pages_are_planned_as_top_k(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    path = tmp_path / "x.csv"
    path.write_text("owner_name,city\nAnn Lee,Salem\nJo Doe LLC,Bend\n")
    from leadmill.sources.mappings import KeyMapping

    jobs.ingest_csv(store, str(path), "s")
    jobs.normalize_new(store, {"s": KeyMapping(owner_name="owner_name", city="city")})
    jobs.score_new(store)
    where = leads.LeadFilter(priority="low", state="tx", min_amount=5)
    plan = _plan(leads.list_leads(jobs.current_leads(store), where))
    assert "TakeOrderedAndProject" in plan and "Join" not in plan
    assert re.search(r"PartitionFilters: \[.*priority.*low", plan)
    assert re.search(r"PushedFilters: \[.*state.*TX", plan)
    assert "score_breakdown" not in plan.split("ReadSchema")[1]
    assert store.read(LEADS).count() == 2


def test_duplicate_audit_counts(spark):
    rows = _hot_rows(spark, 300)
    got = {r.dedup_hash: r.copies for r in integrity.repeated(rows, "dedup_hash").collect()}
    assert got == {"hot": 100}


def test_cascade_preview_and_removal_are_complements(spark):
    raw = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", None)], "id STRING, source STRING")
    records = spark.createDataFrame([("n1", "r1"), ("n2", "r2")], "id STRING, raw_record_id STRING")
    scored = spark.createDataFrame([("s1", "n1"), ("s2", "n2")], "id STRING, normalized_record_id STRING")
    condition = F.col("source") == "a"
    left = integrity.cascade(raw, records, scored, condition)
    gone = integrity.cascade(raw, records, scored, condition, remove=False)
    assert [sorted(r.id for r in rows.collect()) for rows in left] == [["r2", "r3"], ["n2"], ["s2"]]
    assert [sorted(r.id for r in rows.collect()) for rows in gone] == [["r1"], ["n1"], ["s1"]]


def test_shuffled_input_gives_the_same_winners(spark):
    rows = _hot_rows(spark, 600)
    data = rows.collect()
    random.Random(3).shuffle(data)
    mixed = spark.createDataFrame(data, _ROWS).repartition(7)
    first = {r.raw_record_id for r in normalize.first_of_each(rows).collect()}
    assert first == {r.raw_record_id for r in normalize.first_of_each(mixed).collect()}
