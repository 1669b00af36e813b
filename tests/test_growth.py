"""What is shuffled, sorted and written does not grow faster than it must."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadmill import schemas
from leadmill.functions.identity import packed, unpacked
from leadmill.operators import normalize
from leadmill.plans import jobs
from leadmill.plans.session import tune
from leadmill.sources.mappings import LISTING
from leadmill.sources.warehouse import HASHES, LEADS, LEFTOVER, NORMALIZED, RAW, SCORED, Warehouse

REGISTRY = {"a": LISTING, "b": LISTING}


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(tune(spark), str(tmp_path / "store"), hash_buckets=3)


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _raw(spark, source, names):
    """One row a name; the id tells source and place."""
    at = datetime(2020, 1, 1)
    rows = [(f"{source}{i}", source, {"owner_name": name, "claim_amount": "10"}, at, source, "", ord(source[0]) * 10 + i)
            for i, name in enumerate(names)]
    return spark.createDataFrame(rows, schemas.RAW)


def _fill(store, spark):
    rows = _raw(spark, "a", ["Mara", "Felix", "Mara"]).unionByName(
        _raw(spark, "b", ["Felix", "Otto"])).unionByName(_raw(spark, "other", ["Mara", "Ida"]))
    jobs.ingest_raw(store, rows, "all")
    result = jobs.normalize_new(store, REGISTRY)
    jobs.score_new(store)
    return result


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _written(store, monkeypatch):
    """The plans of what is written from now on, by layer."""
    plans, write = {}, store.write

    def noted(rows, layer, run):
        plans.setdefault(layer, []).append(_plan(rows))
        write(rows, layer, run)

    monkeypatch.setattr(store, "write", noted)
    return plans


def test_removal_shuffles_no_layer(store, spark, monkeypatch, shuffled_joins):
    _fill(store, spark)
    leads = jobs.current_leads(store)
    jobs.record_results(store, leads.select(
        F.col("id").alias("lead_id"), F.lit("x").alias("external_id"), F.lit(True).alias("ok")))
    plans = _written(store, monkeypatch)
    jobs.remove_raw(store, F.col("source") == "b")
    for layer in (NORMALIZED, SCORED, "results"):
        assert len(plans[layer]) == 1
        assert "Exchange hashpartitioning" not in plans[layer][0]
    assert {r.owner_name for r in store.read(LEADS).collect()} == {"MARA", "FELIX"}
    assert store.read("results").count() == 2 and store.read(HASHES).count() == 2
    assert not any(r.source == "b" for r in store.read(RAW).collect())


def test_removal_of_more_ids_than_are_broadcast(store, spark, monkeypatch):
    monkeypatch.setattr(jobs, "MOST_BROADCAST", 0)
    _fill(store, spark)
    jobs.remove_raw(store, F.col("source") == "b")
    assert {r.owner_name for r in store.read(NORMALIZED).select(
        F.col("owner_name_normalized").alias("owner_name")).collect()} == {"MARA", "FELIX"}
    assert store.read(LEADS).count() == 2 and store.read(HASHES).count() == 2


def test_rows_of_other_sources_are_not_shuffled(store, spark, monkeypatch, shuffled_joins):
    plans = _written(store, monkeypatch)
    result = _fill(store, spark)
    assert result == jobs.NormalizeResult(3, 2, 2, 7)
    assert sorted(r.id for r in store.read(LEFTOVER).collect()) == [
        "a2", "b0", "other0", "other1"]
    others, doubles = normalize.leftover(store.read(RAW), REGISTRY, store.read(NORMALIZED))
    assert "Exchange" not in _plan(others)
    assert _plan(doubles).count("Exchange hashpartitioning") == 2  # the rows, the ids
    # The rows of the duplicates are taken once, not for their ids and then once more.
    assert plans[LEFTOVER][0].count("Exchange hashpartitioning") == 3  # and by source


def test_leftover_keeps_rows_without_a_source(spark):
    raw = _raw(spark, "a", ["Mara"]).unionByName(
        _raw(spark, "a", ["Ida"]).withColumn("source", F.lit(None)).withColumn("id", F.lit("n")))
    normal = spark.createDataFrame([("a0",)], "raw_record_id STRING")
    others, doubles = normalize.leftover(raw, REGISTRY, normal)
    assert [r.id for r in others.collect()] == ["n"] and doubles.count() == 0


@pytest.mark.parametrize("name", ["{0}", "{0:08x}-0000-4000-8000-00000000abcd"])
def test_rows_with_children_are_not_shuffled_to_find_duplicates(spark, shuffled_joins, name):
    ids = [name.format(at) for at in range(400)]
    raw = _raw(spark, "a", ["Mara"] * 400).toDF("at", *_raw(spark, "a", ["x"]).columns[1:])
    names = spark.createDataFrame([(f"a{at}", ids[at]) for at in range(400)], "at STRING, id STRING")
    raw = raw.join(names, "at").select("id", *raw.columns[1:])
    lost = raw.limit(1).withColumn("id", F.lit(None).cast("string"))
    raw = raw.unionByName(lost).persist()
    children = [(one,) for at, one in enumerate(ids) if at % 40]
    normal = spark.createDataFrame(children, "raw_record_id STRING")
    found = normalize.childless_bits(raw, REGISTRY, normal)
    bits = spark.createDataFrame(found.collect(), found.schema)
    likely = normalize._with_bit_set(raw, bits)
    assert {r.id for r in likely.collect()} >= set(ids[::40]) and likely.count() < 20
    others, doubles = normalize.leftover(raw, REGISTRY, normal, bits)
    assert sorted(r.id for r in doubles.collect()) == sorted(ids[::40])
    assert doubles.columns == raw.columns and others.count() == 0
    plan = _plan(normalize.leftover(raw, REGISTRY, normal, bits)[1])
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # filtered first
    raw.unpersist()


def test_leftover_of_many_rows(store, spark, monkeypatch, shuffled_joins):
    monkeypatch.setattr(jobs, "MOST_BROADCAST", 0)
    plans = _written(store, monkeypatch)
    assert _fill(store, spark) == jobs.NormalizeResult(3, 2, 2, 7)
    assert sorted(r.id for r in store.read(LEFTOVER).collect()) == [
        "a2", "b0", "other0", "other1"]
    assert "__bitmap" in plans[LEFTOVER][0]  # whole rows are filtered before their join


def test_folders_are_found_by_some_of_the_pushed_ids(store, spark, monkeypatch):
    _fill(store, spark)
    held = store.live(LEADS)
    read = []
    keep = store.read
    monkeypatch.setattr(store, "read", lambda *args, **options: read.append(args) or keep(*args, **options))
    done = keep(LEADS).select(packed(F.col("id")).alias("id"))
    assert jobs._touched(store, held, done) == sorted(held) and len(read) == 1
    monkeypatch.setattr(jobs, "PROBED", 0)  # all ids are joined where some were not enough
    assert jobs._touched(store, held, done) == sorted(held)
    assert jobs._touched(store, held, done.where("false")) == []


def test_duplicates_are_sorted_without_id_and_hash(spark):
    rows = normalize.normalize(_raw(spark, "a", ["Mara", "Felix", "Mara", ""]), REGISTRY)
    below = _plan(rows).split("Exchange")[1]
    exchanged = below.split("partial_min_by(")[1].split("partial_min_by")[0]
    assert "dedup_hash" not in exchanged.split("), struct(")[0]
    found = {r.raw_record_id: r for r in rows.collect()}
    every = {r.raw_record_id: r for r in normalize.build_normalized(
        _raw(spark, "a", ["Mara", "Felix", "Mara", ""]), REGISTRY).collect()}
    assert set(found) == {"a0", "a1", "a3"}
    for key, row in found.items():
        assert (row.id, row.dedup_hash) == (every[key].id, every[key].dedup_hash)


def test_packed_text_is_short_and_comes_back(spark):
    uuid, digest = "00ff10ab-1234-abcd-0099-0123456789ab", "0a" * 32
    odd = ["", "A0", "a0", "a", "a0\n", f"{uuid}\n", uuid.upper(), "00", "\x00", "\x01", "é-", None]
    rows = spark.createDataFrame([(x,) for x in [uuid, digest, *odd]], "x STRING")
    done = rows.select("x", packed(F.col("x")).alias("p")).withColumn("y", unpacked(F.col("p")))
    found = done.collect()
    assert [r.x for r in found] == [r.y for r in found]
    assert len({r.p if r.p is None else bytes(r.p) for r in found}) == len(found)
    assert [len(r.p) for r in found if r.x in (uuid, digest)] == [17, 33]


def test_hashes_lie_in_their_buckets(store, spark):
    rows = spark.range(60).select(
        F.sha2(F.col("id").cast("string"), 256).alias("dedup_hash"), F.col("id").cast("string"))
    folder = store.write_hashes(rows, 3)
    bucket = F.expr("pmod(hash(dedup_hash), 3)")
    for number in range(3):
        held = store.read_buckets([folder], [number])
        assert [r[0] for r in held.select(bucket).distinct().collect()] == [number]
    assert store.read(HASHES, [folder]).count() == 60


def test_folders_by_source_are_written_without_a_sort(store, spark):
    _fill(store, spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    for layer in (RAW, NORMALIZED, SCORED):
        files = store.spark.read.parquet(f"{store.root}/{layer}").inputFiles()
        assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_folded_results_by_ids_of_any_form(store, spark):
    _fill(store, spark)
    ids = sorted(r.id for r in store.read(LEADS).collect())
    results = [(ids[0], "x", True), (ids[1], "y", False), ("no lead", "z", True)]
    jobs.record_results(store, spark.createDataFrame(results, "lead_id STRING, external_id STRING, ok BOOLEAN"))
    before = {r.id: r for r in jobs.current_leads(store).collect()}
    assert jobs.fold_results(store) == 3
    assert {r.id: r for r in store.read(LEADS).collect()} == before
    assert [r.crm_record_id for r in before.values() if r.exported_to_crm] == ["x"]
