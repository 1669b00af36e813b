"""The stages as jobs over a warehouse; each handles only what is new.

A stage knows which folders of the layer before it has covered, so a run reads
new folders only and needs no join against all that was done before. Raw rows
without a normalized child, duplicates and rows of unregistered sources, are kept
in ``leftover`` for runs that may judge them differently.

Several jobs may run at a time. One that loses against another is done again from what
the log says then, as long as they touch the same rows; else both are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from decimal import Decimal
from typing import Any, TypeVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.identity import packed, unpacked
from leadmill.functions.rules import DEFAULT_RULES, PRIORITIES
from leadmill.operators import export, leads, normalize, scoring
from leadmill.sources.csv import read_csv_groups
from leadmill.sources.mappings import (
    DEFAULT_REGISTRY,
    Registry,
    fingerprint,
    unregistered,
)
from leadmill.sources.raw import new_batch_id, wrap_raw
from leadmill.sources.warehouse import (
    HASHES,
    LEADS,
    LEFTOVER,
    NORMALIZED,
    RANKS,
    RAW,
    RESULTS,
    SCORED,
    CommitConflict,
    State,
    Warehouse,
)

# Columns of leads that hold hex digits; most of a row when it is shuffled.
_LEAD_KEYS = ("id", "normalized_record_id", "raw_record_id", "dedup_hash")
# So many removed ids are broadcast, some 100 MB; more are shuffled.
MOST_BROADCAST = 500_000
# So many pushed ids are looked for in all folders before the others.
PROBED = 10_000
# How often a job is done again because another one was faster.
TRIES = 10
# Results of so many pushes are joined when leads are read; then they are folded in.
FOLD_AFTER = 20
# Folders of a layer after ``merge_folders``.
MOST_FOLDERS = 16

T = TypeVar("T")


@dataclass(frozen=True)
class IngestResult:
    file_batch_id: str
    count: int


@dataclass(frozen=True)
class NormalizeResult:
    processed: int
    skipped_no_normalizer: int
    skipped_duplicate: int
    total_seen: int


@dataclass(frozen=True)
class ScoreResult:
    processed: int
    by_priority: dict[str, int]


@dataclass(frozen=True)
class ExportResult:
    exported: int
    failed: int
    total_seen: int


def _run_name(stage: str) -> str:
    return f"{stage}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"


def _now(at: datetime | None) -> Column:
    return F.lit(at or datetime.now(timezone.utc)).cast("timestamp")


def _until_committed(store: Warehouse, job: Callable[[State], T]) -> T:
    """Do a job from the state of the log, again if another one changed it too much."""
    for _ in range(TRIES - 1):
        try:
            return job(store.state())
        except CommitConflict:
            continue
    return job(store.state())


def ingest_raw(store: Warehouse, raw: DataFrame, batch: str) -> IngestResult:
    """Append one batch of wrapped rows, whole or not at all.

    A batch whose rows are in the store is left alone, so a replay is harmless. One that
    was removed as a whole may come again: its rows go into a new folder and are new to
    all later stages.
    """

    def job(state: State) -> IngestResult:
        if state.holds(batch):
            return IngestResult(batch, _batch_rows(store, state, batch))
        folder = batch if batch not in state.runs else _run_name(f"again-{batch}")
        store.write(raw, RAW, folder)
        moved = {} if folder == batch else {batch: folder}
        count = store.count(RAW, folder)
        store.commit(batch, add={RAW: [folder]}, moved=moved, state=state)
        return IngestResult(batch, count)

    return _until_committed(store, job)


def _batch_rows(store: Warehouse, state: State, batch: str) -> int:
    if batch in state.live.get(RAW, []):
        return store.count(RAW, batch)
    # What a removal or a merge left of several batches may share a folder.
    rows = store.read(RAW, [state.moved[batch]])
    return rows.where(F.col("file_batch_id") == batch).agg(F.count("*")).first()[0]


def ingest_csv(
    store: Warehouse,
    path: str | list[str],
    source: str,
    encoding: str = "utf-8",
    multi_line: bool = True,
    batch: str | None = None,
    at: datetime | None = None,
) -> IngestResult:
    at = at or datetime.now(timezone.utc)
    batch = batch or new_batch_id(source, at)
    # Each file is read by its own header.
    groups = read_csv_groups(store.spark, path, encoding, multi_line)
    parts = [wrap_raw(rows, F.lit(source), F.lit(batch), _now(at)) for rows in groups]
    raw = parts[0] if parts else store.read(RAW, [])
    for part in parts[1:]:
        raw = raw.unionByName(part)
    return ingest_raw(store, raw, batch)


def normalize_new(
    store: Warehouse,
    registry: Registry = DEFAULT_REGISTRY,
    run: str | None = None,
    at: datetime | None = None,
    recheck: bool | None = None,
) -> NormalizeResult:
    """Normalize raw rows that have no child yet; all of it appears at once.

    Rows left over by earlier runs count as seen again each time. They can only
    fare differently once mappings have changed or rows were removed, so they are
    computed again just then, or when ``recheck`` says so.
    """
    run = run or _run_name("normalize")

    def job(state: State) -> NormalizeResult:
        if run in state.runs:
            return NormalizeResult(**state.runs[run])
        used = fingerprint(registry)
        again = recheck
        if again is None:
            again = state.removed or state.mappings != used
        fresh = [name for name in state.live.get(RAW, []) if name not in state.covered]
        waiting = state.live.get(LEFTOVER, [])
        left = waiting if again else []
        seen = store.read(RAW, fresh)
        if left:
            seen = seen.unionByName(store.read(LEFTOVER, left))

        kept = normalize.normalize(seen, registry, store.hashes(state))
        store.write(kept.withColumn("created_at", _now(at)), NORMALIZED, run)
        written = store.read(NORMALIZED, [run])
        buckets = store.buckets(state)
        hashed = store.write_hashes(written, buckets)
        bits = None
        if store.count(NORMALIZED, run) > MOST_BROADCAST:  # else their ids may be broadcast
            found = normalize.childless_bits(seen, registry, written)
            bits = store.spark.createDataFrame(found.collect(), found.schema)
        others, doubles = normalize.leftover(seen, registry, written, bits)
        # Rows of other sources stay in the tasks that read them, source by source.
        leftover = others.unionByName(doubles.hint("rebalance", "source"))
        store.write(leftover, LEFTOVER, run)

        over = [name for name in waiting if name not in left] + [run]
        rows = store.read(LEFTOVER, over)
        unknown = unregistered(rows, registry).agg(F.count("*")).first()[0]
        skipped = rows.agg(F.count("*")).first()[0]
        processed = store.count(NORMALIZED, run)
        result = NormalizeResult(processed, unknown, skipped - unknown, processed + skipped)
        store.commit(
            run,
            add={NORMALIZED: [run], HASHES: [hashed], LEFTOVER: [run]},
            retire={LEFTOVER: left},
            covers=fresh,
            mappings=used,
            counts=asdict(result),
            buckets=buckets,
            state=state,
            reads={RAW: fresh, HASHES: state.live.get(HASHES, [])},
            whole=[NORMALIZED],
        )
        return result

    return _until_committed(store, job)


def score_new(
    store: Warehouse,
    rules: Mapping[str, Any] = DEFAULT_RULES,
    run: str | None = None,
    at: datetime | None = None,
) -> ScoreResult:
    """Score normalized rows that have no score yet."""
    run = run or _run_name("score")

    def job(state: State) -> ScoreResult:
        if run in state.runs:
            return _score_result(state.runs[run])
        fresh = [n for n in state.live.get(NORMALIZED, []) if n not in state.covered]
        scored = scoring.score_leads(store.read(NORMALIZED, fresh), rules, _now(at))
        store.write(scored, SCORED, run)
        stats, counts = _describe(store, run)
        store.commit(
            run,
            add={SCORED: [run]},
            covers=fresh,
            counts=counts,
            stats={run: stats},
            state=state,
            reads={NORMALIZED: fresh},
        )
        return _score_result(counts)

    return _until_committed(store, job)


def rescore_all(
    store: Warehouse,
    rules: Mapping[str, Any] = DEFAULT_RULES,
    at: datetime | None = None,
) -> ScoreResult:
    """Replace all scores, and with them the record of what was exported."""
    run = _run_name("score")

    def job(state: State) -> ScoreResult:
        records = state.live.get(NORMALIZED, [])
        scored = scoring.score_leads(store.read(NORMALIZED, records), rules, _now(at))
        store.write(scored, SCORED, run)
        stats, counts = _describe(store, run)
        store.commit(
            run,
            add={SCORED: [run]},
            retire={layer: state.live.get(layer, []) for layer in (SCORED, RESULTS)},
            covers=records,
            counts=counts,
            stats={run: stats},
            state=state,
            reads={NORMALIZED: records},
            whole=[NORMALIZED, SCORED, RESULTS],
        )
        return _score_result(counts)

    return _until_committed(store, job)


def _describe(store: Warehouse, folder: str) -> tuple[dict[str, Any], dict[str, int]]:
    """The statistics of one new folder of leads, as the log keeps them, and its counts.

    Its rank counts are stored beside it, for pages far down the list.
    """
    rows = store.read(LEADS, [folder])
    store.write(leads.rank_counts(rows).coalesce(1), RANKS, folder)
    row = leads.stats(rows).first()
    stats = {**row.asDict(), "total_claim_amount": str(row["total_claim_amount"])}
    return stats, {name: row[name] for name in ("total_leads", *PRIORITIES)}


def _score_result(counts: Mapping[str, int]) -> ScoreResult:
    return ScoreResult(counts["total_leads"], {name: counts[name] for name in PRIORITIES})


def _with_results(store: Warehouse, layer: str) -> DataFrame:
    state = store.state()
    rows = store.read(layer, state=state)
    waiting = state.live.get(RESULTS, [])
    if not waiting:
        return rows
    return export.apply_results(rows, store.read(RESULTS, waiting))


def current_scored(store: Warehouse) -> DataFrame:
    """Scored rows with what the export results say about them."""
    return _with_results(store, SCORED)


def current_leads(store: Warehouse) -> DataFrame:
    """Leads as ``join_leads`` gives them, read without that join.

    Results that are not folded in yet are joined to them.
    """
    return _with_results(store, LEADS)


def current_stats(store: Warehouse) -> DataFrame:
    """``leads.stats`` of all leads, added up from the log.

    Every run that writes leads notes the statistics of its folder, so no lead is read.
    Only while results wait to be folded in, leads are counted themselves.
    """
    state = store.state()
    folders = state.live.get(SCORED, [])
    if state.live.get(RESULTS) or any(name not in state.stats for name in folders):
        return leads.stats(current_leads(store))
    empty = leads.stats(store.read(LEADS, []))
    counted = [name for name in empty.columns if name != "total_claim_amount"]
    parts = [state.stats[name] for name in folders]
    total = {name: sum(part[name] for part in parts) for name in counted}
    amount = sum((Decimal(part["total_claim_amount"]) for part in parts), Decimal(0))
    row = tuple({**total, "total_claim_amount": amount}[name] for name in empty.columns)
    return store.spark.createDataFrame([row], empty.schema)


def _rank_counts(store: Warehouse, rows: DataFrame, where: leads.LeadFilter) -> DataFrame:
    """The rank counts of the leads that meet a filter: stored ones if these can tell."""
    if where.state or where.min_amount is not None:
        return leads.rank_counts(where.apply(rows))
    stored = store.read(RANKS)
    return leads.LeadFilter(priority=where.priority).apply(stored)


def leads_at(
    store: Warehouse,
    where: leads.LeadFilter = leads.LeadFilter(),
    page: leads.Page = leads.Page(),
) -> DataFrame:
    """``leads.list_leads`` of the current leads, for any offset at the price of a page.

    By priority or without a filter the place of the page comes from counts stored beside
    each folder of leads; other filters count by one narrow pass over the leads.
    """
    rows = current_leads(store)
    return leads.list_at(rows, _rank_counts(store, rows, where), where, page)


def lead_page(
    store: Warehouse,
    where: leads.LeadFilter = leads.LeadFilter(),
    page: leads.Page = leads.Page(),
) -> DataFrame:
    """``leads.lead_page`` of the current leads, found and counted as in ``leads_at``."""
    rows = current_leads(store)
    return leads.lead_page(rows, where, page, _rank_counts(store, rows, where))


def repeated_hashes(store: Warehouse) -> DataFrame:
    """``dedup_hash, copies`` of the hashes that more than one normalized row has.

    Only hashes of folders not checked before are looked at, against all folders, and only
    the buckets they lie in are read.
    """
    return _repeated_hashes(store, store.state())


def _repeated_hashes(store: Warehouse, state: State) -> DataFrame:
    live = state.live.get(HASHES, [])
    fresh = [folder for folder in live if folder not in state.covered]
    rows = store.read_buckets(live, store.hash_buckets_of(fresh))
    is_new = F.col("run").isin(fresh) if fresh else F.lit(False)
    counts = rows.groupBy("dedup_hash").agg(
        F.count("*").alias("copies"), F.max(is_new).alias("is_new")
    )
    return counts.where("copies > 1 AND is_new").drop("is_new")


def check_hashes(store: Warehouse) -> int:
    """How many hashes are repeated, as ``repeated_hashes`` finds them.

    If there are none, the folders count as checked from now on.
    """
    run = _run_name("check")

    def job(state: State) -> int:
        live = state.live.get(HASHES, [])
        fresh = [folder for folder in live if folder not in state.covered]
        found = _repeated_hashes(store, state).agg(F.count("*")).first()[0]
        if fresh and not found:
            store.commit(run, add={}, covers=fresh, state=state, reads={HASHES: live})
        return found

    return _until_committed(store, job)


def export_batches(store: Warehouse, size: int = export.EXPORT_BATCH) -> DataFrame:
    """Pending leads with their batch, for an outside client to push."""
    return export.assign_batches(current_leads(store), size)


def record_results(
    store: Warehouse,
    results: DataFrame,
    run: str | None = None,
    at: datetime | None = None,
    fold_after: int = FOLD_AFTER,
) -> None:
    """Append the outcome of pushed leads: ``lead_id, external_id, ok``.

    Call it once per pushed batch or range of batches: each call is durable by
    itself. When ``fold_after`` calls wait, they are folded into the leads.
    """
    run = run or _run_name("results")
    rows = results.select("lead_id", "external_id", "ok", _now(at).alias("exported_at"))

    def job(state: State) -> State:
        if run in state.runs:
            return state
        store.write(rows, RESULTS, run)
        return store.commit(run, add={RESULTS: [run]}, state=state)

    if len(_until_committed(store, job).live[RESULTS]) >= fold_after:
        fold_results(store)


def fold_results(store: Warehouse) -> int:
    """Write the outcome of pushed leads into the leads; reading them needs no join then.

    Only the folders that hold such leads are written anew. Returns how many results
    were folded in.
    """
    run = _run_name("fold")

    def job(state: State) -> int:
        waiting = state.live.get(RESULTS, [])
        if not waiting:
            return 0
        results = store.read(RESULTS, waiting)
        short = results.withColumn("lead_id", packed(F.col("lead_id")))
        done = short.where("ok").select(F.col("lead_id").alias("id"))
        live = state.live.get(SCORED, [])
        folders = _touched(store, live, done)
        stats: dict[str, Any] = {}
        if folders:
            rows = store.read(LEADS, folders)
            keys = {name: packed(F.col(name)) for name in _LEAD_KEYS}
            applied = export.apply_results(rows.withColumns(keys), short)
            texts = {name: unpacked(F.col(name)) for name in _LEAD_KEYS}
            store.write(applied.withColumns(texts), SCORED, run)
            stats[run] = _describe(store, run)[0]
        store.commit(
            run,
            add={SCORED: [run]} if folders else {},
            retire={SCORED: folders, RESULTS: waiting},
            stats=stats,
            state=state,
            reads={SCORED: live},
        )
        return results.agg(F.count("*")).first()[0]

    return _until_committed(store, job)


def _touched(store: Warehouse, folders: list[str], done: DataFrame) -> list[str]:
    """The folders that hold a lead of ``done``, whose ids are packed.

    Some of these ids, broadcast, tell most folders without a shuffle; all of them are
    joined only to the leads of folders where none of the first was found.
    """
    found: set[str] = set()
    for ids in (F.broadcast(done.limit(PROBED)), done):
        left = [name for name in folders if name not in found]
        if left:
            rows = store.read(LEADS, left, folders=True)
            short = rows.select(packed(F.col("id")).alias("id"), "run")
            found |= set(_by_folder(short.join(ids, "id", "left_semi")))
    return sorted(found)


def export_result(pushed: DataFrame, results: DataFrame) -> ExportResult:
    row = export.export_summary(pushed, results).first()
    return ExportResult(row.exported, row.failed, row.total_seen)


def remove_raw(store: Warehouse, condition: Column) -> None:
    """Remove raw rows meeting ``condition`` with all their descendants and results.

    Folders without such rows stay, those of such rows only are retired, and just the
    others are written anew. Later runs may then keep rows that were duplicates of the
    removed ones, and a batch that went as a whole can be ingested again. Retired folders
    are deleted by ``Warehouse.vacuum``.
    """
    run = _run_name("remove")
    _until_committed(store, lambda state: _remove(store, state, run, condition))


def _remove(store: Warehouse, state: State, run: str, condition: Column) -> None:
    doomed = F.coalesce(condition, F.lit(False))
    kept: list[DataFrame] = []
    try:
        raw = _held(store.read(RAW, state=state).where(doomed), kept)
        records = _held(_children(store.read(NORMALIZED, state=state), "raw_record_id", raw), kept)
        leads_of = _children(store.read(LEADS, state=state), "normalized_record_id", records)
        scored = _held(leads_of, kept)
        _remove_ids(store, state, run, doomed, raw, records, scored)
    finally:
        for ids in kept:
            ids.unpersist()


def _children(rows: DataFrame, parent: str, ids: DataFrame) -> DataFrame:
    gone = ids.select(F.col("id").alias("gone"))
    return rows.join(gone, rows[parent] == F.col("gone"), "left_semi")


def _held(rows: DataFrame, kept: list[DataFrame]) -> DataFrame:
    """The ids of rows, computed once, and broadcast where they are joined if they are few.

    Else each join would shuffle the layer it removes them from.
    """
    ids = rows.select("id").persist()
    kept.append(ids)
    few = ids.agg(F.count("*")).first()[0] <= MOST_BROADCAST
    return F.broadcast(ids) if few else ids


def _remove_ids(
    store: Warehouse,
    state: State,
    run: str,
    doomed: Column,
    raw: DataFrame,
    records: DataFrame,
    scored: DataFrame,
) -> None:
    add: dict[str, list[str]] = {}
    retire: dict[str, list[str]] = {}
    covers: list[str] = []
    moved: dict[str, str] = {}
    stats: dict[str, Any] = {}
    for layer, key, ids in (
        (RAW, "id", raw),
        (LEFTOVER, "id", raw),
        (NORMALIZED, "id", records),
        (HASHES, "id", records),
        (SCORED, "id", scored),
        (RESULTS, "lead_id", scored),
    ):
        stored = LEADS if layer == SCORED else layer
        gone = ids.select(F.col("id").alias("gone"))

        def hit(rows: DataFrame, how: str, key=key, gone=gone, layer=layer) -> DataFrame:
            if layer in (RAW, LEFTOVER):  # the condition itself, without a join
                return rows.where(doomed if how == "left_semi" else ~doomed)
            return rows.join(gone, rows[key] == gone["gone"], how)

        rows = store.read(stored, state.live.get(layer, []), folders=True)
        hits = _by_folder(hit(rows, "left_semi"))
        if not hits:
            continue
        totals = _by_folder(rows.where(F.col("run").isin(list(hits))))
        partly = [name for name in hits if hits[name] < totals[name]]
        retire[layer] = list(hits)
        add[layer] = []
        for done in (True, False):
            names = [name for name in partly if (name in state.covered) == done]
            if not names:
                continue
            left = hit(store.read(stored, names), "left_anti")
            folder = _rewrite(store, state, layer, left, names, f"{run}-{layer}-{done:d}")
            add[layer].append(folder)
            covers += [folder] * done
            if layer == SCORED:
                stats[folder] = _describe(store, folder)[0]
            if layer == RAW:
                moved.update(_moved(state, names, folder))
    if retire:
        store.commit(
            run,
            add=add,
            retire=retire,
            covers=covers,
            removed=True,
            moved=moved,
            stats=stats,
            state=state,
            whole=[RAW, LEFTOVER, NORMALIZED, SCORED, RESULTS],
        )


def _rewrite(
    store: Warehouse,
    state: State,
    layer: str,
    rows: DataFrame,
    names: list[str],
    folder: str,
) -> str:
    """Write rows of some folders of a layer into one new folder; returns its name.

    Only small files are gathered by a shuffle; large ones are read and written as they are.
    """
    if layer == HASHES:
        return store.write_hashes(rows, store.buckets(state))
    if layer in (RAW, LEFTOVER) and store.has_small_files(layer, names):
        rows = rows.hint("rebalance", "source")
    store.write(rows, layer, folder)
    return folder


def _moved(state: State, names: list[str], folder: str) -> dict[str, str]:
    """Where the batches in some folders are, once these are one folder."""
    held = {batch: folder for batch, name in state.moved.items() if name in names}
    return {**dict.fromkeys(names, folder), **held}


def merge_folders(store: Warehouse, most: int = MOST_FOLDERS) -> dict[str, int]:
    """Merge the smallest folders of each layer that has more than ``most`` of them.

    Large folders stay as they are, so over many merges a row is written anew only a few
    times. Returns how many folders went into each merge.
    """
    run = _run_name("merge")
    merged: dict[str, int] = {}
    for layer in (RAW, LEFTOVER, NORMALIZED, HASHES, SCORED):

        def job(state: State, layer=layer) -> None:
            live = state.live.get(layer, [])
            if len(live) <= most:
                return
            stored = LEADS if layer == SCORED else layer
            by_size = sorted(live, key=lambda name: store.size(stored, name), reverse=True)
            add: list[str] = []
            gone: list[str] = []
            covers: list[str] = []
            moved: dict[str, str] = {}
            # A merge may write two folders, of rows processed further and rows waiting.
            small = by_size[max(most - 2, 0) :]
            for done in (True, False):
                names = [name for name in small if (name in state.covered) == done]
                if len(names) < 2:
                    continue
                rows = store.read(stored, names)
                folder = _rewrite(store, state, layer, rows, names, f"{run}-{layer}-{done:d}")
                add.append(folder)
                gone += names
                covers += [folder] * done
                if layer == RAW:
                    moved.update(_moved(state, names, folder))
            stats = {f: _describe(store, f)[0] for f in add} if layer == SCORED else {}
            store.commit(
                f"{run}-{layer}",
                add={layer: add},
                retire={layer: gone},
                covers=covers,
                moved=moved,
                stats=stats,
                state=state,
            )
            merged[layer] = len(gone)

        _until_committed(store, job)
    return merged


def rebucket_hashes(store: Warehouse, buckets: int) -> None:
    """Deal the stored hashes into another number of buckets, when these have grown."""
    run = _run_name("rebucket")

    def job(state: State) -> None:
        old = state.live.get(HASHES, [])
        folder = store.write_hashes(store.read(HASHES, old), buckets)
        store.commit(
            run,
            add={HASHES: [folder]},
            retire={HASHES: old},
            buckets=buckets,
            state=state,
            whole=[HASHES],
        )

    _until_committed(store, job)


def _by_folder(rows: DataFrame) -> dict[str, int]:
    """Rows of each folder; one entry for each run that wrote the layer."""
    return {row["run"]: row["count"] for row in rows.groupBy("run").count().collect()}
