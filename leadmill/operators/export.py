"""Batched export of pending leads and applying what came back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.operators.leads import SLICE_DIGITS, pending, ranked

_RESULTS = pa.schema(
    [("lead_id", pa.string()), ("external_id", pa.string()), ("ok", pa.bool_())]
)

# Fixed value: records per pushed batch.
EXPORT_BATCH = 10

# The target's column names.
PAYLOAD_COLUMNS = (
    "Name",
    "Entity Type",
    "Address Line 1",
    "City",
    "State",
    "Zip",
    "Claim Amount",
    "Source",
    "Priority",
    "Score",
    "Score Breakdown",
)


def select_pending(leads: DataFrame) -> DataFrame:
    """Leads not exported yet, best first."""
    return ranked(pending(leads))


def crm_fields() -> list[Column]:
    """The eleven payload columns; amount as double, breakdown as JSON text."""
    sources = (
        F.col("owner_name"),
        F.col("entity_type"),
        F.col("address_line1"),
        F.col("city"),
        F.col("state"),
        F.col("zip"),
        F.col("claim_amount").cast("double"),
        F.col("source"),
        F.col("priority"),
        F.col("score"),
        F.to_json("score_breakdown"),
    )
    return [
        column.alias(name)
        for column, name in zip(sources, PAYLOAD_COLUMNS, strict=True)
    ]


def number_by_score(leads: DataFrame, digits: int | None = None) -> DataFrame:
    """Add ``position``: 1 for the best score, ties by id, without gaps.

    No window runs over all rows. Leads are sliced by score and id prefix; a
    small table of slice counts gives each slice its start, and a window inside
    the slice the rest. Slices follow from values alone, so a lost task that is
    run again numbers its rows the same. More ``digits`` make more, smaller slices.
    """
    sliced = leads.withColumn("slice", F.substring("id", 1, digits or SLICE_DIGITS))
    counts = sliced.groupBy("score", "slice").agg(F.count("*").alias("leads_in"))

    earlier_slices = (
        Window.partitionBy("score")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    higher_scores = Window.orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per distinct score, so the unpartitioned window stays tiny.
    above = (
        counts.groupBy("score")
        .agg(F.sum("leads_in").alias("leads_at"))
        .select(
            "score",
            F.coalesce(F.sum("leads_at").over(higher_scores), F.lit(0)).alias("above"),
        )
    )
    starts = (
        counts.withColumn(
            "before", F.coalesce(F.sum("leads_in").over(earlier_slices), F.lit(0))
        )
        .join(above, "score")
        .select("score", "slice", (F.col("before") + F.col("above")).alias("start"))
    )
    in_slice = Window.partitionBy("score", "slice").orderBy("id")
    return (
        sliced.join(starts, ["score", "slice"])
        .withColumn("position", F.col("start") + F.row_number().over(in_slice))
        .drop("slice", "start")
    )


def assign_batches(
    leads: DataFrame, size: int = EXPORT_BATCH, digits: int | None = None
) -> DataFrame:
    """Add ``position`` and ``export_batch`` (from 0) to the pending leads.

    ``digits`` as in ``number_by_score``.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    numbered = number_by_score(pending(leads), digits)
    batch = F.expr(f"(position - 1) div {int(size)}")
    return numbered.withColumn("export_batch", batch)


def payload_rows(batched: DataFrame) -> DataFrame:
    """One row per lead: batch, position, lead id and payload columns."""
    return batched.select(
        "export_batch", "position", F.col("id").alias("lead_id"), *crm_fields()
    )


def payload_batches(batched: DataFrame) -> DataFrame:
    """One row per batch with its payload records in order.

    A batch holds a fixed number of leads, so gathering it is bounded.
    """
    record = F.struct("position", F.col("id").alias("lead_id"), *crm_fields())
    grouped = batched.groupBy("export_batch").agg(
        F.sort_array(F.collect_list(record)).alias("records")
    )
    return grouped.select("export_batch", F.size("records").alias("leads"), "records")


def write_payload(batched: DataFrame, path: str) -> None:
    """Write payload rows as JSON lines, ordered by batch within each file.

    Every line has all columns, null or not.
    Leads are gathered by ranges of batches, not one folder per batch: with ten
    leads a batch, that would be millions of tiny files.
    """
    payload_rows(batched).repartitionByRange("export_batch").sortWithinPartitions(
        "export_batch", "position"
    ).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def push(
    batched: DataFrame, client: Callable[[int, list[dict[str, Any]]], list[str | None]]
) -> DataFrame:
    """Send every batch through a caller's client: ``lead_id, external_id, ok``.

    ``client`` runs on the executors. It is given a batch number and the batch's payload
    records in order, and returns an external id for each, None for one that failed. If
    it raises, the whole batch counts as failed, and others go on. A task that is run
    again pushes its batches again, so clients should use ``lead_id`` as a key. Store the
    result with ``jobs.record_results``, which runs this once.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out: dict[str, list] = {"lead_id": [], "external_id": [], "ok": []}
            for row in part.to_pylist():
                records = row["records"]
                try:
                    found = client(row["export_batch"], records)
                except Exception:  # whatever a client raises, only its batch fails
                    found = [None] * len(records)
                out["lead_id"] += [record["lead_id"] for record in records]
                out["external_id"] += found
                out["ok"] += [name is not None for name in found]
            yield pa.RecordBatch.from_pydict(out, schema=_RESULTS)

    return payload_batches(batched).mapInArrow(
        send, "lead_id STRING, external_id STRING, ok BOOLEAN"
    )


def successes(results: DataFrame) -> DataFrame:
    """The first success of each lead that has one."""
    done = results.where("ok").groupBy(F.col("lead_id").alias("id"))
    first = F.min(F.struct("exported_at", "external_id"))
    return done.agg(first.alias("success"))


def apply_results(scored: DataFrame, results: DataFrame) -> DataFrame:
    """Set flag, time and external id of leads whose push succeeded.

    All other leads stay as they were and are picked up by the next export.
    """
    marked = scored.join(successes(results), "id", "left")
    done = F.col("success").isNotNull() & ~F.col("exported_to_crm")
    return marked.withColumns(
        {
            "exported_at": F.when(done, F.col("success.exported_at")).otherwise(
                F.col("exported_at")
            ),
            "crm_record_id": F.when(done, F.col("success.external_id")).otherwise(
                F.col("crm_record_id")
            ),
            "exported_to_crm": F.col("exported_to_crm") | done,
        }
    ).select(*scored.columns)


def export_summary(pushed: DataFrame, results: DataFrame) -> DataFrame:
    """One row: exported, failed, total_seen.

    A pushed lead counts as exported only if its own result says so.
    """
    done = results.where("ok").select("lead_id").distinct()
    done = done.withColumn("done", F.lit(True))
    joined = pushed.select(F.col("id").alias("lead_id")).join(done, "lead_id", "left")
    return joined.agg(
        F.count("done").alias("exported"),
        (F.count("*") - F.count("done")).alias("failed"),
        F.count("*").alias("total_seen"),
    )
