"""Mixing sources to target shares by entropy balancing.

Each document gets a rate, how often the mix takes it. Of all rates between 0 and
``most`` that meet the word target of every source, the ones closest to taking each
document once, in the sense of relative entropy, are exponentially tilted by the words
of the document: ``rate = min(most, exp(tilt * words / mean words))``. The tilts solve a
convex dual, one equation a source, by Newton steps kept inside a bracket. As a rate
depends only on source and words, the sums run over the counts of documents by source and
words, not over the documents.

Rates are then rounded into copies. Documents of a source are walked from the longest to
the shortest, adding up the fractions of their rates; whenever the sum passes a half, the
document at hand is taken once more. Neighbours in that order are about equally long, so
the words taken differ from the target by less than one long document. The walk is cut
into slices of bounded size whose sums are added up first, so no window holds a source.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.llm.shared import fresh_name, stored

WEIGHTS = (5, 2, 1)
MOST = 3
SLICE_ROWS = 50_000
ROUNDS = 60
#: A source is balanced when its words are this close to the target, as a share of it.
CLOSE = 1e-9
# A fixed value: what counts as a word.
_WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """How many words a text has; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row a source.

    Weights are dealt over the sources in code point order, null last, again and again.
    Each gets its share of the words of all, at most ``most`` times its own; what is
    over goes to the others by their weights until none is above. That is a common level
    times the weight, cut off: sources are filled in the order of where they are cut.
    """
    ranked = Window.orderBy(F.asc_nulls_last("source"))
    numbers = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sizes.withColumn(
        "weight",
        F.element_at(numbers, (F.row_number().over(ranked) - 1) % len(weights) + 1),
    ).withColumn("cut", most * F.col("source_size").cast("double"))
    whole = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    by_cut = Window.orderBy(F.col("cut") / F.col("weight"), F.asc_nulls_last("source"))
    earlier = by_cut.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("cut").over(earlier), F.lit(0.0))
    ) / (
        F.sum("weight").over(whole)
        - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    # The level if just the earlier sources are cut; it holds from the first source on
    # that it leaves below its own cut.
    leveled = weighted.withColumn("level", level).withColumn(
        "holds", F.col("level") * F.col("weight") <= F.col("cut")
    )
    # Of sources cut at the same place the first one, which has the highest level.
    place = F.struct(F.col("cut") / F.col("weight"), -F.col("level"))
    chosen = F.min_by(
        F.when(F.col("holds"), F.col("level")), F.when(F.col("holds"), place)
    ).over(whole)
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("cut"), F.col("weight") * F.coalesce(chosen, F.lit(0.0))).alias(
            "target"
        ),
    )


def _rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    steep = F.least(tilt * size / mean, F.lit(float(most)).cast("double"))
    limited = F.least(F.exp(steep), F.lit(float(most)))
    return F.when(size == 0, F.lit(1.0)).otherwise(limited)


def balance(counts: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """``source, mean, tilt`` from ``source, size, docs`` and the targets.

    Each round is one aggregation of the counts; a Newton step that leaves the bracket
    is replaced by its middle. A source whose target is its limit takes every document
    ``most`` times, a source without words or with target zero needs no tilt.
    """
    facts = counts.where(F.col("size") > 0).groupBy("source").agg(
        (F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"),
        (F.min("size") * F.lit(1.0)).alias("least"),
    )
    start = (
        facts.join(goals, facts["source"].eqNullSafe(goals["source"]))
        .drop(goals["source"])
        .select(
            "source",
            "mean",
            "target",
            F.lit(0.0).alias("tilt"),
            F.lit(-1e6).alias("low"),
            # With this tilt the shortest document has the highest rate, and so do all.
            (F.log(F.lit(float(most))) * F.col("mean") / F.col("least")).alias("high"),
            (F.col("target") <= 0).alias("done"),
        )
    )
    full = F.col("target") >= most * F.col("mean") * F.col("n")
    totals = counts.where(F.col("size") > 0).groupBy("source").agg(
        F.sum("docs").alias("n")
    )
    start = start.join(totals, start["source"].eqNullSafe(totals["source"])).drop(
        totals["source"]
    )
    state = stored(
        start.withColumn("tilt", F.when(full, F.col("high")).otherwise(0.0))
        .withColumn("done", F.col("done") | full)
        .drop("n")
    )
    for _ in range(ROUNDS):
        rates = _rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        weight = F.col("docs") * F.col("size") * rates
        # The derivative of a rate that is at its limit is zero.
        bends = (rates < most) & (F.col("size") > 0)
        joined = counts.join(
            state, counts["source"].eqNullSafe(state["source"])
        ).drop(counts["source"])
        sums = joined.groupBy(*state.columns).agg(
            F.sum(weight).alias("taken"),
            F.sum(F.when(bends, weight * F.col("size") / F.col("mean"))).alias("slope"),
        )
        above = F.col("taken") > F.col("target")
        near = F.abs(F.col("taken") - F.col("target")) <= CLOSE * F.col("target")
        moved = (
            sums.withColumn("low", F.when(above, F.col("low")).otherwise(F.col("tilt")))
            .withColumn("high", F.when(above, F.col("tilt")).otherwise(F.col("high")))
            .withColumn(
                "step", F.col("tilt") - (F.col("taken") - F.col("target")) / F.col("slope")
            )
        )
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        middle = (F.col("low") + F.col("high")) / 2
        stop = F.col("done") | near
        state = stored(
            moved.select(
                "source",
                "mean",
                "target",
                F.when(stop, F.col("tilt"))
                .when(inside, F.col("step"))
                .otherwise(middle)
                .alias("tilt"),
                "low",
                "high",
                stop.alias("done"),
            )
        )
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "mean", "tilt", (F.col("target") <= 0).alias("empty"))


def _copies(sized: DataFrame, tilts: DataFrame, most: int, slice_rows: int) -> DataFrame:
    """``sized(key, source, size, ...)`` with a column ``copies``."""
    rates = _rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
    rated = (
        sized.join(tilts, sized["source"].eqNullSafe(tilts["source"]), "left")
        .drop(tilts["source"])
        .withColumn(
            "rate",
            F.when(F.col("empty"), 0.0).otherwise(F.coalesce(rates, F.lit(1.0))),
        )
        .drop("mean", "tilt", "empty")
        .withColumn("band", F.floor(F.log2(F.col("size") + 1) * 8))
        .withColumn("whole", F.floor(F.col("rate")))
        .withColumn("part", F.col("rate") - F.col("whole"))
    )
    bands = stored(
        rated.groupBy("source", "band").agg(
            F.ceil(F.count("*") / slice_rows).alias("slices")
        )
    )
    sliced = stored(
        rated.join(
            bands,
            rated["source"].eqNullSafe(bands["source"])
            & (rated["band"] == bands["band"]),
        )
        .drop(bands["source"])
        .drop(bands["band"])
        .withColumn("slice", F.pmod("key", F.col("slices")))
        .drop("slices")
    )
    along = Window.partitionBy("source").orderBy(F.desc("band"), "slice")
    sums = sliced.groupBy("source", "band", "slice").agg(F.sum("part").alias("held"))
    starts = stored(sums.select(
        F.col("source").alias("_source"),
        F.col("band").alias("_band"),
        F.col("slice").alias("_slice"),
        F.coalesce(
            F.sum("held").over(along.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0.0),
        ).alias("before"),
    ))
    within = Window.partitionBy("source", "band", "slice").orderBy(
        F.desc("size"), "key", "id"
    )
    summed = sliced.withColumn(
        "here", F.sum("part").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ).join(
        starts,
        sliced["source"].eqNullSafe(starts["_source"])
        & (F.col("band") == F.col("_band"))
        & (F.col("slice") == F.col("_slice")),
    )
    # Rounded, so that sums of the same parts in another order cannot flip a copy.
    end = F.round(F.col("before") + F.col("here"), 9)
    begin = F.round(F.col("before") + F.col("here") - F.col("part"), 9)
    more = F.floor(end + 0.5) - F.floor(begin + 0.5)
    return summed.withColumn(
        "copies", F.least(F.col("whole") + more, F.lit(most)).cast("int")
    ).drop("_source", "_band", "_slice", "before", "here", "band", "slice", "part", "whole")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights=WEIGHTS,
    most: int = MOST,
    slice_rows: int = SLICE_ROWS,
    row_column: str | None = None,
) -> DataFrame:
    """``<id>, size, source_size, target, taken, copies``, one row a document.

    ``row_column`` names a column of ``docs`` that is passed through as ``row``.

    ``taken``: words that the mix takes of the document, repeats counted. Null and empty
    texts have no words and are taken once, which takes none. The null source is a source
    like others. Rows with equal ids are rounded one by one; equal rows are
    interchangeable. An empty table gives an empty result.
    """
    sized = stored(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            words_in(F.col(text_column)).alias("size"),
            *([F.col(row_column).alias("row")] if row_column else []),
        )
        .withColumn("key", F.xxhash64("id", "source", "size"))
    )
    counts = stored(
        sized.groupBy("source", "size").agg(F.count("*").alias("docs"))
    )
    totals = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size")
    )
    goals = stored(targets(totals, weights, most))
    tilts = balance(counts, goals, most)
    taken = _copies(sized, tilts, most, slice_rows)
    return (
        taken.join(
            goals, taken["source"].eqNullSafe(goals["source"])
        ).select(
            F.col("id").alias(id_column),
            "size",
            "source_size",
            "target",
            (F.col("size") * F.col("copies")).alias("taken"),
            "copies",
            *(["row"] if row_column else []),
        )
    )


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The documents of the mix, as often as it takes them, with the same columns.

    Documents without words stay. Every row is repeated by its own copies, whatever ids or
    texts it shares with others; the words of the result are those that ``mix`` takes.
    """
    row, times = fresh_name(docs, "row"), fresh_name(docs, "times")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    copies = mix(rows, id_column, text_column, source_column, row_column=row).select(
        F.col("row").alias(row), F.col("copies").alias(times)
    )
    # One row each on both sides, under numbers of their own: no key is hot.
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(times)))
    return rows.join(copies, row).withColumn(times, repeated).select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )
