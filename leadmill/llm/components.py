"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import stored

#: A key is hot if it holds more than this share of the rows, so there are few hot keys.
HOT_SHARE = 256
HOT_PARTS = 64


def spread_join(
    rows: DataFrame, keyed: DataFrame, key: str, by: Column, total: int, how: str = "inner"
) -> DataFrame:
    """``rows`` joined with ``keyed``, which holds a key once, by the column ``key``.

    Rows of a key with more than a 256th of all ``total`` rows are dealt over 64 parts by
    the number ``by``, and the key's one row in ``keyed`` is copied for each part. There are
    fewer than 256 such keys, so they are broadcast to both sides.
    """
    hot = F.broadcast(
        rows.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") * HOT_SHARE > total)
        .select(key, F.lit(HOT_PARTS).alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn("_part", F.pmod(by, parts).cast("int"))
    copied = keyed.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return (
        dealt.drop("_parts").join(copied.drop("_parts"), [key, "_part"], how).drop("_part")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``edges(a long, b long)`` the smallest node
    that it is connected to.

    Each round every node takes the smallest label among itself and its neighbours, then
    the label of that label, so chains shrink to stars at a doubling pace. Minima are
    combined before each shuffle; nodes with many neighbours and labels of many nodes are
    spread; rounds are stored, as a lineage of all rounds would grow. Loops, repeated edges
    and edges with nulls change nothing.
    """
    good = edges.where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    both = stored(
        good.select("a", F.col("b").alias("node"))
        .unionByName(good.select(F.col("b").alias("a"), F.col("a").alias("node")))
        .distinct()
    )
    labels = stored(
        both.groupBy(F.col("a").alias("at"))
        .agg(F.min("node").alias("least"))
        .select(F.col("at").alias("node"), F.least("at", "least").alias("root"))
    )
    links, nodes = both.count(), labels.count()
    while True:
        near = (
            spread_join(both, labels, "node", F.xxhash64("a"), links)
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        hooked = stored(
            labels.join(near, labels["node"] == near["a"]).select(
                "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
            )
        )
        # Without a change all neighbours have one label.
        if hooked.where(F.col("root") != F.col("old")).isEmpty():
            return labels
        # Roots that got a smaller label pass it on to all that point to them.
        moved = hooked.where(
            (F.col("node") == F.col("old")) & (F.col("root") != F.col("old"))
        ).select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = stored(
            spread_join(
                hooked.select("node", "root"), moved, "root", F.xxhash64("node"), nodes, "left"
            ).select("node", F.least("root", "top").alias("root"))
        )
