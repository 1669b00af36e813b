"""Text quality by a sparse ensemble of rules.

Each text is described by a few statistics. A random forest of shallow trees is grown on
a bounded sample of labelled rows; every path from a root to a node is a rule, a
conjunction of bounds on statistics. A logistic regression with a lasso penalty weighs the
rules and leaves most of them out. The rest is one Spark column expression, so scores are
computed where the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from leadmill.llm.shared import crc_of_id, fresh_name, mapped, stored, word_runs

#: Labelled rows used for fitting, chosen by hash of their id.
SAMPLE = 20_000
#: Size of the forest; a tree of this depth has at most 14 rules.
TREES, DEPTH = 24, 3
LASSO = 0.002
SEED = 11

STATISTICS = (
    "size",
    "words",
    "word_length",
    "upper",
    "digits",
    "marks",
    "symbols",
    "doubled",
    "other_letters",
    "lines",
    "repeats",
    "distinct",
    "bare",
    "short",
    "long",
)

_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _MARK, _SYMBOL, _OTHER = range(1, 9)


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[0x21:0x7F] = _SYMBOL
    kinds[list(b".,;:!?'\"()-")] = _MARK
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
    kinds[0x0A] = _LINE
    kinds[0xC0:] = _OTHER  # first byte of a character outside of ASCII
    return kinds


_KINDS = _byte_kinds()


def _byte_counts(texts: pa.Array) -> dict[int, np.ndarray]:
    """For each text how many bytes of each kind it has; ``0``: doubled marks."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(b"".join(text.as_buffer() for text in texts), dtype=np.uint8)
    kinds = _KINDS[raw]

    def each(flags: np.ndarray) -> np.ndarray:
        held = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return held[ends] - held[starts]

    found = {kind: each(kinds == kind) for kind in range(_UPPER, _OTHER + 1)}
    same = np.zeros(len(raw), dtype=bool)
    same[1:] = (raw[1:] == raw[:-1]) & ((kinds[1:] == _MARK) | (kinds[1:] == _SYMBOL))
    same[starts[(sizes > 0) & (starts < len(raw))]] = False  # not across two texts
    found[0] = each(same)
    return found


def _word_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """A run of texts at a time: words, repeats, distinct, bare, short and long words."""
    for words, places, counts in word_runs(texts):
        text = np.repeat(np.arange(len(counts)), counts)
        sizes = np.fromiter((len(word) for word in words), np.int64, len(words))
        bare = np.fromiter(
            (not any(c.isalnum() for c in word) for word in words), bool, len(words)
        )

        def each(flags: np.ndarray, text=text, counts=counts) -> np.ndarray:
            return np.bincount(text[flags], minlength=len(counts))

        follows = np.zeros(len(places), dtype=bool)
        if len(places):
            follows[1:] = (places[1:] == places[:-1]) & (text[1:] == text[:-1])
        pairs = np.unique(text * max(len(words), 1) + places)
        distinct = np.bincount(pairs // max(len(words), 1), minlength=len(counts))
        yield (
            counts,
            each(follows),
            distinct,
            each(bare[places]) if len(places) else each(follows),
            each(sizes[places] <= 3) if len(places) else each(follows),
            each(sizes[places] > 20) if len(places) else each(follows),
        )


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The ``STATISTICS`` of texts; a null counts as an empty text."""
    texts = pc.fill_null(texts, "")
    kinds = _byte_counts(texts)
    runs = list(_word_counts(texts))
    words, repeats, distinct, bare, short, long = (
        np.concatenate([run[at] for run in runs]) if runs else np.zeros(0, np.int64)
        for at in range(6)
    )
    letters = kinds[_UPPER] + kinds[_LOWER] + kinds[_OTHER]
    black = letters + kinds[_DIGIT] + kinds[_MARK] + kinds[_SYMBOL]
    some, all_ = np.maximum(words, 1), np.maximum(black, 1)
    return {
        "size": np.log1p(black),
        "words": np.log1p(words),
        "word_length": black / some,
        "upper": kinds[_UPPER] / np.maximum(letters, 1),
        "digits": kinds[_DIGIT] / all_,
        "marks": kinds[_MARK] / some,
        "symbols": kinds[_SYMBOL] / some,
        "doubled": kinds[0] / some,
        "other_letters": kinds[_OTHER] / np.maximum(letters, 1),
        "lines": kinds[_LINE] / some,
        "repeats": repeats / some,
        "distinct": distinct / some,
        "bare": bare / some,
        "short": short / some,
        "long": long / some,
    }


def statistics(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id`` and the ``STATISTICS`` of every row's whole text."""
    kind = docs.schema[id_column].dataType
    schema = StructType(
        [StructField("id", kind)] + [StructField(name, DoubleType()) for name in STATISTICS]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(1))
            columns = [pa.array(found[name], pa.float64()) for name in STATISTICS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["id", *STATISTICS]
            )

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return narrow.transform(mapped, describe, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction: each statistic named lies above its lower bound, up to its upper."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            if low > -np.inf:
                parts.append(F.col(name) > low)
            if high < np.inf:
                parts.append(F.col(name) <= high)
        return reduce(Column.__and__, parts)

    def __str__(self) -> str:
        return " and ".join(
            " and ".join(
                [f"{name} > {low:.4g}"] * (low > -np.inf)
                + [f"{name} <= {high:.4g}"] * (high < np.inf)
            )
            for name, low, high in self.bounds
        )


def _paths(node, bounds: dict[str, tuple[float, float]]) -> Iterator[Rule]:
    """The rules of all nodes below a node of a fitted tree."""
    if node.getClass().getSimpleName() != "InternalNode":
        return
    split = node.split()
    name, cut = STATISTICS[split.featureIndex()], split.threshold()
    low, high = bounds.get(name, (-np.inf, np.inf))
    for child, limits in (
        (node.leftChild(), (low, min(high, cut))),
        (node.rightChild(), (max(low, cut), high)),
    ):
        inner = {**bounds, name: limits}
        yield Rule(tuple((key, *inner[key]) for key in sorted(inner)))
        yield from _paths(child, inner)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules, ready to be used as a column over the ``STATISTICS``."""

    weights: dict[Rule, float]
    bias: float

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.holds(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def fit(
    sample: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
    seed: int = SEED,
) -> RuleEnsemble:
    """Rules and weights from rows of ``STATISTICS`` and ``label``; the caller bounds them.

    Without rows of both labels every score is the share of label 1 (one half without
    rows).
    """
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return RuleEnsemble({}, float(np.log((ones + 0.5) / (zeros + 0.5))))
    described = sample.select(
        "label", *STATISTICS, array_to_vector(F.array(*STATISTICS)).alias("features")
    )
    forest = RandomForestClassifier(
        labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, maxBins=64
    ).fit(described)
    rules = sorted(
        {
            rule
            for tree in forest.trees
            for rule in _paths(tree._call_java("rootNode"), {})
        },
        key=str,
    )
    if not rules:
        return RuleEnsemble({}, float(np.log(ones / zeros)))
    fired = F.array(*[rule.holds().cast("double") for rule in rules])
    lasso_fit = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60
    ).fit(described.select("label", array_to_vector(fired).alias("features")))
    weights = {
        rule: float(weight)
        for rule, weight in zip(rules, lasso_fit.coefficients.toArray(), strict=True)
        if weight
    }
    return RuleEnsemble(weights, float(lasso_fit.intercept))


def learn(
    stats: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE
) -> RuleEnsemble:
    """The ensemble, learned from at most ``sample`` rows with a usable label.

    A document with several labels is good if all of them say so; labels without id or
    value are left out.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & usable)
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min((F.col("quality") > 0).cast("int")).alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample)
    )
    # The chosen ids are at most ``sample`` rows. One order of rows, so that a second run
    # grows the same trees; repeated documents are cut to the bound as well.
    rows = (
        stats.join(F.broadcast(chosen), stats["id"] == chosen["labelled"])
        .orderBy(F.xxhash64("labelled"), "labelled", *STATISTICS)
        .limit(sample)
        .select("label", *STATISTICS)
    )
    return fit(stored(rows.coalesce(1)).cache())


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 3,
    fold: int = 1,
) -> DataFrame:
    """``<id>, held_out, score, predicted`` of every row of ``docs``.

    Labels are taken from rows outside of one fold of crc32(id as text). A row without id
    is not held out. Null and empty texts get the score of an empty text, repeated rows
    equal scores; an empty table gives no rows. Other columns are not read.
    """
    stats = stored(statistics(docs, id_column, text_column))
    ensemble = learn(stats, labels, crc_of_id("doc_id") % folds != fold)
    held_out = F.coalesce(crc_of_id("id") % folds == fold, F.lit(False))
    return stats.select(
        F.col("id").alias(id_column),
        held_out.alias("held_out"),
        ensemble.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bar: float = 0.5,
) -> DataFrame:
    """The documents with a quality of ``bar`` or more, with the same columns.

    All labels are used. Each row carries its statistics through the filter, so rows that
    share an id are judged one by one.
    """
    ensemble = learn(
        stored(statistics(docs, id_column, text_column)), labels, F.lit(True)
    )

    @F.arrow_udf(StructType([StructField(name, DoubleType()) for name in STATISTICS]))
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = measure(texts)
            yield pa.StructArray.from_arrays(
                [pa.array(found[name], pa.float64()) for name in STATISTICS],
                names=list(STATISTICS),
            )

    held, made = fresh_name(docs, "row"), fresh_name(docs, "statistics")
    judged = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias(held),
        described(F.col(f"`{text_column}`")).alias(made),
    )
    kept = judged.select(held, f"{made}.*").where(ensemble.score() >= bar)
    return kept.select(f"{held}.*")
