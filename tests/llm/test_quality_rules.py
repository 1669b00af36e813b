"""Statistics against plain counting, rules against trees, and held-out accuracy."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadmill.llm import quality_rules as q

HARD = [
    None,
    "",
    " \n\t ",
    "Plain words, and more words.\nSecond line!!",
    "## $$ %%% abc%%% || --",
    "again again again once Again",
    "Été déjà VU 12345 x",
    "a" * 5000 + " " + "b" * 25,
    "!",
    "!",
]


def _plain(text):
    """The statistics of one text, counted letter by letter."""
    text = text or ""
    words = [word for word in re.split("[ \t\n\v\f\r]+", text) if word]
    mark = set(".,;:!?'\"()-")
    ascii_symbols = {chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()} - mark
    upper = sum("A" <= c <= "Z" for c in text)
    lower = sum("a" <= c <= "z" for c in text)
    other = sum(ord(c) > 127 for c in text)
    digits = sum("0" <= c <= "9" for c in text)
    marks = sum(c in mark for c in text)
    symbols = sum(c in ascii_symbols for c in text)
    letters = upper + lower + other
    black = letters + digits + marks + symbols
    some = max(len(words), 1)
    return {
        "size": math.log1p(black),
        "words": math.log1p(len(words)),
        "word_length": black / some,
        "upper": upper / max(letters, 1),
        "digits": digits / max(black, 1),
        "marks": marks / some,
        "symbols": symbols / some,
        "doubled": sum(
            a == b and a in mark | ascii_symbols for a, b in zip(text, text[1:], strict=False)
        )
        / some,
        "other_letters": other / max(letters, 1),
        "lines": text.count("\n") / some,
        "repeats": sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
        "distinct": len(set(words)) / some,
        "bare": sum(not any(c.isalnum() for c in word) for word in words) / some,
        "short": sum(len(word) <= 3 for word in words) / some,
        "long": sum(len(word) > 20 for word in words) / some,
    }


def test_statistics_equal_plain_counting():
    found = q.measure(pa.array(HARD, pa.string()))
    for at, text in enumerate(HARD):
        want = _plain(text)
        assert {name: pytest.approx(found[name][at]) for name in q.STATISTICS} == want
    assert all(len(column) == 0 for column in q.measure(pa.array([], pa.string())).values())


def _corpus(count, seed=1):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(300)]
    texts, good = [], []
    for _ in range(count):
        said = draw.choices(words, k=draw.randint(20, 80))
        kind = draw.randint(0, 5)
        if kind == 0:
            said = [word + draw.choice(["%%%", "$$$"]) for word in said]
        elif kind == 1:
            said = [word for word in said[:12] for _ in range(6)]
        texts.append(" ".join(said))
        good.append(int(kind > 1))
    return texts, good


def _labels(spark, good, ids=None):
    ids = range(len(good)) if ids is None else ids
    rows = [(i, g, 7, 8) for i, g in zip(ids, good, strict=True)]
    return spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT, id INT")


def test_held_out_accuracy_and_reruns(spark, documents):
    texts, good = _corpus(500)
    docs, labels = documents(texts), _labels(spark, good)
    rows = q.score_documents(docs, labels).collect()
    again = q.score_documents(docs.repartition(7), labels).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    held = [row for row in rows if row["held_out"]]
    assert len(held) > 100
    assert np.mean([row["predicted"] == good[row["doc_id"]] for row in held]) > 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_score_is_the_sum_of_the_rules_that_hold(spark, documents):
    texts, good = _corpus(300, seed=2)
    stats = q.stored(q.statistics(documents(texts)))
    ensemble = q.learn(stats, _labels(spark, good), F.lit(True))
    assert ensemble.weights and len(ensemble.weights) < q.TREES * 14
    for row in stats.withColumn("score", ensemble.score()).collect():
        total = ensemble.bias + sum(
            weight
            for rule, weight in ensemble.weights.items()
            if all(low < row[name] <= high for name, low, high in rule.bounds)
        )
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_one_kind_of_label_or_none(spark, documents):
    docs = documents(["one text", None, ""])
    scores = {row["score"] for row in q.score_documents(docs, _labels(spark, [])).collect()}
    assert scores == {0.5}
    rows = q.score_documents(docs, _labels(spark, [1, 1, 1], [50, 51, 52])).collect()
    assert len(rows) == 3 and len({row["score"] for row in rows}) == 1


def test_null_ids_repeated_rows_and_empty_tables(spark, documents):
    texts, good = _corpus(120, seed=3)
    ids = [*range(118), None, 117]
    rows = q.score_documents(documents(texts, ids=ids), _labels(spark, good, ids)).collect()
    assert len(rows) == 120
    assert [row["held_out"] for row in rows if row["doc_id"] is None] == [False]
    none = documents([])
    assert q.score_documents(none, _labels(spark, good, ids)).collect() == []
    assert q.keep_good(none, _labels(spark, [])).collect() == []


def test_keep_good_keeps_columns_and_judges_each_row(spark, documents):
    texts, good = _corpus(300, seed=4)
    docs = documents(texts, ids=[None if i == 5 else i for i in range(300)])
    kept = q.keep_good(docs, _labels(spark, good))
    assert kept.columns == docs.columns
    wanted = {text for text, label in zip(texts, good, strict=True) if label}
    found = {row["text"] for row in kept.collect()}
    assert len(wanted ^ found) < 10
