from __future__ import annotations

import pytest

EXTRA = "id STRING, name STRING, n INT, row INT, t STRING, copy INT, place INT, gram STRING"


@pytest.fixture
def documents(spark):
    """A documents table, with further columns whose names operators use inside."""

    def make(texts, ids=None, langs=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        sources = sources or ["s"] * len(texts)
        rows = [
            (i, t, lang, s, None if t is None else len(t), "x", "y", 1, 2, "z", 3, 4, "g")
            for i, t, lang, s in zip(ids, texts, langs, sources, strict=True)
        ]
        return spark.createDataFrame(
            rows, f"doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, {EXTRA}"
        )

    return make


@pytest.fixture
def by_id():
    def collect(frame, key="doc_id"):
        return {row[key]: row for row in frame.collect()}

    return collect
