"""The pipeline against plain versions of its stages, and the registered queries."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from compare import connect, difference
from tokenizers import Tokenizer

import __spark_entry__ as entries
import corpus_pipeline
from leadmill.llm import decontaminate, queries, simhash

SF_DIR = "/root/testdata/sf0.001"
NUMBERS = range(1, 11)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage made, read again."""
    docs = queries.table(spark, SF_DIR, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF_DIR)))
    return out


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(frame.columns == stages[0].columns for frame in stages[:-1])


def test_toxic_documents_go(spark):
    # The smallest tables label eleven toxic documents, too few to learn from.
    folder = "/root/testdata/sf0.01"
    docs = queries.table(spark, folder, "documents")
    labels = {r.doc_id: r.toxic for r in queries.table(spark, folder, "labels").collect()}
    after = {r.doc_id for r in corpus_pipeline.clean(spark, docs, folder).collect()}
    clean = {i for i, toxic in labels.items() if not toxic}
    toxic = set(labels) - clean
    assert len(clean & after) >= 0.98 * len(clean)
    assert len(toxic & after) <= 0.4 * len(toxic)


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, simhash.fingerprint(r.text)) for r in stages[1].collect())
    root = {}
    for n, (i, p) in enumerate(rows):
        near = {root[j] for j, q in rows[:n] if (p ^ q).bit_count() <= 4}
        root[i] = min(near, default=i)
        for j in list(root):
            if root[j] in near:
                root[j] = root[i]
    assert {r.doc_id for r in stages[2].collect()} == set(root.values())


def test_passages_are_gone(spark, stages):
    items = [r.text for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    windows = set()
    for text in items:
        words = decontaminate.words_of(text)
        size = min(10, len(words))
        if size:
            windows |= {tuple(words[n : n + size]) for n in range(len(words) - size + 1)}
    sizes = {len(w) for w in windows}

    def hit(text):
        words = decontaminate.words_of(text)
        return any(
            tuple(words[n : n + size]) in windows
            for size in sizes
            for n in range(len(words) - size + 1)
        )

    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    for i, text in before.items():
        if hit(text):
            assert after.get(i) is None or len(after[i]) < len(text)
        else:
            assert after[i] == text


def test_sources_meet_their_targets(stages):
    def words(rows):
        total = Counter()
        for r in rows:
            total[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        return total

    before, after = words(stages[3].collect()), words(stages[4].collect())
    names, weights = sorted(before), (5, 2, 1)
    weight = {s: weights[n % 3] for n, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(before.values()) - sum(3 * before[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        above = {
            s for s in names if s not in capped and left * weight[s] / rest > 3 * before[s]
        }
        if not above:
            break
        capped |= above
    longest = max(len(r.text.split()) for r in stages[3].collect() if r.text)
    for s in names:
        goal = 3 * before[s] if s in capped else left * weight[s] / rest
        assert abs(after[s] - goal) <= longest, s


def test_ids_are_those_of_the_library(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for row in sorted(stages[4].collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2]
        want.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in stages[5].collect()) == want


def test_run_is_all_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(stages[5].collect())


def test_every_operator_is_registered():
    names = entries.queries()
    for number in NUMBERS:
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    found = difference(
        spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]
    )
    assert found is None
