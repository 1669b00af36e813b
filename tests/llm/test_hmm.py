"""The hidden Markov model against plain recursions."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from leadmill.llm import hmm


def _model(states=3, symbols=5, seed=2):
    r = np.random.default_rng(seed)
    return hmm.Model(
        r.dirichlet(np.ones(states)),
        r.dirichlet(np.ones(states), states),
        r.dirichlet(np.ones(symbols), states).T.copy(),
    )


def _paths(model, symbols, start):
    """Probability of every state path."""
    states = len(model.start)
    for path in itertools.product(range(states), repeat=len(symbols)):
        p = start[path[0]] * model.emit[symbols[0], path[0]]
        for (a, b), s in zip(itertools.pairwise(path), symbols[1:], strict=True):
            p *= model.move[a, b] * model.emit[s, b]
        yield path, p


def test_likelihood_is_the_sum_over_all_paths():
    model = _model()
    texts = [[0, 1, 4], [2], [3, 3, 1, 0, 2, 4]]
    row, lengths = np.concatenate(texts), np.array([len(x) for x in texts])
    got = model.log10(row, lengths)
    want = [math.log10(sum(p for _, p in _paths(model, x, model.start))) for x in texts]
    assert got == pytest.approx(want)


def test_long_texts_do_not_underflow():
    model = _model()
    score = model.log10(np.zeros(50_000, np.int64), np.array([50_000]))
    assert np.isfinite(score).all() and score[0] < -1000


@pytest.mark.parametrize("held", [1, 5, 1 << 19])
def test_expected_counts_are_those_of_all_paths(monkeypatch, held):
    """Whatever the number of words whose forward states are held."""
    monkeypatch.setattr(hmm, "HELD", held)
    model = _model()
    texts = [[0, 1, 4, 2, 2, 3], [1], [3, 3, 1, 0], [2, 2], [4, 0, 0, 1, 3]]
    got = model.expect(np.concatenate(texts), np.array([len(x) for x in texts]))
    want = hmm.Expected.zero(5, 3)
    for text in texts:
        whole = sum(p for _, p in _paths(model, text, model.start))
        for path, p in _paths(model, text, model.start):
            want.start[path[0]] += p / whole
            for s, k in zip(text, path, strict=True):
                want.emit[s, k] += p / whole
            for a, b in itertools.pairwise(path):
                want.move[a, b] += p / whole
    for name in ("start", "move", "emit"):
        assert getattr(got, name) == pytest.approx(getattr(want, name)), name
    frame = hmm.pa.Table.from_batches([got.table()]).to_pandas()
    again = hmm.Expected.of_table(frame, 5, 3)
    assert again.emit == pytest.approx(got.emit) and again.move == pytest.approx(got.move)


def test_rounds_raise_the_likelihood():
    chance = np.random.default_rng(4)
    texts = [chance.integers(0, 10, 60) + 10 * (n % 2) for n in range(60)]
    row, lengths = np.concatenate(texts), np.full(60, 60)
    counts = np.bincount(row, minlength=20).astype(float)
    model, before = hmm.Model.first(counts, 2), -np.inf
    for _ in range(6):
        now = model.log10(row, lengths).sum()
        assert now > before - 1
        before = now
        model = model.expect(row, lengths).model(counts / counts.sum())
    unigram = (np.log10(counts / counts.sum())[row]).sum()
    assert before > unigram + 500  # it finds out that there are two kinds of texts


def test_equal_texts_have_equal_sums():
    chance = np.random.default_rng(5)
    part, lengths = chance.random(37), np.array([0, 37, 11, 0, 37, 37, 0])
    values = np.concatenate([part, chance.random(11), part, part])
    sums = hmm._sums(values, lengths)
    assert sums[1] == sums[4] == sums[5] == pytest.approx(part.sum())
    assert not sums[[0, 3, 6]].any()
    assert not hmm._sums(np.zeros(0), np.zeros(2, np.int64)).any()


def _tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [hmm.END]


def test_base_scores_and_counts(documents, by_id):
    chance = random.Random(3)
    vocabulary = [f"w{n}" for n in range(30)] + ["ÄÖ", "Äö", "a b"]
    texts = [" ".join(chance.choices(vocabulary, k=chance.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " \t\n", "NEW words\x0bhere w1", "long " * 30_000, texts[0], "no id w2"]
    ids = [*range(len(texts) - 2), 0, None]
    docs = documents(texts, ids)
    rows = hmm.score_held_out(docs).collect()
    train = Counter()
    for i, text in zip(ids, texts, strict=True):
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(_tokens(text))
    n, v = sum(train.values()), len(train)
    want = []
    for i, text in zip(ids, texts, strict=True):
        words = _tokens(text)
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words)
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        want.append((str(i), held, len(words), sum(train[w] > 0 for w in words), n, base))
    got = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
        for r in rows
    ]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


@pytest.mark.parametrize("known, symbols", [(4, 2), (1000, 3)])
def test_the_model_is_a_distribution(spark, documents, known, symbols):
    """One-word texts: all words and one unseen word of each class add up to one."""
    from pyspark.sql import functions as F

    training = ["aa bb aa", "cc aa dd", "bb ee", "aa"]
    words = ["aa", "bb", "cc", "dd", "ee"]
    docs = documents(training + words)
    scored = hmm.score_texts(
        docs, F.col("doc_id") < len(training), known=known, symbols=symbols, rounds=2
    )
    rows = {r.doc_id: r for r in scored.collect()}
    total = sum(10 ** rows[len(training) + n].score for n in range(len(words)))
    assert 0 < total < 1
    assert rows[4].score > rows[7].score  # the frequent word is likelier
    assert all(rows[4 + n].n_known == 2 for n in range(5))


def test_without_training_or_documents(spark, documents):
    from pyspark.sql import functions as F

    rows = hmm.score_texts(documents(["a b", None]), F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 0, 0), (3, 0, 0)]
    assert all(math.isfinite(r.score) for r in rows)
    assert hmm.score_held_out(documents([])).collect() == []
