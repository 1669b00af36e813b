"""Benchmark passages against a plain search for windows."""

from __future__ import annotations

import random

import pytest

from leadmill.llm import decontaminate as d


def _brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        words = d.words_of(text)
        size = min(window, len(words))
        if name is not None and size:
            for at in range(len(words) - size + 1):
                windows.setdefault(tuple(words[at : at + size]), set()).add(str(name))
    out = {}
    for name, text in docs:
        words = d.words_of(text)
        hit, found = set(), set()
        for window_words, names in windows.items():
            size = len(window_words)
            for at in range(len(words) - size + 1):
                if tuple(words[at : at + size]) == window_words:
                    hit |= set(range(at, at + size))
                    found |= names
        out[name] = (len(words), len(hit), len(found), d.items_checksum(list(found)), bool(hit))
    return out


def _items(spark, items):
    return spark.createDataFrame(items, "item_id LONG, text STRING, doc STRING")


@pytest.mark.parametrize("block_words", [60, 200_000])
def test_equals_plain_search(spark, documents, by_id, block_words):
    chance = random.Random(3)

    def words(n, letters="abc"):
        return " ".join(chance.choice(letters) for _ in range(n))

    items = [(i, words(chance.randint(1, 40))) for i in range(12)]
    items += [(20, "a b"), (21, "b"), (22, None), (23, "-- !"), (None, "c c c"), (24, "a b")]
    texts = [words(chance.randint(0, 120), "abcd") for _ in range(25)]
    texts += [None, "", "A-B", "x " * 30_000 + items[0][1].upper(), texts[0]]
    found = d.find_passages(
        documents(texts), _items(spark, [(*x, "y") for x in items]), block_words=block_words
    )
    got = {k: tuple(r)[1:] for k, r in by_id(d.contamination(found)).items()}
    assert got == _brute(list(enumerate(texts)), items)


def test_empty_tables(spark, documents):
    empty = _items(spark, [])
    rows = d.contamination(d.find_passages(documents(["a b c"]), empty)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(3, 0, False)]
    assert d.find_passages(documents([]), _items(spark, [(1, "a", "")])).collect() == []
    assert d.remove_passages(documents(["a"]), empty).count() == 1


def test_spans_are_removed(spark, documents, by_id):
    passage = " ".join(f"w{n}" for n in range(12)).replace("0", "o")
    passage = " ".join("abcdefghijkl")
    clean = " ".join(f"x{chr(97 + n % 26)}" for n in range(40))
    texts = [f"{clean}, {passage}. {clean}", passage, clean, None, ""]
    docs = documents(texts)
    kept = by_id(d.remove_passages(docs, _items(spark, [(1, passage, "")])))
    assert set(kept) == {0, 2, 3, 4} and list(kept[0].asDict()) == docs.columns
    assert kept[0].text == f"{clean}, . {clean}" and kept[0].n_chars == len(kept[0].text)
    assert kept[2].text == clean and kept[3].text is None


def test_long_spans_remove_the_document(spark, documents):
    passage = " ".join(chr(97 + n % 26) * (1 + n // 26) for n in range(60))
    docs = documents([f"{passage} {'z y ' * 100}"])
    items = _items(spark, [(1, passage, "")])
    assert d.remove_passages(docs, items, longest=59).count() == 0
    assert d.remove_passages(docs, items, longest=60).count() == 1


def test_blocks_do_not_change_what_is_removed(spark, documents):
    def run(letter, size):
        return [letter + chr(97 + n // 26) + chr(97 + n % 26) for n in range(size)]

    one, two, long = run("p", 24), run("q", 24), run("r", 150)
    over = one[9:] + run("s", 10)
    items = [(1, " ".join(one), ""), (2, " ".join(two), ""), (3, " ".join(long), ""), (4, " ".join(over), "")]
    free = "z " * 40
    texts = [
        " ".join([*one, *free.split()[:30], *two]),  # each below half, together above
        " ".join([free, *one, *over[15:], free]),  # matches that overlap
        " ".join([free * 9, *long]),  # an item longer than a block
        free, None, "",
    ]
    docs, benchmark = documents(texts, [1, 1, None, None, 5, 6]), _items(spark, items)

    def kept(block_words, longest):
        rows = d.remove_passages(docs, benchmark, longest=longest, block_words=block_words)
        assert rows.columns == docs.columns
        return sorted((tuple(r) for r in rows.collect()), key=repr)

    for longest in (120, 200):
        whole = kept(200_000, longest)
        assert kept(60, longest) == whole
    assert len(whole) == 5 and not any(" pa" in (r[1] or "") or " s" in (r[1] or "") for r in whole)


def test_every_row_returns_from_several_blocks(spark, documents):
    items = [(n, " ".join(chr(97 + n) + chr(97 + k) for k in range(20)), "") for n in range(5)]
    texts = [text for _, text, _ in items] + ["z " * 20, items[0][1], None, None]
    docs = documents(texts, [None, None, None, 7, 7, 7, None, None, None])

    def rows(block_words):
        found = d.find_passages(docs, _items(spark, items), block_words=block_words)
        assert found.columns == ["doc_id", "n_words", "starts", "ends", "items"]
        return sorted((tuple(r) for r in found.collect()), key=repr)

    assert len(rows(200_000)) == len(texts) and rows(30) == rows(200_000)
