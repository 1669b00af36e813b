"""Bit-sliced filters, and held-out accuracy."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leadmill.llm import langid

WORDS = {
    "en": "the and of to that with this from have which would there".split(),
    "de": "der die das und nicht mit einen über für größe straße schön".split(),
    "fr": "le les des été être français avec pour dans où près garçon".split(),
}


def _texts(count, seed=1):
    chance = random.Random(seed)
    langs = [chance.choice(list(WORDS)) for _ in range(count)]
    return [" ".join(chance.choices(WORDS[lang], k=chance.randint(5, 40))) for lang in langs], langs


def test_held_out_accuracy(documents, by_id):
    texts, langs = _texts(400)
    texts += [None, "", "123 !?", "x" * 50_000, texts[0]]
    langs += ["en", None, "de", None, langs[0]]
    ids = [*range(len(texts) - 1), None]
    rows = langid.predict_held_out(documents(texts, ids, langs)).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for i in range(400):
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert found[i].lang_pred == langs[i] and 0 <= found[i].score <= 1
    assert [found[n].lang_pred for n in (400, 401, 402)] == ["und"] * 3
    assert found[403].lang_pred in WORDS
    assert not found[None].held_out and found[None].lang_pred == langs[0]


def test_labels_and_ids_do_not_matter_for_predictions(documents, by_id):
    texts, langs = _texts(60, 2)
    filters = langid.train(documents(texts, None, langs), least=2)
    plain = by_id(langid.identify(documents(texts), filters))
    other = by_id(langid.identify(documents(texts, None, ["zz"] * 60), filters))
    assert {k: r.lang_pred for k, r in plain.items()} == {k: r.lang_pred for k, r in other.items()}


def test_filters_hold_what_they_were_given():
    grams = [f"g{n}" for n in range(3000)]
    masks = np.zeros(1 << 15, dtype=np.uint64)
    for n, gram in enumerate(grams):
        masks[langid.slots_of([gram], len(masks), 3)] |= np.uint64(1 << (n % 3))
    filters = langid.Filters(["a", "b", "c"], masks)
    slots = langid.slots_of(grams, len(masks), 3)
    found = np.bitwise_and.reduce(masks[slots], axis=1)
    assert all(int(m) >> (n % 3) & 1 for n, m in enumerate(found))
    foreign = langid.slots_of([f"f{n}" for n in range(20_000)], len(masks), 3)
    hits = np.bitwise_and.reduce(masks[foreign], axis=1)
    for bit in range(3):
        share = float(((hits >> np.uint64(bit)) & np.uint64(1)).mean())
        assert abs(share - filters.chance[bit]) < 0.005


def test_cache_may_forget(monkeypatch):
    monkeypatch.setattr(langid, "_CACHE", 40)
    masks = np.full(64, 3, dtype=np.uint64)
    filters = langid.Filters(["a", "b"], masks)
    texts = [" ".join(f"{x}{y}" for x in "abcdefgh" for y in "ijklmn")] * 3 + [None]
    fresh = [filters.decide([t])[0][0] for t in texts]
    assert [lang for lang, _ in filters.decide(texts)] == fresh


def test_counts_survive_flushes_and_texts_without_letters(monkeypatch):
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["a", "b", "c", "a"], "text": ["xy zz", "xy", "12", "xy zz"]}
    )

    def counted():
        total = {}
        for part in langid._count_ngrams(iter([batch, batch])):
            assert part.schema.types == [pa.string(), pa.string(), pa.int64()]
            for row in part.to_pylist():
                key = row["lang"], row["gram"]
                total[key] = total.get(key, 0) + row["n"]
        return total

    whole = counted()
    assert whole["a", "<xy"] == 4 and whole["b", "y>"] == 2
    monkeypatch.setattr(langid, "_FLUSH", 0)
    assert counted() == whole


def test_nothing_learned(documents):
    rows = langid.predict_held_out(documents(["some words"], langs=[None])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert langid.predict_held_out(documents([])).collect() == []


def test_one_language(documents):
    rows = langid.predict_held_out(documents(["ab ba"] * 40, langs=["xx"] * 40)).collect()
    assert {r.lang_pred for r in rows} == {"xx"}


@pytest.mark.parametrize("text", ["½", "² ③ Ⅷ", "12 ¼ _", "— …"])
def test_signs_that_are_no_letters(text):
    assert langid.words_of(text) == [] or any(c.isalpha() for c in text)


def test_letters_of_many_scripts_stay():
    assert langid.words_of("Straße½ 東京二 один2два") == ["straße", "東京二", "один", "два"]


def test_words_are_cut_without_looking_each_letter_up_among_all_signs():
    plain = re.compile(rf"[^\W\d_{langid._SIGNS}]+")
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choices("abÉñß½²Ⅷ٣7_ .東一İ\u0301", k=rng.randint(0, 12)))
        assert langid.words_of(text) == plain.findall(text.lower())
    text = " ".join(rng.choices(WORDS["en"] + WORDS["de"], k=200_000))

    def seconds(cut):
        begun = time.process_time()
        cut(text)
        return time.process_time() - begun

    assert 3 * min(seconds(langid.words_of) for _ in range(3)) < seconds(
        lambda text: plain.findall(text.lower())
    )


def test_gram_numbers_are_the_ngrams():
    words = ["a", "straße", "東京", "\U00010400x", "one"]
    codes, sizes = langid._gram_codes(words)
    ends = np.cumsum(sizes).tolist()
    for word, end, size in zip(words, ends, sizes.tolist(), strict=True):
        found = Counter(map(langid._gram_of, codes[end - size : end].tolist()))
        assert found == Counter(langid.ngrams(word))
