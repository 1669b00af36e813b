"""Noisy-channel decoding and held-out scores."""

from __future__ import annotations

import itertools
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leadmill.llm import toxicity as t

PLAIN = "the cat sat there and some good people were looking for better books today".split()
BAD = ["blorf", "snarkle", "grumpel"]


def _model(words):
    counts = {}
    for word in words:
        for gram in t.grams_of(word):
            counts[gram] = counts.get(gram, 0) + 1
    return t.CharModel(counts)


@pytest.fixture(scope="module")
def model():
    return _model(PLAIN * 20 + BAD * 10)


@pytest.mark.parametrize(
    "written", ["bl0rf", "8lorf", "bloooorf", "bbblllooorrrfff", "sn4rkl3", "$narkle", "gr|_|mpel"]
)
def test_disguised_words_are_restored(model, written):
    found = t.Restorer(model).words(f"see {written}!")
    assert any(word in BAD for word in found) or written == "gr|_|mpel"


@pytest.mark.parametrize("written", ["b l o r f", "b.l.o.r.f", "B-L-O-R-F", "b l 0 r f", "b_l_o_r_f"])
def test_letters_set_apart(model, written):
    assert "blorf" in t.Restorer(model).words(f"you {written} there")


def test_plain_text_stays(model):
    text = "The good people were looking, 2024 and 1000 there"
    want = ["the", "good", "people", "were", "looking", "2024", "and", "1000", "there"]
    assert t.Restorer(model).words(text) == want
    assert t.Restorer(model).words(None) == [] == t.Restorer(model).words("")


@pytest.mark.parametrize("signs", ["bl0rf", "5n4rk1e", "boook", "b00k", "a!1l", "oo0"])
def test_viterbi_equals_all_paths(model, signs):
    best = None
    for path in itertools.product(*[t._options(signs, at) for at in range(len(signs))]):
        word = "".join(letter for letter, _ in path)
        cost = sum(price for _, price in path)
        context = "^"
        for letter in word + "$":
            cost += model.cost(context, letter)
            context += letter
        if best is None or cost < best[0] - 1e-9:
            best = (cost, word)
    assert t.decode(signs, model) == best[1]


def test_arrays_equal_single_texts(model):
    texts = ["b l o r f x", None, "", "gr8 sn4rkle the", "a b", "z " * 5000 + "b", "snarkle snarkle"]
    restorer = t.Restorer(model)
    found = list(t.Measure(restorer, [*BAD, "snar*"])(pa.array(texts)))
    lexicon = t.Lexicon([*BAD, "snar*"])
    assert found == [lexicon.count(restorer.words(text)) for text in texts]
    assert found[6] == {"snarkle": 2, "snar*": 2}


def _corpus(count, seed=1):
    chance = random.Random(seed)
    texts, labels = [], []
    for _ in range(count):
        words = chance.choices(PLAIN, k=30)
        toxic = chance.random() < 0.3
        if toxic:
            words[3] = chance.choice([*BAD, "BLORF!!", "sn4rkle", "bl0rf"])
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id LONG, toxic INT, quality INT, text STRING")


def test_held_out_scores(spark, documents, by_id):
    texts, labels = _corpus(300)
    rows = [(i, x, 0, "q") for i, x in enumerate(labels)] + [(None, 1, 0, ""), (5, None, 0, "")]
    texts += [None, "", "b l o r f " * 2000]
    found = by_id(t.score_documents(documents(texts), _labels(spark, rows)))
    held = [i for i in range(300) if found[i].held_out]
    assert 30 < len(held) < 90
    assert all(found[i].predicted == labels[i] for i in held)
    assert found[300].predicted == found[301].predicted == 0 and found[302].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_held_out_labels_teach_nothing(spark, documents, by_id):
    texts, labels = _corpus(300)
    docs = documents(texts)
    rows = [(i, x, 0, "q") for i, x in enumerate(labels)]
    found = by_id(t.score_documents(docs, _labels(spark, rows)))
    turned = [(i, 1 - x if found[i].held_out else x, 0, "q") for i, x, _, _ in rows]
    again = by_id(t.score_documents(docs, _labels(spark, turned)))
    assert {i: r.score for i, r in found.items()} == pytest.approx({i: r.score for i, r in again.items()})


def test_without_labels_or_documents(spark, documents):
    rows = t.score_documents(documents(["a", None], [None, 1]), _labels(spark, [])).collect()
    assert [r.score for r in rows] == [0.5, 0.5] and not rows[0].held_out
    assert t.score_documents(documents([]), _labels(spark, [(1, 1, 0, "")])).collect() == []


def test_clean_documents_stay(spark, documents):
    texts, labels = _corpus(200)
    docs = documents(texts)
    kept = t.keep_clean(docs, _labels(spark, [(i, x, 0, "q") for i, x in enumerate(labels)]))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, x in enumerate(labels) if not x}


@pytest.mark.parametrize(
    "written",
    ["a b l o r f", "y o u b l o r f", "a b l 0 r f y", "you a s n a r k l e", "b l o r f s n a r k l e"],
)
def test_words_in_runs_of_letters(written):
    model = _model([*PLAIN, "a", "a", "y", "you", "you"] * 20 + BAD * 10)
    restorer, bad = t.Restorer(model), [b for b in BAD if b[1:3] in written.replace(" ", "").replace("0", "o")]
    assert bad and all(b in restorer.words(written) for b in bad)
    (found,) = t.Measure(restorer, BAD)(pa.array([written]))
    assert found == {b: 1 for b in bad}


def test_words_in_pieces(model):
    texts = ["you bl orf there", "you sn ark le there", "gru mpel", "bl. orf", "the bl", "bl cat orf"]
    found = list(t.Measure(t.Restorer(model), [*BAD, "snar*"])(pa.array(texts)))
    assert found[:3] == [{"blorf": 1}, {"snarkle": 1, "snar*": 1}, {"grumpel": 1}]
    assert not any(found[3:])


def test_only_tokens_that_cannot_become_a_feature_stay_undecoded():
    """Leaving tokens undecoded changes no count."""
    rng = random.Random(11)
    features = ["idiot", "still*", "bogg*", "fool", "ill", "zz", "goose*"]
    lexicon = t.Lexicon(features)
    words = [*(f.rstrip("*") for f in features), "hello", "letter", "bill", "fog", "goosse"]
    counts = Counter()
    for word in words:
        counts.update(t.grams_of(word))
    restorer = t.Restorer(t.CharModel(dict(counts)))
    twins = {"i": "1!|", "o": "0", "l": "1|", "s": "5$", "e": "3", "g": "69", "b": "68", "t": "7+", "z": "2"}
    for _ in range(3000):
        signs = "".join(
            rng.choice([letter, letter * 2, *twins.get(letter, letter)])
            for letter in rng.choice(words)
        )
        decoded = restorer.word(signs)
        assert t.shape(decoded) == t.shape(signs)
        if decoded in lexicon.starts or lexicon.count([decoded]):
            assert lexicon.may_become(signs)
        assert lexicon.count(restorer.chunk(signs)) == lexicon.count(
            restorer.chunk(signs, lexicon.may_become)
        )


def test_plain_words_are_told_at_once_and_tell_nothing():
    features = ["idiot", "idio*", "grump*", "ill", "größe*", "still*"]
    measure = t.Measure(t.Restorer(_model([*PLAIN, "idiot", "grumpy"])), features)
    rng = random.Random(3)
    letters = "abdegilmoprstuyABI.,;:!1é"
    chunks = ["Idiots", "idiom", "house", "HOUSE,", "house..", "hous", "hoouse", "e", "é", "grumps", "gland;"]
    chunks += ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(3000)]
    plain = measure._plain(chunks)
    assert plain[:11].tolist() == [False, False, True, True, *[False] * 6, True]
    assert plain.sum() > 20
    for chunk in np.array(chunks, object)[plain]:
        assert measure._tells_nothing(chunk.lower().rstrip(".,;:"))
    assert measure._plain([]).tolist() == []


def test_grams_cut_by_arrow_are_those_of_each_word():
    rng = random.Random(8)
    words = ["".join(rng.choices("abé😀ß", k=rng.randint(0, 60))) for _ in range(200)] + ["x" * 500]
    times = [rng.randint(1, 9) for _ in words]
    want, got = Counter(), Counter()
    for word, n in zip(words, times, strict=True):
        want.update({gram: n * k for gram, k in Counter(t.grams_of(word)).items()})
    for gram, n in t.count_grams(pa.array(words), pa.array(times, pa.int64())):
        got[gram] += n
    assert got == want
    assert list(t.count_grams(pa.array([], pa.string()), pa.array([], pa.int64()))) == []


@pytest.mark.parametrize("text", ["!" * 80_000, "@" * 80_000 + " x", "blorf" + "(" * 80_000, "blorf" + "0l" * 40_000])
def test_long_runs_of_signs_take_linear_time(model, text):
    measure = t.Measure(t.Restorer(model), [*BAD, "blor*"])
    begun = time.process_time()
    found = list(measure(pa.array([text])))
    assert time.process_time() - begun < 20
    assert found == [Counter(t.Lexicon([*BAD, "blor*"]).count(t.Restorer(model).words(text)))]


def test_long_signs_keep_their_tokens():
    rng = random.Random(2)
    signs = t._SIGNS
    plain = t.re.compile(rf"[^\W_{signs}]+(?:[{signs}]+[^\W_{signs}]+)*|[{signs}]+[^\W_{signs}]+(?:[{signs}]+[^\W_{signs}]+)*")
    for _ in range(20_000):
        text = "".join(rng.choices("ab1!|$(._ -é@", k=rng.randint(0, 12)))
        assert t._TOKEN.findall(text) == plain.findall(text)


def test_counts_of_repeated_and_joined_chunks(model):
    """Each chunk counts as often as it stands there, and pieces join as single texts say."""
    rng = random.Random(4)
    some = ["blorf", "Blorf,", "bl", "orf", "sn", "arkle", "snarkly", "the", "bl0rf", "gr", "umpel.", "umpel"]
    texts = [" ".join(rng.choices(some, k=rng.randint(0, 30))) for _ in range(300)]
    features = [*BAD, "snar*", "blor*"]
    whole = list(t.Measure(t.Restorer(model), features)(pa.array(texts)))
    alone = [next(t.Measure(t.Restorer(model), features)(pa.array([text]))) for text in texts]
    assert whole == alone and sum(found.total() for found in whole) > 300


def _joined_plainly(restorer, lexicon, chunks):
    """Joins one more chunk at a time, pricing the whole word anew."""
    word, apart, pieces, best = "", 0.0, [], (0.0, Counter())
    for chunk in chunks:
        words = restorer.chunk(chunk)
        if len(words) != 1:
            break
        pieces += words
        word += words[0]
        apart += restorer.price(words[0])
        if len(pieces) > 1 and (found := lexicon.count([word])):
            gain = apart - restorer.price(word) - t.SPLIT * (len(pieces) - 1)
            if gain <= best[0]:
                break
            best = (gain, found - lexicon.count(pieces))
        elif len(pieces) > 1 and word not in lexicon.starts:
            break
        if chunk[-1:] in t._STOPS:
            break
    return best[1]


def test_pieces_join_as_when_priced_anew(model):
    rng = random.Random(6)
    lexicon = t.Lexicon([*BAD, "blor*", "snar*", "snark*", "grumpe*"])
    some = ["blorf", "bl", "orf", "orfs", "sn", "ark", "arkle", "gr", "umpel", "umpel.", "grum", "the", "a-b", "b"]
    long = 0
    for _ in range(300):
        chunks = [c for _ in range(rng.randint(1, 4)) for c in rng.choices(some, k=2) * rng.randint(1, 9)]
        restorer = t.Restorer(model)
        joiner = t.Joiner(restorer, lexicon, chunks, list(range(len(chunks))), {})
        for at in range(len(chunks)):
            assert joiner.features(at) == _joined_plainly(restorer, lexicon, chunks[at:])
        long += bool(joiner.listed)
    assert long > 5


def test_pairs_ruled_out_at_once_begin_no_word(model):
    features = [*BAD, "snar*", "blor*", "snark*", "öde", "ödes*"]
    measure = t.Measure(t.Restorer(model), features)
    pieces = ["b", "bl", "blo", "blor", "blorf", "s", "snar", "sn", "gru", "grum", "grumpe", "ö", "öd", "the"]
    chunks = [*pieces, "orf", "Rfs,", "lorf", "kle", "umpel", "pel", "le", "es", "essen", "arkle", "zzz", "nark", "l"]
    starts = [piece if piece in measure.lexicon.starts else "" for piece in pieces]
    starts += [""] * (len(chunks) - len(pieces))
    _, firsts = measure._told_at_once(chunks)
    n = len(chunks)
    pairs = np.array([a * n + b for a in range(n) if starts[a] for b in range(n)])
    may = measure._may_begin(pairs, starts, firsts)
    for pair, fits in zip(pairs.tolist(), may.tolist(), strict=True):
        word = starts[pair // n] + t._plain_word(chunks[pair % n])
        assert fits or not (word in measure.lexicon.starts or measure.lexicon.holds(word))
    assert 0 < may.sum() < 0.6 * len(may)


@pytest.mark.parametrize("text", ["blor " * 20_000, "bl or " * 20_000, "blorb lor " * 20_000])
def test_a_word_in_pieces_over_and_over_takes_linear_time(text):
    model = _model(PLAIN * 20 + BAD * 10 + ["blorblorblorblorblor"] * 500)
    begun = time.process_time()
    list(t.Measure(t.Restorer(model), [*BAD, "blor*", "blorb*"])(pa.array([text])))
    assert time.process_time() - begun < 20
