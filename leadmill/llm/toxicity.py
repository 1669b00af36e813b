"""Toxicity scores of texts after undoing disguised spelling.

A noisy channel: the writer meant a word and spelt it with look-alike signs, repeated
letters, or letters set apart. Each sign of a disguised word opens a lattice of letters it
may stand for (itself, what it looks like, nothing if it repeats the sign before), each
at a price. Viterbi decoding finds the cheapest path under the lattice's prices and a
character language model. A word of plain letters without repeats has a single path and
is its own decoding. In a run of letters set apart by blanks the lattice may also end a
word and start the next one after each letter. Neighbouring pieces of two or more letters
are read as one word if that makes a word of the lexicon and is the cheaper reading.

The restored words are scored by logistic regression on a lexicon. The character model is
counted over all texts; lexicon and weights are fitted on a bounded sample of labelled
documents.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import crc_of_id, mapped, stored, word_runs

ORDER = 4
#: An n-gram tells something if it is at least one in so many of all.
RAREST = 2_000_000
SAMPLE = 20_000
LEAST_DOCS = 5
#: Twice this log likelihood ratio is far out in a chi-squared distribution.
LEAST_SIGNAL = 10.0
BEGINNINGS = (4, 5, 6)
_FLUSH = 200_000
_STOPS = frozenset(".!?;:")
_CACHE = 300_000
_LONG = 48
# The letters that signs are used for, with most likely ones first.
LOOKS = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "il",
    "|": "li",
    "+": "t",
    "€": "e",
    "£": "l",
    "¡": "i",
    "(": "c",
}
_SIGNS = re.escape("".join(sign for sign in LOOKS if not sign.isdigit()))
# Signs at the front are taken once for each run of them, so long runs take linear time.
_LETTERS_ON = rf"[^\W_{_SIGNS}]++(?:[{_SIGNS}]++[^\W_{_SIGNS}]++)*"
_TOKEN = re.compile(rf"{_LETTERS_ON}|(?<![{_SIGNS}])[{_SIGNS}]++{_LETTERS_ON}")
_APART = re.compile(
    rf"(?<![^\W_])(?:(?:[^\W_]|[{_SIGNS}])[.*_~-]{{1,3}}){{2,}}(?:[^\W_]|[{_SIGNS}])(?![^\W_])"
)
_GAP_SIGNS = re.compile(r"[.*_~-]")
_EDGES = re.compile(rf"^[^\w{_SIGNS}]+|[^\w{_SIGNS}]+$")
_PLAIN = re.compile(r"[^\W\d_]+")
_REPEAT = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1+")


def _classes() -> dict[int, str]:
    """Each sign and each letter that it may be read as under one letter for all of them."""
    held: dict[str, str] = {}
    for sign, letters in LOOKS.items():
        group = {held.get(each, each) for each in (sign, *letters)}
        name = min(group & set(letters) or {letters[0]})
        held.update({each: name for each, of in held.items() if of in group})
        held.update(dict.fromkeys((sign, *letters), name))
    return {ord(each): name for each, name in held.items()}


_CLASSES = _classes()
#: Prices in natural logarithms: reading a sign as a letter, leaving out a repeat.
READ, SECOND, REPEAT, LONG_REPEAT = 1.0, 1.5, 4.0, 0.5
#: The price of a blank inside a word.
SPLIT = 1.0
_START, _END = "^", "$"
_NOTHING: tuple[Counter | None, str, str] = (None, "", "")


class CharModel:
    """Character n-grams with back-off, over lower-case words with their borders."""

    def __init__(self, counts: dict[str, int], order: int = ORDER):
        self.order, self.counts = order, counts
        heads: Counter = Counter()
        for gram, count in counts.items():
            heads[gram[:-1]] += count
        self.heads = heads
        self.known: dict[str, float] = {}

    def cost(self, context: str, letter: str) -> float:
        """Minus the log probability of a letter after up to ``order - 1`` others."""
        gram = context[-(self.order - 1) :] + letter
        price = self.known.get(gram)
        if price is None:
            price, rest = 0.0, gram
            while len(rest) > 1 and rest not in self.counts:
                rest = rest[1:]
                price += math.log(2.5)
            if rest in self.counts:
                price += math.log(self.heads[rest[:-1]] / self.counts[rest])
            else:
                price += 12.0
            if len(self.known) < 500_000:
                self.known[gram] = price
        return price


def grams_of(word: str, order: int = ORDER) -> list[str]:
    marked = f"{_START}{word}{_END}"
    return [
        marked[max(0, end - size) : end]
        for end in range(1, len(marked) + 1)
        for size in range(1, min(order, end) + 1)
    ]


def count_grams(words: pa.Array, counts: pa.Array, order: int = ORDER) -> Iterator[tuple]:
    """N-grams of words that occur so often, with their counts.

    Those of words up to ``_LONG`` letters are cut by Arrow, place by place.
    """
    marked = pc.binary_join_element_wise(_START, words, _END, "")
    lengths = pc.utf8_length(marked)
    short = pc.less_equal(lengths, _LONG)
    for word, n in zip(
        words.filter(pc.invert(short)).to_pylist(),
        counts.filter(pc.invert(short)).to_pylist(),
        strict=True,
    ):
        for gram in grams_of(word, order):
            yield gram, n
    marked, lengths, counts = (x.filter(short) for x in (marked, lengths, counts))
    grams, often = [], []
    for at in range(pc.max(lengths).as_py() or 0):
        for size in range(1, order + 1):
            fits = pc.greater_equal(lengths, at + size)
            grams.append(pc.utf8_slice_codeunits(marked.filter(fits), at, at + size))
            often.append(counts.filter(fits))
    if grams:
        table = pa.table({"gram": pa.chunked_array(grams), "n": pa.chunked_array(often)})
        summed = table.group_by("gram").aggregate([("n", "sum")])
        yield from zip(summed["gram"].to_pylist(), summed["n_sum"].to_pylist(), strict=True)


def _options(signs: str, at: int) -> list[tuple[str, float]]:
    """The letters that a sign of a word may stand for, and their prices."""
    sign = signs[at]
    looks = LOOKS.get(sign, "")
    here = [(look, READ if n == 0 else SECOND) for n, look in enumerate(looks)]
    if sign.isalpha() or not looks:
        here.append((sign, 0.0))
    if at and signs[at - 1] == sign:
        long = signs[max(0, at - 2) : at] == sign * 2 or signs[at : at + 2] == sign * 2
        here.append(("", LONG_REPEAT if long else REPEAT))
    return here


def shape(word: str) -> str:
    """What decoding leaves as it is: letters by class, and no repeats.

    A decoding takes one letter of its class for each sign, or leaves out a repeated sign
    but for the first, so a spelling and all its decodings have the same shape.
    """
    return _RUN.sub(r"\1", word.translate(_CLASSES))


def decode(signs: str, model: CharModel) -> str:
    """The most likely word behind a spelling."""
    keep = model.order - 1
    # Paths by their last letters, which is all that the model looks back to. While there
    # is only one path, what it costs does not matter.
    # Their letters are a chain from the last one, as in runs.
    paths: dict[str, tuple[float, tuple | None]] = {_START: (0.0, None)}
    before = ""
    for at, sign in enumerate(signs):
        one = sign != before and sign not in LOOKS
        before = sign
        if one and len(paths) == 1:
            ((context, (_, chain)),) = paths.items()
            paths = {(context + sign)[-keep:]: (0.0, (chain, sign))}
            continue
        following: dict[str, tuple[float, tuple | None]] = {}
        for letter, extra in [(sign, 0.0)] if one else _options(signs, at):
            for context, (price, chain) in paths.items():
                total, after, longer = price + extra, context, chain
                if letter:
                    total += model.cost(context, letter)
                    after, longer = (context + letter)[-keep:], (chain, letter)
                best = following.get(after)
                if best is None or total < best[0]:
                    following[after] = (total, longer)
        paths = following
    if len(paths) == 1:
        ((_, (_, chain)),) = paths.items()
        return _spelling(chain)
    ends = [
        (price + model.cost(context, _END), chain)
        for context, (price, chain) in paths.items()
    ]
    least = min(price for price, _ in ends)
    return min(_spelling(chain) for price, chain in ends if price == least)


def _spelling(chain: tuple | None) -> str:
    """The letters of a chain, first one first."""
    letters = []
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters))


def decode_run(signs: str, model: CharModel) -> list[str]:
    """The most likely words behind signs that were all set apart."""
    keep = model.order - 1
    # Paths by their last letters, with price and letters as a chain from the last one.
    paths: dict[str, tuple[float, tuple | None]] = {_START: (0.0, None)}
    for at in range(len(signs)):
        breaks = [
            (price + model.cost(context, _END), chain)
            for context, (price, chain) in paths.items()
            if context != _START
        ]
        if breaks:
            price, chain = min(breaks, key=lambda path: path[0])
            if _START not in paths or price < paths[_START][0]:
                paths[_START] = (price, (chain, " "))
        following: dict[str, tuple[float, tuple | None]] = {}
        for letter, extra in _options(signs, at):
            for context, (price, chain) in paths.items():
                total, after, longer = price + extra, context, chain
                if letter:
                    total += model.cost(context, letter)
                    after, longer = (context + letter)[-keep:], (chain, letter)
                best = following.get(after)
                if best is None or total < best[0]:
                    following[after] = (total, longer)
        paths = following
    _, chain = min(
        (
            (price + (model.cost(context, _END) if context != _START else 0.0), chain)
            for context, (price, chain) in paths.items()
        ),
        key=lambda path: path[0],
    )
    return _spelling(chain).split()


class Restorer:
    """Texts to restored words, with a bounded cache of decodings."""

    def __init__(self, model: CharModel):
        self.model = model
        self.cache: dict[str, str] = {}
        self.runs: dict[str, list[str]] = {}
        self.prices: dict[str, float] = {}

    def word(self, token: str, matters: Callable[[str], bool] | None = None) -> str:
        """The restored word; a token that does not matter to the caller stays as it is."""
        if token.isdigit() or token.isalpha() and not _REPEAT.search(token):
            return token
        if matters is not None and not matters(token):
            return token
        known = self.cache.get(token)
        if known is None:
            if len(self.cache) >= _CACHE:
                self.cache.clear()
            known = self.cache[token] = decode(token, self.model)
        return known

    def chunk(
        self, chunk: str, matters: Callable[[str], bool] | None = None
    ) -> list[str]:
        """The words of what stands between white space; ``matters`` as for ``word``."""
        low = chunk.lower()
        core = low.rstrip(".,;:")
        if core.isalpha():
            return [self.word(core, matters)]
        words = [self.word(token, matters) for token in _TOKEN.findall(low)]
        if len(low) > 4 and _GAP_SIGNS.search(low):
            for apart in _APART.findall(low):
                words.append(self.word(_GAP_SIGNS.sub("", apart), matters))
        return words

    def spelt(self, letters: list[str]) -> list[str]:
        """The words of letters that were set apart by blanks."""
        signs = "".join(letters)
        if signs.isdigit():
            return [signs]
        known = self.runs.get(signs)
        if known is None:
            if len(self.runs) >= _CACHE:
                self.runs.clear()
            known = self.runs[signs] = decode_run(signs, self.model)
        return known

    def price(self, word: str) -> float:
        """What a word costs under the character model."""
        known = self.prices.get(word)
        if known is None:
            if len(self.prices) >= _CACHE:
                self.prices.clear()
            total, last = self.more(0.0, _START, word)
            known = self.prices[word] = total + self.model.cost(last, _END)
        return known

    def more(self, total: float, last: str, word: str) -> tuple[float, str]:
        """The price of a beginning that ends with ``last`` and of a word behind it, without
        its end, and the last letters then."""
        keep, cost = self.model.order - 1, self.model.cost
        for letter in word:
            total += cost(last, letter)
            last = (last + letter)[-keep:]
        return total, last

    def words(self, text: str | None) -> list[str]:
        """The restored words, then those that were written letter by letter."""
        chunks = text.split() if text else []
        found = [word for chunk in chunks for word in self.chunk(chunk)]
        letters = [letter_of(chunk) for chunk in chunks]
        for start, stop in _runs(np.array([bool(x) for x in letters], dtype=bool)):
            found.extend(self.spelt(letters[start:stop]))
        return found


def _plain_word(chunk: str) -> str:
    """The word of a chunk that is left as it is; empty if decoding may change it."""
    core = chunk.lower().rstrip(".,;:")
    return core if core.isalpha() and not _REPEAT.search(core) else ""


def letter_of(chunk: str) -> str:
    """The letter or sign that a chunk is, but for punctuation; else empty."""
    if len(chunk) > 8 or chunk.isalpha():
        return chunk.lower() if len(chunk) == 1 else ""
    core = _EDGES.sub("", chunk.lower())
    return core if len(core) == 1 else ""


def _runs(single: np.ndarray, least: int = 3) -> list[tuple[int, int]]:
    """Where at least ``least`` in a row are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    pairs = edges.reshape(-1, 2)
    return [(a, b) for a, b in pairs.tolist() if b - a >= least]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of plain words, added up as far as memory allows."""
    held: dict[str, int] = {}
    get = held.get
    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def flush() -> pa.RecordBatch:
        counts = pa.array(held.values(), pa.int64())
        rows = pa.RecordBatch.from_pydict({"word": list(held), "n": counts}, schema=kind)
        held.clear()
        return rows

    for batch in batches:
        for chunks, places, _ in word_runs(batch.column(0)):
            counts = np.bincount(places, minlength=len(chunks)).tolist()
            for chunk, count in zip(chunks, counts, strict=True):
                low = chunk.lower()
                core = low.rstrip(".,;:!?")
                # A chunk of letters alone is its only word.
                for word in (core,) if core.isalpha() else _PLAIN.findall(low):
                    held[word] = get(word, 0) + count
            if len(held) > _FLUSH:
                yield flush()
    yield flush()


def character_model(
    docs: DataFrame, text_column: str = "text", rarest: int = RAREST, order: int = ORDER
) -> CharModel:
    """The character model of all texts.

    N-grams that are less than one in ``rarest`` of all are left out, so at most that many
    reach the driver and the same ones stay however many texts of a kind there are.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        kind = pa.schema([("gram", pa.string()), ("n", pa.int64())])

        def flush() -> pa.RecordBatch:
            counts = pa.array(found.values(), pa.int64())
            rows = pa.RecordBatch.from_pydict({"gram": list(found), "n": counts}, schema=kind)
            found.clear()
            return rows

        for batch in batches:
            for gram, n in count_grams(batch.column(0), batch.column(1), order):
                found[gram] += n
            if len(found) > _FLUSH:
                yield flush()
        yield flush()

    words = (
        docs.select(F.col(text_column).alias("t"))
        .transform(mapped, _count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counts = stored(
        words.transform(mapped, cut, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    )
    every = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = counts.where(F.col("n") * rarest >= every).toPandas()
    return CharModel(dict(zip(rows["gram"], rows["n"].tolist(), strict=True)), order)


def features_of(word: str) -> list[str]:
    """A word and its beginnings, so that inflected forms count together."""
    return [word, *(f"{word[:size]}*" for size in BEGINNINGS if len(word) >= size)]


class Lexicon:
    """Finds the features of a lexicon in words."""

    def __init__(self, features):
        self.features = frozenset(features)
        self.heads = frozenset(feature[: BEGINNINGS[0]] for feature in self.features)
        #: What a word of the lexicon may begin with, but for the whole of it.
        self.starts = frozenset(
            feature[:size]
            for feature in self.features
            for size in range(1, len(feature.rstrip("*")))
        )

        #: Beginnings that are features, by their size.
        self.begins = [
            (size, frozenset(f[:-1] for f in self.features if len(f) == size + 1 and f[-1] == "*"))
            for size in BEGINNINGS
        ]
        #: The letters a-z that may follow such a beginning, a bit for each.
        self.next_letters: Counter = Counter()
        for feature in self.features:
            for at, letter in enumerate(feature.rstrip("*")):
                if at and "a" <= letter <= "z":
                    self.next_letters[feature[:at]] |= 1 << ord(letter) - ord("a")
        long = [head.encode() for head in self.heads if len(head) == BEGINNINGS[0]]
        self.head_codes = np.array(
            [int.from_bytes(head, "little") for head in long if len(head) == 4], np.uint32
        )
        self.head_shapes = frozenset(shape(head) for head in self.heads)
        self.start_shapes = frozenset(shape(start) for start in self.starts)

    def may_become(self, token: str) -> bool:
        """Whether a decoding of a token can be a word of the lexicon or begin one.

        Exact in saying no, by the shapes that they would share: decoding all other tokens
        would change nothing.
        """
        form, heads = shape(token), self.head_shapes
        return form in self.start_shapes or any(
            form[:size] in heads for size in range(1, BEGINNINGS[0] + 1)
        )

    def may_hold(self, words: list[str]) -> bool:
        heads, size = self.heads, BEGINNINGS[0]
        return any([word[:size] in heads for word in words])

    def holds(self, word: str) -> bool:
        """Whether a word has a feature of the lexicon."""
        if word in self.features:
            return True
        for size, begins in self.begins:
            if word[:size] in begins:
                return True
        return False

    def count(self, words: list[str]) -> Counter:
        heads, size = self.heads, BEGINNINGS[0]
        found: Counter = Counter()
        for word in words:
            if word[:size] in heads:
                for feature in features_of(word):
                    if feature in self.features:
                        found[feature] += 1
        return found


class Joiner:
    """The words that the chunks of one text make if neighbours are read as one.

    ``own`` tells which of the different ``chunks`` stands at each place, ``cut`` keeps their
    words. Once no word of the lexicon begins as the joined word does, a further piece
    leaves its features as they are and joins or not by the few letters before it,
    wherever the word began. So how far that goes is found once for each place.
    """

    def __init__(self, restorer: Restorer, lexicon: Lexicon, chunks, own, cut: dict):
        self.restorer, self.lexicon = restorer, lexicon
        self.chunks, self.own, self.cut = chunks, own, cut
        self.ends: dict[int, int] = {}
        self.having: dict[str, list[int]] = {}
        self.listed = 0

    def piece(self, place: int) -> str:
        """The only word at a place; empty if there are several or none."""
        which = self.own[place]
        words = self.cut.get(which)
        if words is None:
            words = self.cut[which] = self.restorer.chunk(self.chunks[which])
        return words[0] if len(words) == 1 else ""

    def stops(self, place: int) -> bool:
        return self.chunks[self.own[place]][-1:] in _STOPS

    def features(self, at: int) -> Counter:
        """The features of the word from a place on, if it is the cheaper reading."""
        lexicon, restorer = self.lexicon, self.restorer
        word, apart, joined, last = "", 0.0, 0.0, _START
        best: tuple[float, Counter] = (0.0, Counter())
        pieces: list[str] = []
        for place in range(at, len(self.own)):
            piece = self.piece(place)
            if not piece:
                break
            pieces.append(piece)
            word += piece
            apart += restorer.price(piece)
            joined, last = restorer.more(joined, last, piece)
            if len(pieces) > 1 and (found := lexicon.count([word])):
                whole = joined + restorer.model.cost(last, _END)
                gain = apart - whole - SPLIT * (len(pieces) - 1)
                if gain <= best[0]:
                    break
                # What the pieces tell by themselves is counted already.
                best = (gain, found - lexicon.count(pieces))
                del found[word]
                if found and self._settled(word) and not self.stops(place):
                    end = self._end(place + 1, last)
                    return self._left(found, at, end) if end > place + 1 else best[1]
            elif len(pieces) > 1 and word not in lexicon.starts:
                break
            if self.stops(place):
                break
        return best[1]

    def _settled(self, word: str) -> bool:
        """Whether more letters change neither its features nor what the model looks back to."""
        least = max(BEGINNINGS[-1], self.restorer.model.order - 1)
        return len(word) >= least and word not in self.lexicon.starts

    def _end(self, place: int, last: str) -> int:
        """Where the pieces stop joining a settled word that goes up to a place."""
        restorer, cost = self.restorer, self.restorer.model.cost
        passed = []
        while place not in self.ends:
            piece = self.piece(place) if place < len(self.own) else ""
            if piece:
                more, after = restorer.more(-cost(last, _END), last, piece)
            if not piece or restorer.price(piece) - more - cost(after, _END) - SPLIT <= 0:
                self.ends[place] = place
                break
            passed.append(place)
            place, last = place + 1, after
            if self.stops(place - 1):
                self.ends[passed.pop()] = place
                break
        else:
            place = self.ends[place]
        self.ends.update(dict.fromkeys(passed, place))
        return place

    def _left(self, found: Counter, at: int, end: int) -> Counter:
        """The features that no piece up to an end has; asked for ascending places."""
        for place in range(max(self.listed, at), end):
            for feature in self.lexicon.count([self.piece(place)]):
                self.having.setdefault(feature, []).append(place)
        self.listed = max(self.listed, end)

        def missing(feature: str) -> bool:
            places = self.having.get(feature, [])
            first = bisect_left(places, at)
            return first == len(places) or places[first] >= end

        return Counter(filter(missing, found))


class Measure:
    """Counts the features of a lexicon in texts, looking at each chunk only once."""

    def __init__(self, restorer: Restorer, features):
        self.restorer, self.lexicon = restorer, Lexicon(features)
        self.cache: dict[str, tuple[Counter | None, str, str]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _chunk(self, chunk: str) -> tuple[Counter | None, str, str]:
        """Features, the letter that it is, and its word if more may belong to it."""
        known = self.cache.get(chunk)
        if known is None:
            if len(self.cache) >= _CACHE:
                self.cache.clear()
            lexicon, core = self.lexicon, _plain_word(chunk)
            if not core and self._tells_nothing(chunk.lower().rstrip(".,;:")):
                self.cache[chunk] = _NOTHING
                return _NOTHING
            words = [core] if core else self.restorer.chunk(chunk, lexicon.may_become)
            found = lexicon.count(words) if lexicon.may_hold(words) else None
            letter = "" if len(core) > 1 else letter_of(chunk)
            piece = words[0] if len(words) == 1 and words[0] in lexicon.starts else ""
            known = (found, letter, piece) if found or letter or piece else _NOTHING
            self.cache[chunk] = known
        return known

    def _tells_nothing(self, core: str) -> bool:
        """Whether a chunk is one word that is neither in the lexicon nor may become so."""
        lexicon = self.lexicon
        return (
            len(core) > 1
            and core.isalpha()
            and core[: BEGINNINGS[0]] not in lexicon.heads
            and core not in lexicon.starts
            and not (_REPEAT.search(core) and lexicon.may_become(core))
        )

    def _plain(self, chunks: list[str]) -> np.ndarray:
        return self._told_at_once(chunks)[0]

    def _told_at_once(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which chunks surely tell nothing, for all of them at a time.

        These are words of five letters a-z or more without a repeated letter, in either
        case and with a sign behind them or not, that begin as no feature does. Also
        returns the first three letters of each such word of three letters or more, whatever
        it begins as, in the bytes of a number; zero for other chunks.
        """
        array = pa.array(chunks, pa.large_string())
        _, offsets, data = array.buffers()
        ends = np.frombuffer(offsets, np.int64, len(chunks) + 1)
        signs = np.frombuffer(data, np.uint8, int(ends[-1])) if ends[-1] else np.zeros(0, np.uint8)
        starts, stops = ends[:-1], ends[1:]
        signs = np.where((signs >= 65) & (signs <= 90), signs | 32, signs)
        stops = stops - np.isin(signs[stops - 1], np.frombuffer(b".,;:", np.uint8))
        odd = (signs < 97) | (signs > 122)
        odd[1:] |= signs[1:] == signs[:-1]
        # A first letter that equals the last one of the chunk before repeats nothing.
        odd[starts] = (signs[starts] < 97) | (signs[starts] > 122)
        bad = np.concatenate([[0], np.cumsum(odd)])
        words = (stops - starts >= 3) & (bad[stops] == bad[starts])
        at = starts[words]
        firsts = np.zeros(len(chunks), np.uint32)
        codes = signs[at].astype(np.uint32)
        for n in range(1, 3):
            codes |= signs[at + n].astype(np.uint32) << np.uint32(8 * n)
        firsts[words] = codes
        plain = words & (stops - starts >= 5)
        at = starts[plain]
        codes = firsts[plain] | signs[at + 3].astype(np.uint32) << np.uint32(24)
        plain[plain] = ~np.isin(codes, self.lexicon.head_codes)
        return plain, firsts

    def __call__(self, texts: pa.Array) -> Iterator[Counter]:
        for chunks, places, counts in word_runs(texts):
            held = self.cache.get
            plain, firsts = self._told_at_once(chunks)
            known = [
                _NOTHING if nothing else held(chunk) or self._chunk(chunk)
                for chunk, nothing in zip(chunks, plain.tolist(), strict=True)
            ]
            telling = np.array([bool(found) for found, _, _ in known], dtype=bool)
            single = np.array([bool(letter) for _, letter, _ in known], dtype=bool)
            pieces = [piece for _, _, piece in known]
            stops = np.cumsum(counts)
            each = [Counter() for _ in counts]
            where = np.flatnonzero(telling[places]) if len(places) else np.empty(0, int)
            pairs = np.searchsorted(stops, where, "right") * len(chunks) + places[where]
            pairs, times = np.unique(pairs, return_counts=True)
            for pair, often in zip(pairs.tolist(), times.tolist(), strict=True):
                own = each[pair // len(chunks)]
                for feature, n in known[pair % len(chunks)][0].items():
                    own[feature] += n * often
            # Letters set apart; a run ends with its text.
            alone = np.flatnonzero(single[places]) if len(places) else np.empty(0, int)
            for text in np.unique(np.searchsorted(stops, alone, "right")).tolist():
                begin = int(stops[text] - counts[text])
                own = places[begin : int(stops[text])]
                for start, stop in _runs(single[own]):
                    letters = [known[place][1] for place in own[start:stop]]
                    each[text].update(self.lexicon.count(self.restorer.spelt(letters)))
            cut: dict[int, list[str]] = {}
            joiner, begin, end = None, 0, 0
            for at in self._split_words(chunks, places, pieces, firsts, single):
                if at >= end:
                    text = int(np.searchsorted(stops, at, "right"))
                    begin, end = int(stops[text] - counts[text]), int(stops[text])
                    own = places[begin:end].tolist()
                    joiner = Joiner(self.restorer, self.lexicon, chunks, own, cut)
                each[text].update(joiner.features(at - begin))
            yield from each

    def _split_words(self, chunks, places, pieces, firsts, single) -> list[int]:
        """Where a word of the lexicon may have been cut into pieces."""
        if len(places) < 2:
            return []
        begins = np.array([bool(piece) for piece in pieces], dtype=bool)
        at = np.flatnonzero(begins[places[:-1]] & ~(single[places[:-1]] & single[places[1:]]))
        pairs = places[at].astype(np.int64) * len(chunks) + places[at + 1]
        different, which = np.unique(pairs, return_inverse=True)
        fits = np.zeros(len(different), dtype=bool)
        cores: dict[int, str] = {}
        lexicon = self.lexicon
        open_pairs = np.flatnonzero(self._may_begin(different, pieces, firsts))
        for n, pair in zip(open_pairs.tolist(), different[open_pairs].tolist(), strict=True):
            one, two = divmod(pair, len(chunks))
            core = cores.get(two)
            if core is None:
                core = cores[two] = _plain_word(chunks[two])
            if core:  # it is its own decoding
                word = pieces[one] + core
                fits[n] = word in lexicon.starts or lexicon.holds(word)
                continue
            both = (chunks[one], chunks[two])
            known = self.pairs.get(both)
            if known is None:
                piece = pieces[one]
                words = self.restorer.chunk(
                    both[1], lambda token: self.lexicon.may_become(piece + token)
                )
                word = piece + words[0] if len(words) == 1 else ""
                known = word in lexicon.starts or bool(word and lexicon.holds(word))
                if len(self.pairs) >= _CACHE:
                    self.pairs.clear()
                self.pairs[both] = known
            fits[n] = known
        return at[fits[which]].tolist()

    def _may_begin(self, pairs: np.ndarray, pieces: list[str], firsts: np.ndarray) -> np.ndarray:
        """Which pairs of a piece and a chunk may begin as a feature does.

        Told by four letters of both for short pieces, by the letter behind it for others.
        """
        lexicon = self.lexicon
        sizes, codes, nexts = np.zeros((3, len(pieces)), np.uint32)
        for n, piece in enumerate(pieces):
            if not piece:
                continue
            if len(piece) < BEGINNINGS[0] and piece.isascii():
                sizes[n], codes[n] = len(piece), int.from_bytes(piece.encode(), "little")
            nexts[n] = 0xFFFFFFFF if lexicon.holds(piece) else lexicon.next_letters[piece]
        one, two = np.divmod(pairs, len(pieces))
        letters = firsts[two]
        told = letters > 0
        follows = nexts[one] >> (letters & 255) - 97 & 1
        short = sizes[one] > 0
        joined = codes[one] | letters << 8 * sizes[one]
        fits = np.where(short, np.isin(joined, lexicon.head_codes), follows > 0)
        return ~told | fits


class Scorer:
    """Logistic regression on how often the features of a lexicon occur."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, found: Counter) -> float:
        total = self.bias + sum(
            self.weights[name] * math.log1p(count) for name, count in sorted(found.items())
        )
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, total))))


def _signal(toxic, clean, n_toxic: float, n_clean: float):
    """How far a word's documents speak for toxic (log likelihood ratio), else zero."""
    share = (toxic + clean) / F.lit(n_toxic + n_clean)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rest = part(n_toxic - toxic, n_toxic * (1 - share)) + part(
        n_clean - clean, n_clean * (1 - share)
    )
    both = part(toxic, n_toxic * share) + part(clean, n_clean * share)
    return F.when(toxic / n_toxic > clean / n_clean, both + rest).otherwise(0.0)


def fit(
    labelled: DataFrame,
    model: CharModel,
    least_docs: int = LEAST_DOCS,
    least_signal: float = LEAST_SIGNAL,
) -> Scorer:
    """A scorer from ``text, toxic``; the caller bounds the rows.

    The lexicon holds all words and beginnings of words whose documents speak clearly for
    toxic; the rows given bound it. Without rows of both kinds every score is the share of
    toxic rows (one half without rows).
    """
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast((model.counts, model.order))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharModel(*shared.value))
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(restorer.words(text))
                found[toxic].update({f for word in words for f in features_of(word)})
        words = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(words, pa.string()),
                "clean": pa.array([found[0][w] for w in words], pa.int64()),
                "toxic": pa.array([found[1][w] for w in words], pa.int64()),
            }
        )

    totals = dict(
        (row["toxic"], row["count"])
        for row in labelled.groupBy("toxic").count().collect()
    )
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Scorer({}, math.log(share / (1 - share)))
    signal = _signal(F.col("toxic"), F.col("clean"), float(n_toxic), float(n_clean))
    words = [
        row["word"]
        for row in labelled.select("text", "toxic")
        .transform(mapped, count, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= least_docs)
        .withColumn("signal", signal)
        .where(F.col("signal") > least_signal)
        .orderBy(F.desc("signal"), "word")
        .collect()
    ]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_features = Measure(Restorer(CharModel(*shared.value)), words)
        places = {word: at for at, word in enumerate(words)}
        kind = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        for batch in batches:
            rows = [
                [{"at": places[name], "n": n} for name, n in sorted(found.items())]
                for found in count_features(batch.column(0))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, kind)], names=["toxic", "found"]
            )

    rows = (
        labelled.select("text", "toxic")
        .transform(mapped, measure, "toxic int, found array<struct<at:int,n:int>>")
        .collect()
    )
    found = [[(seen["at"], math.log1p(seen["n"])) for seen in row["found"]] for row in rows]
    labels = np.array([row["toxic"] for row in rows], float)
    weights = _logistic(found, len(words), labels)
    return Scorer(dict(zip(words, weights[:-1].tolist(), strict=True)), float(weights[-1]))


def _logistic(
    found: list[list[tuple[int, float]]], size: int, labels: np.ndarray, ridge: float = 1.0
) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the bias, last, is free.

    ``found`` lists the features of each row; they become a matrix some rows at a time.
    """

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(found), 1024):
            some = found[at : at + 1024]
            features = np.zeros((len(some), size + 1))
            features[:, -1] = 1.0
            for row, pairs in enumerate(some):
                for place, value in pairs:
                    features[row, place] = value
            yield features, labels[at : at + 1024]

    weights = np.zeros(size + 1)
    prices = np.full(size + 1, ridge)
    prices[-1] = 1e-6
    for _ in range(50):
        slope, bend = prices * weights, np.diag(prices)
        for features, truth in blocks():
            guess = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
            slope += features.T @ (guess - truth)
            bend += (features * (guess * (1 - guess))[:, None]).T @ features
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    usable,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """At most ``sample`` labelled documents as ``text, toxic``, chosen by hash of id.

    A document with several labels is toxic if one of them says so; labels without id or
    value are left out.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample)
    )
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # The chosen ids are at most ``sample`` rows.
    return stored(
        narrow.join(F.broadcast(chosen), narrow["id"] == chosen["labelled"])
        .select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("text", "toxic"))
        .limit(sample)
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    )


class Detector:
    """A character model and a scorer, ready to be sent to tasks."""

    def __init__(self, model: CharModel, scorer: Scorer):
        self.model, self.scorer = model, scorer

    def column(self, docs: DataFrame, text_column: str = "text"):
        """The score of each row's text, 0 to 1; null and empty texts get one too."""
        parts = (
            self.model.counts,
            self.model.order,
            self.scorer.weights,
            self.scorer.bias,
        )
        shared = docs.sparkSession.sparkContext.broadcast(parts)

        @F.arrow_udf("double")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            counts, order, weights, bias = shared.value
            scorer = Scorer(weights, bias)
            measure = Measure(Restorer(CharModel(counts, order)), weights)
            for texts in batches:
                yield pa.array([scorer.score(f) for f in measure(texts)], pa.float64())

        return score(F.col(text_column))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 5,
    fold: int = 0,
) -> Detector:
    """The detector, learned from labels outside of one fold of crc32(id as text)."""
    model = character_model(docs, text_column)
    usable = crc_of_id("doc_id") % folds != fold
    sample = labelled_sample(docs, labels, usable, id_column, text_column)
    return Detector(model, fit(sample, model))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 5,
    fold: int = 0,
) -> DataFrame:
    """``<id>, held_out, score, predicted`` of every row.

    A row without id is not held out. Repeated rows get equal scores.
    """
    narrow = docs.select(id_column, text_column)
    detector = learn(narrow, labels, id_column, text_column, folds, fold)
    held_out = F.coalesce(crc_of_id(id_column) % folds == fold, F.lit(False))
    return narrow.select(
        id_column,
        held_out.alias("held_out"),
        detector.column(narrow, text_column).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bar: float = 0.5,
) -> DataFrame:
    """The documents with a score below the bar, with the same columns."""
    detector = learn(docs, labels, id_column, text_column)
    return docs.where(detector.column(docs, text_column) < bar)
