"""Language identification with bit-sliced Bloom filters of n-grams.

Every slot of one table holds a bitmask, a bit for each language, so the filters of all
languages share their probes: the masks at an n-gram's slots, combined by *and*, are the
languages whose filter holds it. For a text the n-grams of each language are counted;
the count is corrected for the share of n-grams that the language's filter accepts by
chance, known from how full it is, and the language with the largest corrected count wins.

N-grams are those of words with their borders marked. A language's filter holds those
that are typical of it: seen at least ``least`` times in its texts, and with a share of
all n-grams of the language that is at least ``lead`` times the mean share over all
languages. Counts are taken over all training texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import crc_of_id, mapped, stored

SIZES = (1, 2, 3)
SLOTS = 1 << 21
PROBES = 3
LEAST = 20
LEAD = 1.5
MOST_LANGUAGES = 64
UNDECIDED = "und"
_FLUSH = 200_000
_CACHE = 400_000
_TEXTS = 256
_AT_ONCE = 50_000
# Signs such as ½ or ² are word characters, but no letters.
_SIGNS = "".join(
    sign for sign in map(chr, range(0x80, 0x110000)) if sign.isnumeric() and not sign.isalpha()
)
_LETTERS = re.compile(rf"[^\W\d_{_SIGNS}]+")
#: The class of all signs is searched for each letter; it is left to runs that hold one.
_RUNS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    runs = _RUNS.findall(text.lower()) if text else []
    if all(map(str.isalpha, runs)):
        return runs
    return [word for run in runs for word in ((run,) if run.isalpha() else _LETTERS.findall(run))]


def ngrams(word: str) -> list[str]:
    marked = f"<{word}>"
    return [
        marked[at : at + size] for size in SIZES for at in range(len(marked) - size + 1)
    ]


def _gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of words one after the other, as numbers, and how many each word has.

    A number holds the code points of an n-gram, 21 bits each.
    """
    signs = np.frombuffer("".join(f"<{word}>" for word in words).encode("utf-32-le"), np.uint32)
    signs = signs.astype(np.int64)
    lengths = np.array([len(word) + 2 for word in words])
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(signs))
    codes = np.zeros((len(signs), len(SIZES)), np.int64)
    code = np.zeros(len(signs), np.int64)
    for size in range(1, max(SIZES) + 1):
        code[: len(signs) - size + 1] |= signs[size - 1 :] << (21 * (size - 1))
        if size in SIZES:
            codes[:, SIZES.index(size)] = np.where(left >= size, code, 0)
    fits = left[:, None] >= np.array(SIZES)
    word_ends = np.cumsum(lengths)
    before = np.concatenate([[0], np.cumsum(fits.sum(axis=1))])
    return codes[fits], np.diff(before[np.concatenate([[0], word_ends])])


def _gram_of(code: int) -> str:
    """The n-gram behind a number."""
    return "".join(chr(code >> at & 0x1FFFFF) for at in (0, 21, 42) if code >> at)


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, gram, n`` from ``lang, text``, added up as far as memory allows."""
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in words.items():
            grams: Counter = Counter()
            each, times = list(counts), np.array(list(counts.values()), np.int64)
            for at in range(0, len(each), _AT_ONCE):
                codes, sizes = _gram_codes(each[at : at + _AT_ONCE])
                different, which = np.unique(codes, return_inverse=True)
                sums = np.zeros(len(different), np.int64)
                np.add.at(sums, which, np.repeat(times[at : at + _AT_ONCE], sizes))
                for code, n in zip(different.tolist(), sums.tolist(), strict=True):
                    grams[code] += n
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(grams), pa.string()),
                    "gram": pa.array(list(map(_gram_of, grams)), pa.string()),
                    "n": pa.array(grams.values(), pa.int64()),
                }
            )
        words.clear()

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, words.values())) > _FLUSH:
                yield from flush()
    yield from flush()


class Filters:
    """The filters of all languages: a mask for each slot."""

    def __init__(self, languages: list[str], masks: np.ndarray, probes: int = PROBES):
        self.languages, self.masks, self.probes = languages, masks, probes
        bits = np.arange(len(languages), dtype=np.uint64)
        filled = [int(((masks >> bit) & np.uint64(1)).sum()) for bit in bits]
        #: The share of foreign n-grams that each filter accepts.
        self.chance = (np.array(filled) / len(masks)) ** probes
        self.bits = bits
        self._forget()

    def _forget(self) -> None:
        self.grams: dict[int, int] = {}
        self.rows: dict[str, int] = {}
        #: A row for each known word: hits of each language, and its n-grams.
        self.hits = np.zeros((0, len(self.languages) + 1), dtype=np.int32)

    def _learn(self, words: list[str]) -> None:
        """Looks new words up, all at once."""
        if len(self.rows) + len(words) > _CACHE:
            self._forget()
        codes, sizes = _gram_codes(words)
        different, which = np.unique(codes, return_inverse=True)
        listed = different.tolist()
        fresh = [code for code in listed if code not in self.grams]
        if fresh:
            slots = slots_of(list(map(_gram_of, fresh)), len(self.masks), self.probes)
            masks = np.bitwise_and.reduce(self.masks[slots], axis=1)
            self.grams.update(zip(fresh, masks.tolist(), strict=True))
        known = np.fromiter(map(self.grams.__getitem__, listed), np.uint64, len(listed))
        flat = known[which]
        starts = np.cumsum(sizes) - sizes
        columns = [
            np.add.reduceat(((flat >> bit) & np.uint64(1)).astype(np.int32), starts)
            for bit in self.bits
        ]
        held = len(self.hits)
        self.rows.update((word, held + at) for at, word in enumerate(words))
        added = np.column_stack([*columns, sizes]).astype(np.int32)
        self.hits = np.concatenate([self.hits, added])

    def decide(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """For each text the language and its share of the corrected counts."""
        out = []
        for at in range(0, len(texts), _TEXTS):
            each = [words_of(text) for text in texts[at : at + _TEXTS]]
            fresh = list({w for words in each for w in words if w not in self.rows})
            for start in range(0, len(fresh), _CACHE // 4):
                self._learn(fresh[start : start + _CACHE // 4])
            out += [self._decide(words) for words in each]
        return out

    def _decide(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return UNDECIDED, 0.0
        sums = np.zeros(len(self.languages) + 1, dtype=np.int64)
        for at in range(0, len(words), _CACHE // 4):
            part = words[at : at + _CACHE // 4]
            gone = list({w for w in part if w not in self.rows})
            if gone:  # forgotten meanwhile
                self._learn(gone)
                part_rows = [self.rows.get(w) for w in part]
                if None in part_rows:
                    self._learn(list(dict.fromkeys(part)))
            rows = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            sums += self.hits[rows].sum(axis=0)
        hits, total = sums[:-1], sums[-1]
        real = np.maximum(hits - total * self.chance, 0.0) / (1.0 - self.chance + 1e-12)
        best = int(real.argmax())
        whole = real.sum()
        if whole <= 0:
            return self.languages[best], 0.0
        return self.languages[best], float(real[best] / whole)


def slots_of(grams: list[str], slots: int, probes: int) -> np.ndarray:
    """The slots of each n-gram: probes from two halves of one hash."""
    hashes = np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64)
    first, step = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    turns = np.arange(probes, dtype=np.uint64)
    return ((first[:, None] + turns * step[:, None]) % np.uint64(slots)).astype(np.int64)


def train(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    slots: int = SLOTS,
    probes: int = PROBES,
    least: int = LEAST,
    lead: float = LEAD,
) -> Filters:
    """The filters learned from the texts with a language, all of them.

    Rows with a null text or language teach nothing. At most 64 languages fit a mask.
    What reaches the driver is the filter table, ``slots`` masks, whatever the corpus.
    """
    spark = docs.sparkSession
    counts = stored(
        docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
        .select(F.col(lang_column).alias("lang"), F.col(text_column).alias("t"))
        .transform(mapped, _count_ngrams, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    listed = totals.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(listed) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages do not fit the masks")
    languages = [row["lang"] for row in listed]
    empty = np.zeros(slots, dtype=np.uint64)
    if not languages:
        return Filters([], empty, probes)
    # One row a language, at most 64.
    scale = F.broadcast(
        spark.createDataFrame(
            [
                (row["lang"], float(row["total"]), int(np.uint64(1 << at).view(np.int64)))
                for at, row in enumerate(listed)
            ],
            "lang string, total double, flag long",
        )
    )
    shares = counts.join(scale, "lang").withColumn("share", F.col("n") / F.col("total"))
    means = shares.groupBy("gram").agg(
        (F.sum("share") / len(languages)).alias("mean"),
        F.collect_list(F.struct("flag", "share", "n")).alias("seen"),
    )

    # With a single language nothing can stand out; then all its n-grams count.
    bar = lead if len(languages) > 1 else 0.0
    typical = means.select(
        "gram",
        F.aggregate(
            F.filter(
                "seen",
                lambda x: (x["n"] >= least) & (x["share"] >= bar * F.col("mean")),
            ),
            F.lit(0).cast("long"),
            lambda mask, x: mask.bitwiseOR(x["flag"]),
        ).alias("mask"),
    ).where(F.col("mask") != 0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = slots_of(batch.column(0).to_pylist(), slots, probes)
            masks = np.repeat(batch.column(1).to_numpy(), probes)
            yield pa.RecordBatch.from_pydict({"slot": places.ravel(), "mask": masks})

    filled = (
        typical.transform(mapped, place, "slot long, mask long")
        .groupBy("slot")
        .agg(F.bit_or("mask").alias("mask"))
    ).toPandas()
    empty[filled["slot"].to_numpy(dtype=np.int64)] = (
        filled["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    )
    return Filters(languages, empty, probes)


def identify(
    docs: DataFrame,
    filters: Filters,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``<id>, lang_pred, score`` of every row.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if
    nothing was learned. Ties go to the first language in code point order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (filters.languages, filters.masks, filters.probes)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        for batch in batches:
            pairs = own.decide(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in pairs], pa.string()),
                    pa.array([score for _, score in pairs], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return (
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
        .transform(mapped, run, f"id {kind}, lang_pred string, score double")
        .withColumnRenamed("id", id_column)
    )


def predict_held_out(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    folds: int = 4,
    fold: int = 2,
) -> DataFrame:
    """Learns from all documents but those of one fold and predicts all of them.

    The fold of a document is crc32 of its id as text, modulo ``folds``. A document
    without id is in no fold: it is not held out and teaches nothing.
    """
    remainder = crc_of_id(id_column) % folds
    filters = train(docs.where(remainder != fold), text_column, lang_column)
    predicted = identify(docs, filters, id_column, text_column)
    return predicted.select(
        id_column,
        F.coalesce(remainder == fold, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
