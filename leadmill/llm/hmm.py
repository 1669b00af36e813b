"""A hidden Markov language model of word sequences.

Latent states emit symbols: each of the ``symbols`` most frequent words is one, all other
words fall into classes by their last letters. A word of a class has, within it, the share
of its count plus one; one part is left for words never seen. So each text has a proper
probability, computed exactly by the scaled forward recursion over all of its words.

Baum-Welch: in each round every partition runs forward and backward over its training
texts, whole ones, and adds up expected transitions and emissions; Spark sums them and the
driver, which holds only the bounded tables of the model, takes the next estimate. Of texts
too long to hold all forward states only some are kept, and those between computed again on
the way back.

Counts of words come from all training texts. The most frequent ones, ``known`` at most,
are sent to the tasks; all others are joined by word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import crc_of_id, frequent, mapped, stored, word_runs

STATES = 8
SYMBOLS = 16_384
CLASSES = 256
KNOWN = 262_144
ROUNDS = 4
#: Words whose forward states the E-step holds at a time.
HELD = 1 << 19
SMOOTH = 0.1
END = "\n"  # no word holds white space
_FLUSH = 300_000


def class_of(word: str, classes: int = CLASSES) -> int:
    return zlib.crc32(word[-2:].encode("utf-8", "surrogatepass")) % classes


class Codes:
    """Words to symbols: their own number, or that of their class."""

    def __init__(self, words: list[str], classes: int = CLASSES):
        """``words``: those with a symbol of their own, the end mark first."""
        self.classes, self.size = classes, len(words) + classes
        self.own = {word: classes + at for at, word in enumerate(words)}

    def encode(self, words: list[str]) -> np.ndarray:
        get, classes = self.own.get, self.classes
        return np.array(
            [
                code if (code := get(word)) is not None else class_of(word, classes)
                for word in words
            ],
            dtype=np.int64,
        )


    @property
    def kind(self) -> np.dtype:
        """How the symbols of a text are stored."""
        return np.dtype("<u2" if self.size <= 1 << 16 else "<u4")


def _sequences(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of stored texts in a row, and how many each text has."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False) // kind.itemsize
    row = np.frombuffer(b"".join(column.to_pylist()), kind)
    return row.astype(np.int64), lengths.astype(np.int64)


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        #: ``move[from, to]`` and ``emit[symbol, state]``.
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, counts: np.ndarray, states: int) -> Model:
        """A start for training: unigram emissions, each state shaken in its own way."""
        random = np.random.default_rng(7)
        shares = (counts + SMOOTH) / (counts + SMOOTH).sum()
        emit = shares[:, None] * random.uniform(0.2, 1.8, (len(counts), states))
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @property
    def parts(self) -> tuple:
        return self.start, self.move, self.emit

    def expect(self, row: np.ndarray, lengths: np.ndarray) -> Expected:
        """One E-step over whole texts, many of about the same length at a time."""
        total = Expected.zero(*self.emit.shape)
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
        before = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(order):
            stop = int(np.searchsorted(before, before[at] + HELD, "right")) - 1
            stop = max(stop, at + 1)
            self._expect(row, starts[at:stop], sizes[at:stop], total)
            at = stop
        return total

    def _forward(self, symbols, live, here) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward states of some steps, and emissions divided by their scales.

        Rows are the words of one step after the other, ``live`` of them in each step;
        ``here`` holds the states of the step before, None before the first word.
        """
        emitted = self.emit[symbols]
        ahead, scales = np.empty_like(emitted), np.empty(len(symbols))
        at = 0
        for n in live:
            words = slice(at, at + n)
            prior = self.start if here is None else here[:n] @ self.move
            here = np.multiply(prior, emitted[words], out=ahead[words])
            scale = here.sum(axis=1, out=scales[words])
            here /= scale[:, None]
            at += n
        emitted /= scales[:, None]
        return ahead, emitted

    def _expect(self, row, starts, sizes, total: Expected) -> None:
        """Adds what is expected of texts, given from the longest to the shortest."""
        steps = int(sizes[0])
        live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), "right")
        # Stretches of steps with as many words as are held; each keeps where it begins.
        marks = np.flatnonzero(np.diff((np.cumsum(live) - 1) // HELD, prepend=-1))
        bounds = [*marks.tolist(), steps]

        def words(part: int) -> tuple[np.ndarray, list[int]]:
            counts = live[bounds[part] : bounds[part + 1]]
            step = np.repeat(np.arange(bounds[part], bounds[part + 1]), counts)
            text = np.arange(len(step)) - np.repeat(np.cumsum(counts) - counts, counts)
            return row[starts[text] + step], counts.tolist()

        entries: list[np.ndarray | None] = [None]
        for part in range(len(bounds) - 1):
            symbols, counts = words(part)
            ahead, emitted = self._forward(symbols, counts, entries[-1])
            entries.append(ahead[len(ahead) - counts[-1] :].copy())
        back = np.ones((len(sizes), len(self.start)))
        moves = np.zeros_like(self.move)
        for part in range(len(bounds) - 2, -1, -1):
            if part < len(bounds) - 2:
                symbols, counts = words(part)
                ahead, emitted = self._forward(symbols, counts, entries[part])
            at = len(symbols)
            for step in range(len(counts) - 1, -1, -1):
                n, at = counts[step], at - counts[step]
                here = slice(at, at + n)
                if step or part:
                    prior = ahead[at - counts[step - 1] : at] if step else entries[part]
                    following = emitted[here]
                    following *= back[:n]
                    ahead[here] *= back[:n]
                    moves += prior[:n].T @ following
                    np.matmul(following, self.move.T, out=back[:n])
                else:
                    ahead[here] *= back[:n]
                    total.start += ahead[here].sum(axis=0)
            # What was ahead is now the share of each state in each word.
            for state in range(len(self.start)):
                total.emit[:, state] += np.bincount(symbols, ahead[:, state], len(self.emit))
        total.move += moves * self.move

    def log10(self, row: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The log10 probability of each text's symbols: the scaled forward recursion."""
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        size = lengths[order]
        out = np.zeros(len(size))
        here = np.tile(self.start, (len(size), 1))
        shorter = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0])), "right")
        for t in range(int(size[0])):
            n = int(shorter[t])
            if t:
                here = here[:n] @ self.move
            here = here[:n] * self.emit[row[starts[:n] + t]]
            sums = here.sum(axis=1)
            here /= sums[:, None]
            out[:n] += np.log10(sums)
        result = np.empty(len(out))
        result[order] = out
        return result


class Expected:
    """Expected counts of one E-step."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def zero(cls, symbols: int, states: int) -> Expected:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))

    def add(self, other: Expected) -> None:
        self.start += other.start
        self.move += other.move
        self.emit += other.emit

    def table(self) -> pa.RecordBatch:
        """Rows by kind: -1 start, -2 and below the transitions, symbols from 0."""
        states = len(self.start)
        rows = np.vstack([self.start, self.move, self.emit])
        keys = np.concatenate([-1 - np.arange(1 + states), np.arange(len(self.emit))])
        some = np.flatnonzero(rows.any(axis=1))
        columns = {f"c{k}": pa.array(rows[some, k]) for k in range(states)}
        return pa.RecordBatch.from_pydict({"key": pa.array(keys[some]), **columns})

    @classmethod
    def of_table(cls, frame, symbols: int, states: int) -> Expected:
        total = cls.zero(symbols, states)
        keys = frame["key"].to_numpy()
        values = frame[[f"c{k}" for k in range(states)]].to_numpy()
        rows = np.vstack([total.start, total.move, total.emit])
        rows[np.where(keys < 0, -1 - keys, keys + 1 + states)] = values
        return cls(rows[0], rows[1 : 1 + states], rows[1 + states :])

    def model(self, shares: np.ndarray) -> Model:
        """The next estimate; every state keeps a little of the unigram shares."""

        def even(counts):
            return (counts + SMOOTH) / (counts + SMOOTH).sum(axis=-1, keepdims=True)

        weight = max(1.0, 1e-3 * self.emit.sum() / self.emit.shape[1])
        emit = self.emit + weight * shares[:, None]
        return Model(even(self.start), even(self.move), emit / emit.sum(axis=0))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n``, added up as far as memory allows; the end mark once a text."""
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pydict(
            {"word": list(held), "n": pa.array(held.values(), pa.int64())},
            schema=pa.schema([("word", pa.string()), ("n", pa.int64())]),
        )
        held.clear()
        return rows

    for batch in batches:
        held[END] += batch.num_rows
        for words, places, _ in word_runs(pc.ascii_lower(batch.column(0))):
            counts = np.bincount(places, minlength=len(words)).tolist()
            for word, count in zip(words, counts, strict=True):
                held[word] = held.get(word, 0) + count
            if len(held) > _FLUSH:
                yield flush()
    if held:
        yield flush()


def score_texts(
    docs: DataFrame,
    training,
    id_column: str = "doc_id",
    text_column: str = "text",
    states: int = STATES,
    symbols: int = SYMBOLS,
    known: int = KNOWN,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Scores of every row by a model of the rows where the column ``training`` is true.

    Returns ``<id>, n_tokens, n_known, train_tokens, base_score, score``: tokens with the
    end of the text, those with a count in training, all training tokens, the log10
    probability by single word counts plus one, and that by the model. A-Z are lowered;
    words are what stands between ASCII white space. Null and empty texts are the end
    alone. Repeated rows get equal scores. Without training texts all scores are those
    of a uniform model over the classes of words never seen.
    """
    spark = docs.sparkSession
    spread = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("t"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    counts = stored(
        spread.where("training")
        .select("t")
        .transform(mapped, _count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    whole = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    vocabulary, tokens = whole["v"], whole["n"] or 0
    # At most ``known`` rows reach the driver and the tasks.
    common = frequent(counts, "n", known).toPandas().sort_values(
        ["n", "word"], ascending=[False, True], kind="stable"
    )
    listed = dict(zip(common["word"], common["n"].tolist(), strict=True))
    own = [END, *[w for w in list(listed)[: symbols + 1] if w != END][:symbols]]
    codes = Codes(own)
    numbers = np.zeros(codes.size)
    numbers[codes.classes :] = [listed.get(word, 0) for word in own]

    # Words and tokens of each class, all words counted: a bounded table.
    class_column = _class_column(codes.classes)
    special = spark.createDataFrame([(word,) for word in own], "word string")
    of_class = (
        counts.join(F.broadcast(special), "word", "left_anti")
        .select(class_column.alias("class"), "n")
        .groupBy("class")
        .agg(F.count("*").alias("v"), F.sum("n").alias("n"))
        .collect()
    )
    class_words, class_tokens = np.zeros(codes.classes), np.zeros(codes.classes)
    for row in of_class:
        class_words[row["class"]], class_tokens[row["class"]] = row["v"], row["n"]
    numbers[: codes.classes] = class_tokens
    # Within a class: each word's count plus one, and one for words never seen.
    class_base = class_tokens + class_words + 1

    floor = np.log10(tokens + vocabulary + 1.0)
    sent = spark.sparkContext.broadcast((own, listed, class_base))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_words, seen, bases = sent.value
        table = Codes(own_words)
        end_seen = seen.get(END, 0)
        for batch in batches:
            at = 0
            for words, places, held in word_runs(pc.ascii_lower(batch.column("t"))):
                codes_here = table.encode(words)
                found = np.array([seen.get(w, 0) for w in words], np.int64)
                lengths = held + 1
                row = np.full(lengths.sum(), table.own[END], dtype=table.kind)
                inner = np.ones(len(row), dtype=bool)
                inner[np.cumsum(lengths) - 1] = False
                row[inner] = codes_here[places]
                # What a word adds to the base score, and to the model's within its class.
                plus = np.log10(found + 1.0)
                inside = np.where(
                    codes_here < table.classes,
                    plus - np.log10(bases[codes_here % table.classes]),
                    0.0,
                )
                known, base, within = (
                    _sums(values[places], held) for values in (found > 0, plus, inside)
                )
                ends = np.cumsum(lengths) * table.kind.itemsize
                data = row.tobytes()
                cuts = zip((ends - lengths * table.kind.itemsize).tolist(), ends.tolist(), strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id").slice(at, len(held)),
                        "training": batch.column("training").slice(at, len(held)),
                        "symbols": pa.array([data[x:y] for x, y in cuts], pa.binary()),
                        "n_tokens": pa.array(lengths),
                        "n_known": pa.array(known.astype(np.int64) + (end_seen > 0)),
                        "base": pa.array(base + np.log10(end_seen + 1.0) - lengths * floor),
                        "within": pa.array(within),
                        "rare": _rare(words, places, held, found),
                    }
                )
                at += len(held)

    kind = spread.schema["id"].dataType.simpleString()
    texts = stored(
        spread.transform(
            mapped,
            encode,
            f"id {kind}, training boolean, symbols binary, n_tokens long, n_known long, "
            "base double, within double, rare map<string,int>",
        ).withColumn("row", F.monotonically_increasing_id())
    )

    model = Model.first(numbers, states)
    shares = (numbers + SMOOTH) / (numbers + SMOOTH).sum()
    names = ", ".join(f"c{k} double" for k in range(states))
    size, stored_as = codes.size, codes.kind.str
    for _ in range(rounds if tokens else 0):
        now = spark.sparkContext.broadcast(model.parts)

        def expect(batches, now=now):
            current, total = Model(*now.value), Expected.zero(size, states)
            for batch in batches:
                if batch.num_rows:
                    row, lengths = _sequences(batch.column(0), np.dtype(stored_as))
                    total.add(current.expect(row, lengths))
            yield total.table()

        summed = (
            texts.where("training")
            .select("symbols")
            .transform(mapped, expect, f"key long, {names}")
            .groupBy("key")
            .agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(states)])
        )
        model = Expected.of_table(summed.toPandas(), size, states).model(shares)

    last = spark.sparkContext.broadcast(model.parts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = Model(*last.value)
        for batch in batches:
            if batch.num_rows:
                row, lengths = _sequences(batch.column(1), np.dtype(stored_as))
                found = current.log10(row, lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found)], names=["row", "model"]
                )

    scored = texts.select("row", "symbols").transform(mapped, score, "row long, model double")
    # A word's own count replaces the zero that stood for it in both scores.
    opened = texts.select("row", F.explode("rare").alias("word", "times"))
    late = (
        opened.join(counts, "word")
        .select("row", "times", (F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
        .groupBy("row")
        .agg(F.sum("times").alias("times"), F.sum("more").alias("more"))
    )
    more = F.coalesce("more", F.lit(0.0))
    return (
        texts.drop("symbols", "rare")
        .join(scored, "row")
        .join(late, "row", "left")
        .select(
            F.col("id").alias(id_column),
            "n_tokens",
            (F.col("n_known") + F.coalesce("times", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") + more).alias("base_score"),
            (F.col("model") + F.col("within") + more).alias("score"),
        )
    )


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each text's values, by themselves, so equal texts have equal sums."""
    result = np.zeros(len(lengths))
    some = lengths > 0
    if some.any():
        starts = (np.cumsum(lengths) - lengths)[some]
        result[some] = np.add.reduceat(values.astype(np.float64), starts)
    return result


def _rare(words: list[str], places, held, found) -> pa.Array:
    """For each text the words whose count is not at hand, with how often they occur."""
    open_places = np.flatnonzero(found[places] == 0) if len(places) else places
    texts = np.repeat(np.arange(len(held)), held)[open_places]
    width = max(1, len(words))
    pairs, many = np.unique(texts * width + places[open_places], return_counts=True)
    each = np.bincount(pairs // width, minlength=len(held))
    offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
    names = pa.array(words, pa.string()).take(pa.array(pairs % width))
    return pa.MapArray.from_arrays(
        pa.array(offsets), names, pa.array(many.astype(np.int32))
    )


def _class_column(classes: int):
    """``class_of`` as a column expression."""
    last = F.expr("right(word, 2)").cast("binary")
    return (F.crc32(last) % classes).cast("int")


def score_held_out(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 7,
    fold: int = 2,
) -> DataFrame:
    """``score_texts`` learned from all documents but one fold of crc32(id as text).

    A document without id is in no fold: it is not held out and not learned from.
    """
    remainder = crc_of_id(id_column) % folds
    narrow = docs.select(id_column, text_column)
    scored = score_texts(narrow, remainder != fold, id_column, text_column)
    return scored.withColumn("held_out", F.coalesce(remainder == fold, F.lit(False)))
