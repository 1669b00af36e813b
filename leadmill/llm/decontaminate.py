"""Benchmark passages in documents, found by a generalised suffix automaton.

The automaton of a block of items accepts every word sequence inside one item. Document
words are streamed through it; the state gives the longest match that ends at each
word. A match of at least ``window`` words holds a window, and an item shorter than a
window must match as a whole. Words that occur in no item reset the match, so only runs
of known words are walked.

Items are dealt into blocks of bounded size, one pass over the documents for each, so
the automaton a task holds does not grow with the benchmark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.llm.shared import LOWER_ASCII, fresh_name, mapped, stored

WINDOW = 10
#: Words of one automaton; longer items are cut into overlapping pieces.
BLOCK_WORDS = 200_000
# A fixed value: what counts as a word.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER_ASCII)) if text else []


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, list[str], bool]], window: int = WINDOW):
        """``items``: id, words, whether they are a whole item."""
        self.window = window
        self.numbers: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[tuple[int, str]] = []  # (state, item) for windows
        wholes: list[tuple[int, int, str]] = []  # (state, length, short item)
        for name, words, whole in items:
            last = 0
            for at, word in enumerate(words):
                number = self.numbers.setdefault(word, len(self.numbers))
                last = self._extend(last, number)
                if at + 1 >= window:
                    ends.append((last, name))
            if whole and 0 < len(words) < window:
                wholes.append((last, len(words), name))
        # Items of each state that stands for sequences of exactly ``window`` words,
        # and the lengths and items of short items that end in a state.
        self.items: dict[int, set[str]] = {}
        for state, name in ends:
            self.items.setdefault(self._holder(state, window), set()).add(name)
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state, length, name in wholes:
            held = self._holder(state, length)
            self.short.setdefault(held, []).append((length, name))
        self.least = min(
            [window] * bool(ends) + [length for _, length, _ in wholes], default=None
        )
        # The nearest state on each state's suffix path at which a short item ends.
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.size.__getitem__):
            if state in self.short:
                self.nearest[state] = state
            elif state:
                self.nearest[state] = self.nearest[self.link[state]]

    def _add(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(moves)
        return len(self.next) - 1

    def _split(self, state: int, number: int, target: int) -> int:
        """The part of ``target`` that holds the sequences one longer than ``state``."""
        copy = self._add(self.size[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state != -1 and self.next[state].get(number) == target:
            self.next[state][number] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, number: int) -> int:
        known = self.next[last].get(number)
        if known is not None:
            if self.size[known] == self.size[last] + 1:
                return known
            return self._split(last, number, known)
        new = self._add(self.size[last] + 1, 0, {})
        state = last
        while state != -1 and number not in self.next[state]:
            self.next[state][number] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][number]
            if self.size[target] != self.size[state] + 1:
                target = self._split(state, number, target)
            self.link[new] = target
        return new

    def _holder(self, state: int, length: int) -> int:
        """The state on the suffix path that holds the sequence of that length."""
        while self.size[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans (start, end) of matching words, and the items they belong to."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if self.least is None or len(words) < self.least:
            return spans, found
        numbers = np.fromiter(
            map(self.numbers.get, words, (-1 for _ in words)), np.int64, len(words)
        )
        known = np.flatnonzero(
            np.diff(np.concatenate([[False], numbers >= 0, [False]]).astype(np.int8))
        )
        moves, link, size, window = self.next, self.link, self.size, self.window
        for start, end in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if end - start < self.least:
                continue
            state = length = 0
            for at in range(start, end):
                number = int(numbers[at])
                while state and number not in moves[state]:
                    state = link[state]
                    length = size[state]
                if number in moves[state]:
                    state = moves[state][number]
                    length += 1
                first = None
                if length >= window:
                    holder = state
                    while size[link[holder]] >= window:
                        holder = link[holder]
                    found |= self.items.get(holder, set())
                    first = at + 1 - window
                holder = self.nearest[state]
                while holder > 0:
                    for short, name in self.short[holder]:
                        if short <= length:
                            found.add(name)
                            begin = at + 1 - short
                            first = begin if first is None else min(first, begin)
                    holder = self.nearest[link[holder]]
                if first is not None:
                    if spans and first <= spans[-1][1]:
                        merged = min(first, spans[-1][0])
                        spans[-1] = (merged, at + 1)
                        while len(spans) > 1 and spans[-1][0] <= spans[-2][1]:
                            top = spans.pop()
                            spans[-1] = (min(top[0], spans[-1][0]), top[1])
                    else:
                        spans.append((first, at + 1))
        return spans, found


def _blocks(
    benchmark: DataFrame, id_column: str, text_column: str, block_words: int, window: int
) -> Iterator[list[tuple[str, list[str], bool]]]:
    """Pieces of items, in blocks of bounded size; one block is fetched at a time."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"item": [], "words": [], "whole": [], "n": []}
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                step = block_words - window + 1
                for at in range(0, max(1, len(words) - window + 1), step):
                    part = words[at : at + block_words]
                    if part:
                        out["item"].append(name)
                        out["words"].append(part)
                        out["whole"].append(len(part) == len(words))
                        out["n"].append(len(part))
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [
                        ("item", pa.string()),
                        ("words", pa.list_(pa.string())),
                        ("whole", pa.bool_()),
                        ("n", pa.int64()),
                    ]
                ),
            )

    cut = (
        benchmark.where(F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("string").alias("item"), F.col(text_column))
        .transform(mapped, pieces, "item string, words array<string>, whole boolean, n long")
    )
    total = cut.agg(F.sum("n")).first()[0] or 0
    count = -(-2 * total // block_words) if total > block_words else min(1, total)
    # Dealt by hash: a block holds half of the limit on average.
    for block in range(count):
        mine = F.pmod(F.xxhash64("item", "words"), F.lit(count)) == block
        rows = cut.where(mine).select("item", "words", "whole").toLocalIterator()
        held: list[tuple[str, list[str], bool]] = []
        size = 0
        for row in rows:
            if size and size + len(row["words"]) > block_words:
                yield held
                held, size = [], 0
            held.append((row["item"], row["words"], row["whole"]))
            size += len(row["words"])
        if held:
            yield held


_PASS = (
    "n_words long, starts array<int>, ends array<int>, items array<string>"
)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row: the id, ``n_words``, the merged spans of words that match (``starts``,
    ``ends``, end exclusive) and the sorted ``items``.

    Null and empty texts have no words. Null benchmark texts and items without id or
    words have no windows. Every row gives a row, also repeated ones and those without an
    id. Other columns of the input are not looked at.
    """
    narrow = docs.select(F.col(id_column).alias("doc"), F.col(text_column).alias("t"))
    blocks = _shared(benchmark, item_column, item_text_column, block_words, window)
    if len(blocks) > 1:
        narrow = stored(narrow.withColumn("row", F.monotonically_increasing_id()))
    return _found(narrow, blocks, window).drop("row").withColumnRenamed("doc", id_column)


def _shared(benchmark: DataFrame, *bounds) -> list[Broadcast]:
    """The blocks of the benchmark, broadcast."""
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(block) for block in _blocks(benchmark, *bounds)]


def _found(rows: DataFrame, blocks: list[Broadcast], window: int) -> DataFrame:
    """The columns of ``rows`` but for the text ``t``, and what ``find_passages`` gives.

    With several blocks those columns are the key by which their results are merged; no two
    rows may agree in all of them.
    """
    keys = [name for name in rows.columns if name != "t"]
    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in keys]

    def scan(shared: Broadcast | None, hits_only: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(shared.value if shared else [], window)
            for batch in batches:
                out: list[list] = [[], [], [], []]
                kept = []
                for row, text in enumerate(batch.column("t").to_pylist()):
                    words = words_of(text)
                    spans, found = automaton.matches(words)
                    if hits_only and not spans:
                        continue
                    kept.append(row)
                    out[0].append(len(words))
                    out[1].append([span[0] for span in spans])
                    out[2].append([span[1] for span in spans])
                    out[3].append(sorted(found))
                whole = pa.list_(pa.int32())
                places = pa.array(kept, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(name).take(places) for name in keys),
                        pa.array(out[0], pa.int64()),
                        pa.array(out[1], whole),
                        pa.array(out[2], whole),
                        pa.array(out[3], pa.list_(pa.string())),
                    ],
                    names=[*keys, "n_words", "starts", "ends", "items"],
                )

        return rows.transform(mapped, run, ", ".join([*kinds, _PASS]))

    result = scan(blocks[0] if blocks else None, False)
    if len(blocks) > 1:
        # Several passes name the same row: its spans and items are put together.
        for block in blocks[1:]:
            result = result.unionByName(scan(block, True))
        result = (
            result.groupBy(*keys, "n_words")
            .agg(
                F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(
                    "items"
                ),
            )
            .withColumn("spans", _merged(F.array_sort("spans")))
            .select(
                *keys,
                "n_words",
                F.col("spans.starts").alias("starts"),
                F.col("spans.ends").alias("ends"),
                "items",
            )
        )
    return result


def _merged(spans):
    """Sorted spans with those that touch joined."""
    empty = F.array().cast("array<struct<starts:int,ends:int>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(
                F.struct(
                    last["starts"].alias("starts"),
                    F.greatest(last["ends"], span["ends"]).alias("ends"),
                )
            ),
        )
        touches = (F.size(done) > 0) & (span["starts"] <= F.try_element_at(done, F.lit(-1))["ends"])
        return F.when(touches, joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, add)


def contamination(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The digest of ``find_passages``: hit words, items and their checksum."""
    hits = F.aggregate(
        F.zip_with("ends", "starts", lambda end, start: end - start),
        F.lit(0).cast("long"),
        lambda total, size: total + size,
    )
    return found.select(
        id_column,
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    longest: int = 200,
    coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without matching spans, with the same columns.

    A span is cut out of the text together with what lies between its words. A document
    goes as a whole if one span holds more than ``longest`` words or all spans more than
    the share ``coverage`` of its words. Texts without a match, null and empty ones
    stay as they are. A column ``n_chars`` is counted anew where the text changed. The
    result does not depend on the number of blocks.
    """
    blocks = _shared(benchmark, item_column, item_text_column, block_words, window)
    if not blocks:
        return docs
    names = docs.columns
    if len(blocks) == 1:
        shared = blocks[0]

        def spans_of(batch: pa.RecordBatch, automaton: Automaton):
            for text in batch.column(text_column).to_pylist():
                words = words_of(text)
                yield len(words), automaton.matches(words)[0]

        return docs.transform(
            mapped,
            _cutter(
                names, text_column, longest, coverage,
                lambda: Automaton(shared.value, window), spans_of,
            ),
            docs.schema,
        )
    # All blocks look at the same text; what they find is merged before it is judged.
    key, found_in = fresh_name(docs, "row"), fresh_name(docs, "found")
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()))
    narrow = keyed.select(F.col(key).alias("doc"), F.col(text_column).alias("t"))
    found = (
        _found(narrow, blocks, window)
        .where(F.size("starts") > 0)
        .select(
            F.col("doc").alias(key),
            F.struct("n_words", "starts", "ends").alias(found_in),
        )
    )

    def spans_known(batch: pa.RecordBatch, _):
        for known in batch.column(found_in).to_pylist():
            if known is None:
                yield 0, []
            else:
                yield known["n_words"], list(zip(known["starts"], known["ends"], strict=True))

    return (
        keyed.join(found, key, "left")
        .select(*names, found_in)
        .transform(
            mapped,
            _cutter(names, text_column, longest, coverage, lambda: None, spans_known),
            docs.schema,
        )
    )


def _cutter(names, text_column, longest, coverage, make, spans_of):
    """What judges and cuts batches by the word counts and spans of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        for batch in batches:
            columns = [batch.column(name) for name in names]
            at = names.index(text_column)
            texts, keep = columns[at].to_pylist(), []
            counted = names.index("n_chars") if "n_chars" in names else -1
            counts = columns[counted].to_pylist() if counted >= 0 else []
            for row, (n_words, spans) in enumerate(spans_of(batch, made)):
                sizes = [end - start for start, end in spans]
                keep.append(
                    not sizes
                    or (max(sizes) <= longest and sum(sizes) <= coverage * n_words)
                )
                if sizes and keep[-1]:
                    texts[row] = _without(texts[row], spans)
                    if counts:
                        counts[row] = len(texts[row])
            columns[at] = pa.array(texts, columns[at].type)
            if counts:
                columns[counted] = pa.array(counts, columns[counted].type)
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            yield whole.filter(pa.array(keep, pa.bool_()))

    return run


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    places = [m.span() for m in WORD.finditer(text.translate(LOWER_ASCII))]
    kept, last = [], 0
    for start, end in spans:
        kept.append(text[last : places[start][0]])
        last = places[end - 1][1]
    return "".join([*kept, text[last:]])


def items_checksum(items: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
