"""Spelling variants: words one edit apart, found by a search in a distributed trie.

Each word enters the trie twice, forwards and backwards. An edit leaves the first half of
one of the two as it is, so a search starts behind that half, where few words are left.
The trie is an edge table: a node is the hash of a prefix at which words part or end, an
edge the letters up to the next node. A frontier of states (text, position, node, edits) is
joined with the edges level by level: each edge is read against the text with what is left
of its one edit. States that reach the end of their text at the end of another one, with
the edit spent, are neighbours.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.shared import LOWER_ASCII, mapped, stored

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_FLUSH = 500_000
#: Marks of texts that are words, and words read backwards.
FORTH, BACK = ">", "<"
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Tables of up to so many bytes are sent to all tasks.
BROADCAST_BYTES = 16 << 20


def slipped(low: str, seed: int, every: int = 97) -> str:
    """The lower-cased run, without one letter where ``every`` divides its crc."""
    code = crc32(low.encode(), seed)
    if code % every:
        return low
    at = code % len(low)
    return low[:at] + low[at + 1 :]


def count_runs(texts: Iterator[tuple[str | None, str | None]], every: int) -> Iterator[Counter]:
    """Words of texts with their ids, added up as far as memory allows."""
    held: Counter = Counter()
    for name, text in texts:
        runs = Counter(_RUN.findall(text or ""))
        seed = None if name is None else crc32(f"{name}:".encode())
        for run, count in runs.items():
            low = run.lower() if run.isascii() else run.translate(LOWER_ASCII)
            held[low if seed is None else slipped(low, seed, every)] += count
        if len(held) > _FLUSH:
            yield held
            held = Counter()
    yield held


def vocabulary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_letters: int = 5,
    least_count: int = 3,
    every: int = 97,
) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough.

    Words are runs of Latin letters with A-Z lowered; where ``every`` divides the crc of
    ``<id>:<word>`` one letter is left out. Rows without id keep their words as they are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        for held in count_runs(rows, every):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"],
            )

    return (
        docs.select(
            F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")
        )
        .transform(mapped, count, "word string, n long")
        .where(F.char_length("word") >= least_letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def prefixes(text: str) -> Iterator[tuple[int, int, str | None, bool, bool]]:
    """The prefixes of a marked text in which a search may be, the whole one included.

    Each as depth, hash, next letter, whether some search may start there, and whether the
    one of this text does. It starts behind the half of its letters (forwards rounded down,
    backwards up); texts with one letter less start at the same depth or one before.

    Two prefixes may share a hash. Their node then has the edges of both, so no word is
    lost; what is found beyond is taken out by the last check.
    """
    back = text[0] == BACK
    starts = [1 + (letters + back) // 2 for letters in (len(text) - 2, len(text) - 1)]
    code = 0
    for depth, letter in enumerate(text):
        if depth >= starts[0]:
            yield depth, _signed(code), letter, depth in starts, depth == starts[1]
        code = ((code ^ ord(letter)) * _FACTOR + depth + 1) & _MASK
    yield len(text), _signed(code), None, len(text) in starts, len(text) == starts[1]


_PREFIX_SCHEMA = "id long, depth int, node long, letter string, opens boolean, own boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "depth", "node", "letter", "opens", "own"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    rows = (
        (name, *prefix)
        for batch in batches
        for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for prefix in prefixes(text)
    )
    while held := list(islice(rows, 200_000)):
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


class Small:
    """Joins with a table that may or may not fit into every task's memory.

    Its size is measured once. Beyond ``limit`` bytes, keys that hold a large part of the
    other side are joined by sending just their rows, all others by a shuffle.
    """

    #: A key is hot that holds more than this share of the other side, and more than a few.
    HOT, FEW = 1 / 1000, 1000

    def __init__(self, table: DataFrame, limit: int = BROADCAST_BYTES):
        self.table = stored(table)
        texts = [f.name for f in self.table.schema if f.dataType.simpleString() == "string"]
        width = sum((F.octet_length(name) for name in texts), F.lit(64))
        size = self.table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
        self.fits = size <= limit

    def join(self, rows: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
        """``rows`` joined with the table on columns of the same names; rows with a null
        key match nothing."""
        if self.fits:
            return rows.join(F.broadcast(self.table), keys, how)
        # At most 1 / HOT keys, so their counts can be sent to every task; the table has
        # one row, or one for each letter, for each of them.
        total = rows.count()
        counts = rows.groupBy(*keys).agg(F.count("*").alias("_held"))
        hot = stored(counts.where(F.col("_held") > max(total * self.HOT, self.FEW)).drop("_held"))
        heavy = self.table.join(F.broadcast(hot), keys, "left_semi")
        return (
            rows.join(F.broadcast(hot), keys, "left_semi")
            .join(F.broadcast(heavy), keys, how)
            .unionByName(
                rows.join(F.broadcast(hot), keys, "left_anti").join(self.table, keys, how)
            )
        )


def trie(texts: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, ...]:
    """Edges ``node, label, child, ends, nexts``, ends ``node, near`` and starts ``id, pos,
    node`` of ``id, text``.

    ``nexts`` holds the letters that follow the child. A chain of letters without a branch or the end of a text is one edge, so the levels are
    those of branches, and a very long word takes no more than a short one.
    """
    rows = stored(texts.select("id", "text").transform(mapped, _cut, _PREFIX_SCHEMA))
    nodes = (
        rows.groupBy("node")
        .agg(
            F.min("letter").alias("one"),
            F.max("letter").alias("other"),
            F.bool_or("opens").alias("opens"),
            F.bool_or(F.col("letter").isNull()).alias("ends"),
        )
        .where(F.col("opens") | F.col("ends") | (F.col("one") != F.col("other")))
        .select("node", "ends")
    )
    path = Small(nodes, limit).join(rows.select("id", "depth", "node"), ["node"])
    # One text's own prefixes are ordered, never a node's texts.
    below = Window.partitionBy("id").orderBy("depth")
    steps = path.select(
        "id",
        "node",
        "depth",
        F.lead("node").over(below).alias("child"),
        F.lead("depth").over(below).alias("until"),
        F.lead("ends").over(below).alias("ends"),
    ).where(F.col("child").isNotNull())
    label = F.substring("text", F.col("depth") + 1, F.col("until") - F.col("depth"))
    edges = (
        steps.join(texts, "id")
        .groupBy("node", "child", label.alias("label"))
        .agg(F.first("ends").alias("ends"))
    )
    edges = stored(edges)
    # At most one letter for each of the alphabet.
    nexts = edges.groupBy(F.col("node").alias("child")).agg(
        F.concat_ws("", F.collect_set(F.substring("label", 1, 1))).alias("nexts")
    )
    edges = edges.join(nexts, "child", "left")
    whole = rows.where(F.col("letter").isNull()).select("id", "node")
    ends = whole.join(texts, "id").select("node", F.col("text").alias("near"))
    starts = rows.where("own").select("id", F.col("depth").alias("pos"), "node")
    return edges, ends, starts


def _read(steps: DataFrame) -> DataFrame:
    """States after reading their edge's label, in all ways their edits allow.

    A label may be read as it is, with one letter replaced or with one letter more.
    """
    free = F.col("edits") == 0
    took = F.explode(F.when(free, F.array(F.lit(-1), F.lit(0))).otherwise(F.array(F.lit(0))))
    size = F.char_length("label") + F.col("took")
    piece = F.substring("text", F.col("pos") + 1, size)
    spent = F.when(free, F.levenshtein(piece, F.col("label"), 1)).otherwise(
        F.when(piece == F.col("label"), 0).otherwise(-1)
    )
    return (
        steps.withColumn("took", took)
        .where(F.col("pos") + size <= F.char_length("text"))
        .withColumn("spent", spent)
        .where(F.col("spent") >= 0)
        .select(
            "text",
            (F.col("pos") + size).alias("pos"),
            F.col("child").alias("node"),
            (F.col("edits") + F.col("spent")).alias("edits"),
            "ends",
            "nexts",
        )
        # With the edit spent, the text must end here or go on with a letter that follows.
        .where(
            """edits = 0 OR if(pos = char_length(text), ends,
               instr(nexts, substring(text, pos + 1, 1)) > 0)"""
        )
        .drop("nexts")
    )


def near_words(words: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``word, near``: for each of the different words all words exactly one edit away."""
    both = F.explode(
        F.array(F.concat(F.lit(FORTH), "word"), F.concat(F.lit(BACK), F.reverse("word")))
    )
    texts = stored(
        words.select(both.alias("text")).withColumn("id", F.monotonically_increasing_id())
    )
    edges, ends, starts = trie(texts, limit)
    edges = Small(edges, limit)
    frontier = starts.join(texts, "id").select(
        "text", "pos", "node", F.lit(0).alias("edits")
    )
    found = []
    while True:
        frontier = stored(
            edges.join(frontier, ["node"])
            # With the edit spent only the edge with the next letter can be read.
            .where("edits = 0 OR left(label, 1) = substring(text, pos + 1, 1)")
            .transform(_read)
        )
        if frontier.isEmpty():
            break
        done = F.col("pos") == F.char_length("text")
        found.append(
            frontier.where(done & F.col("ends") & (F.col("edits") == 1)).select("text", "node")
        )
        frontier = frontier.where(~done | (F.col("edits") == 0)).drop("ends")
    if not found:
        return words.select("word", F.col("word").alias("near")).where(F.lit(False))

    def plain(name: str) -> Column:
        letters = F.expr(f"substring({name}, 2)")
        return F.when(F.col(name).startswith(FORTH), letters).otherwise(F.reverse(letters))

    pairs = (
        Small(ends, limit)
        .join(reduce(DataFrame.unionAll, found), ["node"])
        .select(plain("text").alias("word"), plain("near").alias("near"))
        # Texts with equal hashes are taken out here.
        .where(F.levenshtein("word", "near", 1) == 1)
    )
    turned = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))
    return pairs.unionAll(turned).distinct()


def group_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_letters: int = 5,
    least_count: int = 3,
    every: int = 97,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the ``vocabulary``.

    A word's form is the most frequent word one edit away (ties: the smallest by code
    point), if it is at least twice as frequent; else null. Its root is where its forms
    end, or the word itself. Null and empty texts have no words; repeated rows count each
    time; an empty table gives no rows. Other columns are not read.
    """
    words = stored(
        vocabulary(docs, id_column, text_column, least_letters, least_count, every)
    )
    pairs = stored(near_words(words, limit))
    counted = Small(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), limit)
    best = (
        counted.join(pairs, ["near"])
        .groupBy("word")
        .agg(
            F.min(F.struct((-F.col("near_n")).alias("by"), F.col("near"))).alias("best"),
            F.count("*").alias("n_near"),
        )
    )
    likely = -F.col("best.by") >= 2 * F.col("n")
    forms = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(likely, F.col("best.near")).alias("form"),
            F.when(likely, -F.col("best.by")).cast("long").alias("form_n"),
        )
    )
    roots = _roots(forms.where(F.col("form").isNotNull()), limit)
    return (
        forms.join(roots, "word", "left")
        .withColumn("root", F.coalesce("root", "word"))
        .select("word", "form", "root", "n", "n_near", "form_n")
    )


def _roots(forms: DataFrame, limit: int) -> DataFrame:
    """``word, root`` for words that have a form.

    Each round doubles the steps taken. A form is twice as frequent as its word, so no
    way is longer than 63 steps and none comes back.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")))
    for _ in range(6):
        further = Small(roots.select(F.col("word").alias("root"), F.col("root").alias("next")), limit)
        moved = stored(
            further.join(roots, ["root"], "left").select(
                "word", F.coalesce("next", "root").alias("root"), "next"
            )
        )
        roots = moved.select("word", "root")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            break
    return roots
