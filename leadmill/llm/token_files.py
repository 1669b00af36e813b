"""Token ids in bit-packed files with random access.

A file holds the ids of consecutive documents:

    magic, bits of an id, ids of a block                       header
    blocks of ids, each id in the fewest bits for the vocabulary
    offsets of the blocks; ids, null marks and first positions of the documents
    counts and place of that index, magic                      footer

Every block but the last holds the same number of ids, a multiple of eight, so it starts
at a whole byte and any range of ids is read by unpacking only the blocks it touches.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from leadmill.llm.shared import coded_runs, mapped, scratch, stored

MAGIC = b"LMTOKB01"
BLOCK_IDS = 32_768
END_ID = 2
#: Words a worker remembers; when these are too many, those used most stay.
CACHE_WORDS = 500_000
_HEADER = struct.Struct("<8sII")
_FOOTER = struct.Struct("<QQQQ8s")
# How word tokenizers with end marks cut texts, and chunks that are surely
# one run of letters and one of signs under that rule.
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIMPLE = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<signs>[!-&(-/:;=-@\[-`{}~]*)\z"
#: Words looked up at a time (a batch of ``mapped``), words whose ids are put in a row at a
#: time, and words that are encoded at a time.
RUN_WORDS = 1_500_000
GATHERED = 100_000
LEARNED = 16_384
_ENCODERS: dict = {}


def bits_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits, one after the other, lowest bits first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    if bits % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    all_bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(all_bits[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = raw[: count * bits // 8].reshape(count, -1)
    else:
        flat = np.unpackbits(raw, count=count * bits, bitorder="little")
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :bits] = flat.reshape(count, bits)
        out = np.packbits(wide, axis=1, bitorder="little")
    return out.view("<u4").ravel()


class Writer:
    """Writes one file; holds one block of ids and the index."""

    def __init__(self, stream, bits: int, block_ids: int = BLOCK_IDS):
        if block_ids % 8:
            raise ValueError("blocks must hold a multiple of eight ids")
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.offsets = [_HEADER.size]
        self.names: list[int | None] = []
        self.starts = [0]
        self.held: list[np.ndarray] = []
        self.waiting = 0
        stream.write(_HEADER.pack(MAGIC, bits, block_ids))

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        stop = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for at in range(0, stop, self.block_ids):
            data = pack(ids[at : min(at + self.block_ids, stop)], self.bits)
            self.stream.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.waiting = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(True)
        nulls = np.array([name is None for name in self.names], np.uint8)
        names = np.array([name or 0 for name in self.names], "<i8")
        self.stream.write(np.array(self.offsets, "<u8").tobytes())
        self.stream.write(names.tobytes())
        self.stream.write(nulls.tobytes())
        self.stream.write(np.array(self.starts, "<u8").tobytes())
        self.stream.write(
            _FOOTER.pack(
                len(self.offsets) - 1,
                len(self.names),
                self.starts[-1],
                self.offsets[-1],
                MAGIC,
            )
        )


class Reader:
    """Random access to a file's documents and ids."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        header = stream.read_at(_HEADER.size, 0)
        magic, self.bits, self.block_ids = _HEADER.unpack(header)
        footer = stream.read_at(_FOOTER.size, size - _FOOTER.size)
        blocks, docs, self.n_ids, at, end = _FOOTER.unpack(footer)
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a token file, or cut off")
        index = stream.read_at(size - _FOOTER.size - at, at)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1)
        place = 8 * (blocks + 1)
        names = np.frombuffer(index, "<i8", docs, place)
        nulls = np.frombuffer(index, np.uint8, docs, place + 8 * docs)
        self.starts = np.frombuffer(index[place + 9 * docs :], "<u8", docs + 1)
        self.names = [
            None if null else int(name) for name, null in zip(names, nulls, strict=True)
        ]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at positions start to stop of the file."""
        if start >= stop:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        begin, end = int(self.offsets[first]), int(self.offsets[last])
        data = self.stream.read_at(end - begin, begin)
        shift = first * self.block_ids
        count = min(last * self.block_ids, self.n_ids) - shift
        return unpack(data, count, self.bits)[start - shift : stop - shift]

    def document(self, at: int) -> np.ndarray:
        return self.ids(int(self.starts[at]), int(self.starts[at + 1]))


class TextEncoder:
    """Encodes whole texts, for any tokenizer."""

    def __init__(self, tokenizer, end_id: int | None):
        self.tokenizer = tokenizer
        self.end = [] if end_id is None else [end_id]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        whole = [text or "" for text in texts.to_pylist()]
        for found in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False):
            yield np.array(found.ids + self.end, np.uint32)


class WordEncoder:
    """Encodes texts by their words, each only once as long as it is remembered.

    For tokenizers that ``splits_at_blanks`` accepts: a text's ids are those of its
    chunks between white space. A chunk of letters with signs after it is two words, the
    letters in lower case; Arrow cuts the different chunks of a run, so that only
    different words are looked up. New words are encoded together and told apart by
    the ids that end a word. Other chunks are words of their own, encoded one by one.
    """

    def __init__(self, tokenizer, end_id: int | None, most: int = CACHE_WORDS):
        self.tokenizer, self.most = tokenizer, most
        self.end = [] if end_id is None else [end_id]
        # The same tokenizer for words that are cut out and lower-cased already.
        self.plain = Tokenizer.from_str(tokenizer.to_str())
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        suffix = tokenizer.model.end_of_word_suffix
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[n for piece, n in vocabulary.items() if piece.endswith(suffix)]] = True
        self._start()

    def _start(self) -> None:
        #: The ids of all known words in a row, where each word's begin and how many they
        #: are, and how often it was used. The empty word is the first.
        self.pool = np.empty(0, np.uint32)
        self.begins = self.sizes = self.uses = np.zeros(1, np.int64)
        self.words: dict[str, int] = {"": 0}

    def _gather(self, words: np.ndarray) -> np.ndarray:
        """The ids of words, one after the other."""
        sizes = self.sizes[words]
        shifts = np.repeat(self.begins[words] - (np.cumsum(sizes) - sizes), sizes)
        return self.pool[shifts + np.arange(len(shifts))]

    def _forget(self) -> None:
        """Keeps the words that were used most, at most half of what is allowed."""
        places = np.argsort(-self.uses, kind="stable")[: self.most // 2]
        keep = np.zeros(len(self.uses), dtype=bool)
        keep[places] = self.uses[places] > 1
        keep[0] = True
        kept = np.flatnonzero(keep)
        names = [word for word, stays in zip(self.words, keep.tolist(), strict=True) if stays]
        ids, sizes = self._gather(kept), self.sizes[kept]
        self.pool, self.sizes, self.begins = ids, sizes, np.cumsum(sizes) - sizes
        self.uses = self.uses[kept] // 2
        self.words = {word: at for at, word in enumerate(names)}

    def _add(self, words: list[str], ids: list[int], sizes: np.ndarray) -> None:
        """Puts new words behind those that are known."""
        first = len(self.sizes)
        ends = len(self.pool) + np.cumsum(sizes)
        self.pool = np.concatenate([self.pool, np.array(ids, np.uint32)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.begins = np.concatenate([self.begins, ends - sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])
        self.words.update(zip(words, range(first, first + len(words)), strict=True))

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), LEARNED):
            part = words[at : at + LEARNED]
            text = " ".join(part)
            joined = self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids
            stops = np.flatnonzero(self.ends[joined]) + 1
            if len(stops) != len(part):
                raise ValueError("words cannot be told apart by their last ids")
            self._add(part, joined, np.diff(stops, prepend=0))

    def _learn_odd(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), LEARNED):
            part = chunks[at : at + LEARNED]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            ids = [e.ids for e in encoded]
            sizes = np.array([len(own) for own in ids], np.int64)
            self._add(part, list(chain.from_iterable(ids)), sizes)

    def _known(self, words: list[str]) -> np.ndarray:
        """The place of each word, -1 for unknown ones."""
        found = map(self.words.get, words, repeat(-1))
        return np.fromiter(found, np.int64, len(words))

    def _places(self, chunks: pa.Array, times: np.ndarray) -> np.ndarray:
        """The places of the two words of each of these different chunks, the second one
        maybe empty; unknown words are learned. ``times``: how often each is used."""
        cut = pc.extract_regex(chunks, _SIMPLE)
        simple = cut.is_valid()
        letters, signs = pc.struct_field(cut, "word"), pc.struct_field(cut, "signs")
        # Chunks that are cut otherwise never look like letters or signs only.
        whole = pc.if_else(simple, pc.utf8_lower(letters), chunks)
        parts = pa.concat_arrays([whole, pc.fill_null(signs, "")]).dictionary_encode()
        different, codes = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        places = self._known(different)
        if len(self.words) + int((places < 0).sum()) > self.most:
            self._forget()
            places = self._known(different)
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            is_odd = np.zeros(len(different), dtype=bool)
            odd_chunks = np.flatnonzero(~simple.to_numpy(zero_copy_only=False))
            is_odd[codes[odd_chunks]] = True
            self._learn([different[at] for at in fresh[~is_odd[fresh]].tolist()])
            self._learn_odd([different[at] for at in fresh[is_odd[fresh]].tolist()])
            places[fresh] = self._known([different[at] for at in fresh.tolist()])
        used = np.bincount(codes, np.concatenate([times, times]), len(different))
        self.uses[places] += used.astype(np.int64)
        return places[codes].reshape(2, -1).T

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        end = np.array(self.end, np.uint32)
        # One run a batch, so that each of its different chunks is looked up once.
        for chunks, uses, counts in coded_runs(texts, RUN_WORDS):
            pairs = self._places(chunks, np.bincount(uses, minlength=len(chunks)))
            stops = np.cumsum(counts)
            first = 0
            while first < len(counts):  # some documents at a time, at least one
                begin = int(stops[first] - counts[first])
                last = max(first + 1, int(np.searchsorted(stops, begin + GATHERED, "right")))
                own = pairs[uses[begin : stops[last - 1]]]
                yield from self._documents(own, counts[first:last], end)
                first = last
            pa.default_memory_pool().release_unused()

    def _documents(
        self, pairs: np.ndarray, counts: np.ndarray, end: np.ndarray
    ) -> Iterator[np.ndarray]:
        """The ids of documents from the places of the words of their chunks."""
        ids = self._gather(pairs.ravel())
        stops = np.cumsum(np.concatenate([[0], self.sizes[pairs].sum(axis=1)]))
        docs = np.cumsum(np.concatenate([[0], counts]))
        for start, stop in zip(docs[:-1], docs[1:], strict=True):
            yield np.concatenate([ids[stops[start] : stops[stop]], end])


def splits_at_blanks(description: str) -> bool:
    """Whether a tokenizer's words end with a mark, never reach across white space, and
    are runs of letters or of other signs."""
    parts = json.loads(description)
    kinds = [step.get("type") for step in (parts.get("normalizer") or {}).get("normalizers", [])]
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0]
    return (
        bool(parts["model"].get("end_of_word_suffix"))
        and kinds == ["NFC", "Replace", "Lowercase"]
        and split.get("pattern") == {"Regex": _WORD_RULE}
        and split.get("behavior") == "Removed"
        and split.get("invert") is True
    )


def encoder(description: str, end_id: int | None):
    """What encodes texts fastest with a tokenizer given by its description.

    A worker that runs several tasks goes on with the words it knows.
    """
    key = (zlib.crc32(description.encode()), len(description), end_id)
    if key not in _ENCODERS:
        tokenizer = Tokenizer.from_str(description)
        kind = WordEncoder if splits_at_blanks(description) else TextEncoder
        _ENCODERS.clear()
        _ENCODERS[key] = kind(tokenizer, end_id)
    return _ENCODERS[key]


def write_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int | None = END_ID,
    partitions: int | None = None,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encodes all texts and writes them in ascending id order, one file a partition.

    Returns ``part, path, n_docs, n_ids``, one row for each file. Null and empty texts
    have the end id only. Rows without id come first; rows with equal ids go by text.
    The folder must be one that all executors share. A repeated task writes the same
    file under a name of its own and then moves it into place.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as source:
        description = source.read()
    bits = bits_of(Tokenizer.from_str(description).get_vocab_size())
    shared = spark.sparkContext.broadcast(description)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        path = f"part-{part:06d}.tok"
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encode = encoder(shared.value, end_id)
                stream = files.open_output_stream(f"{root}/.{path}.{attempt}")
                writer = Writer(stream, bits, block_ids)
            ids = encode(batch.column(1))
            for name, row in zip(batch.column(0).to_pylist(), ids, strict=True):
                writer.add(name, row)
        if writer is not None:
            writer.close()
            stream.close()
            files.move(f"{root}/.{path}.{attempt}", f"{root}/{path}")
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int64()),
                    "path": [path],
                    "n_docs": pa.array([len(writer.names)], pa.int64()),
                    "n_ids": pa.array([writer.starts[-1]], pa.int64()),
                }
            )

    order = [F.col("name"), F.xxhash64("t")]
    return (
        docs.select(
            F.col(id_column).cast("long").alias("name"), F.col(text_column).alias("t")
        )
        .repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .transform(mapped, run, "part long, path string, n_docs long, n_ids long")
    )


def read_documents(
    spark: SparkSession, folder: str, manifest: DataFrame, id_column: str = "doc_id"
) -> DataFrame:
    """``<id>, start, n_tokens, ids_crc32`` of every document in the files.

    ``start``: ids of all documents before it. The checksum is that of its ids as
    little-endian unsigned 32-bit integers.
    """
    # One row a file; the ids before each file are those of the files before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn(
        "first", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))
    ).select("path", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with place.open_input_file(f"{root}/{path}") as stream:
                    yield from _digest(Reader(stream), first)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        files.repartition(partitions)
        .transform(mapped, run, "name long, start long, n_tokens long, ids_crc32 long")
        .withColumnRenamed("name", id_column)
    )


def _digest(reader: Reader, first: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Documents in runs of at most ``most`` ids; longer ones piece by piece."""
    starts = reader.starts.astype(np.int64)
    at, total = 0, len(reader.names)
    while at < total:
        end = int(np.searchsorted(starts, starts[at] + most, "right")) - 1
        end = min(max(end, at + 1), total)
        sums = []
        if starts[end] - starts[at] <= most:
            ids = reader.ids(int(starts[at]), int(starts[end]))
            for doc in range(at, end):
                own = ids[starts[doc] - starts[at] : starts[doc + 1] - starts[at]]
                sums.append(zlib.crc32(own.tobytes()))
        else:
            crc = 0
            for piece in range(int(starts[at]), int(starts[end]), most):
                ids = reader.ids(piece, min(piece + most, int(starts[end])))
                crc = zlib.crc32(ids.tobytes(), crc)
            sums.append(crc)
        yield pa.RecordBatch.from_pydict(
            {
                "name": pa.array(reader.names[at:end], pa.int64()),
                "start": pa.array(first + starts[at:end]),
                "n_tokens": pa.array(np.diff(starts[at : end + 1])),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
        )
        at = end


def tokenized(
    docs: DataFrame,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int | None = END_ID,
) -> DataFrame:
    """Writes token files to the shared folder and returns what reading them gives."""
    spark = docs.sparkSession
    folder = scratch(spark)
    manifest = stored(
        write_files(docs, folder, tokenizer_file, id_column, text_column, end_id)
    )
    return read_documents(spark, folder, manifest, id_column)
