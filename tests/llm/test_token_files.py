"""Bit packing, files and encoding: exact round trips."""

from __future__ import annotations

import io
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from leadmill.llm import token_files as t

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    "  \n\t ",
    "Hello, World!! don't we're x'S it's",
    "a<|endoftext|>b <|startoftext|>",
    "café CAFÉ café Straße İstanbul ŁÓDŹ ΣΑΣ",
    "x y z\x1cw\x0bv\x0cu",
    "3.14 v2 1st #tag @me {}[]<>~`^ \\ 's ''s",
    "日本語 текст 😀😀 a😀b",
    "=== <b>x</b> a=b `q` {z}",
    "word " * 3000,
]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 24, 31])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    data = t.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (t.unpack(data, len(ids), bits) == ids).all()
    with pytest.raises(ValueError):
        t.pack(np.array([2**bits], np.uint32), bits)


def test_bits():
    assert [t.bits_of(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_random_access():
    random = np.random.default_rng(3)
    docs = [random.integers(0, 5000, n).astype(np.uint32) for n in (0, 5, 64, 1, 700, 3)]
    sink = io.BytesIO()
    writer = t.Writer(sink, 13, block_ids=64)
    for name, ids in zip([4, None, 7, 7, -2, 9], docs, strict=True):
        writer.add(name, ids)
    writer.close()
    reader = t.Reader(pa.BufferReader(sink.getvalue()))
    assert reader.names == [4, None, 7, 7, -2, 9]
    for at in (4, 0, 5, 2):
        assert reader.document(at).tolist() == docs[at].tolist()
    whole = np.concatenate(docs)
    for a, b in [(0, 773), (63, 65), (64, 128), (770, 773), (5, 5)]:
        assert reader.ids(a, b).tolist() == whole[a:b].tolist()
    with pytest.raises(ValueError):
        t.Reader(pa.BufferReader(sink.getvalue()[:-3]))


@pytest.mark.parametrize("most", [8, 500_000])
def test_word_encoder_equals_the_library(most):
    tokenizer = Tokenizer.from_file(FILE)
    encode = t.WordEncoder(tokenizer, 2, most)
    texts = ODD + ODD[::-1]
    for text, ids in zip(texts, encode(pa.array(texts)), strict=True):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == [*want, 2], text


def test_other_tokenizers_encode_whole_texts():
    file = public_tokenizers.path("byte_bpe_50k.json")
    with open(file, encoding="utf-8") as source:
        encode = t.encoder(source.read(), None)
    want = Tokenizer.from_file(file).encode("a  b\n c", add_special_tokens=False).ids
    assert [x.tolist() for x in encode(pa.array(["a  b\n c", None]))] == [want, []]


def _want(rows):
    tokenizer = Tokenizer.from_file(FILE)
    start, out = 0, []
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_written_and_read_back(documents):
    ids = [7, 3, 11, 1, 0, 5, 2, 8, 4, 9, 6]
    rows = sorted(zip(ids, ODD, strict=True))
    found = t.tokenized(documents(ODD, ids), FILE)
    assert sorted(tuple(r) for r in found.collect()) == _want(rows)


def test_repeated_and_missing_ids(documents):
    docs = documents(["b", "b", "c d e", "a"], [4, 4, None, 1])
    got = sorted((tuple(r) for r in t.tokenized(docs, FILE).collect()), key=lambda r: r[1])
    assert got == _want([(None, "c d e"), (1, "a"), (4, "b"), (4, "b")])


def test_empty_table(documents):
    assert t.tokenized(documents([]), FILE).collect() == []


def test_a_document_longer_than_a_read(documents):
    sink = io.BytesIO()
    writer = t.Writer(sink, 16)
    ids = np.random.default_rng(1).integers(0, 60000, 70_001).astype(np.uint32)
    writer.add(1, ids[:1])
    writer.add(2, ids)
    writer.close()
    batches = list(t._digest(t.Reader(pa.BufferReader(sink.getvalue())), 10, most=1000))
    rows = [row for batch in batches for row in batch.to_pylist()]
    assert [(r["start"], r["n_tokens"]) for r in rows] == [(10, 1), (11, 70_001)]
    assert rows[1]["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_ids_are_gathered_some_documents_at_a_time():
    """What a batch holds at once does not grow with its words."""
    encoder = t.WordEncoder(Tokenizer.from_file(FILE), 2)
    texts = pa.array(["one two three, " * 3_000, "", None, "four"] * 60)
    list(encoder(texts.slice(0, 4)))
    tracemalloc.start()
    sums = [zlib.crc32(ids.tobytes()) for ids in encoder(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
    plain = t.TextEncoder(Tokenizer.from_file(FILE), 2)
    assert sums == [zlib.crc32(ids.tobytes()) for ids in plain(texts.slice(0, 4))] * 60


def test_words_are_encoded_once_in_any_case_and_with_any_signs():
    """A worker remembers words, not each way to write them with signs."""

    class Counting:
        def __init__(self, inner):
            self.inner, self.words = inner, 0

        def encode_batch_fast(self, texts, **options):
            self.words += sum(len(text.split(" ")) for text in texts)
            return self.inner.encode_batch_fast(texts, **options)

    letters = "abcdefghij"
    words = [a + b + c for a in letters for b in letters for c in letters]
    forms = [w + s for w in words for s in ("", ",", "!?", "...")]
    forms += [w.title() + s for w in words for s in (".", ":")] + [w.upper() for w in words]
    encoder = t.WordEncoder(Tokenizer.from_file(FILE), 2, most=1_500)
    encoder.plain = counting = Counting(encoder.plain)
    texts = pa.array([" ".join(forms), " ".join(reversed(forms))])
    got = [ids.tolist() for _ in range(3) for ids in encoder(texts)]
    plain = t.TextEncoder(Tokenizer.from_file(FILE), 2)
    assert got == [ids.tolist() for ids in plain(texts)] * 3
    assert counting.words == len(words) + 5


def test_forgotten_words_are_encoded_again():
    tokenizer = Tokenizer.from_file(FILE)
    encoder, plain = t.WordEncoder(tokenizer, 2, most=40), t.TextEncoder(tokenizer, 2)
    random = np.random.default_rng(5)
    signs = list("aBzÀßÿµ×ñÑ.,'!-_0é§") + ["é", "İ", " ", "\x00", "日"]
    for _ in range(30):
        texts = pa.array(
            [
                " ".join("".join(random.choice(signs, 4)) for _ in range(random.integers(0, 30)))
                for _ in range(5)
            ]
        )
        want = [ids.tolist() for ids in plain(texts)]
        assert [ids.tolist() for ids in encoder(texts)] == want
        assert len(encoder.words) == len(encoder.sizes) == len(encoder.uses)
