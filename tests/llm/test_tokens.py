"""Encoders, token files and packing against the libraries themselves."""

import hashlib
import os
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termloom.llm import range_coder
from termloom.llm.cache import PieceCache
from termloom.llm.encoders import BYTE_LEVEL_PIECES, WORD_PIECES, PieceEncoder
from termloom.llm.packing import differencing, pack, windows
from termloom.llm.pieces import MergeEncoder, encode_and_decode
from termloom.llm.token_files import FORMAT, joined_crc32, joined_crc32s, read_token_files, token_digest, write_token_files

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")

SIGNS = [
    *"abstTZ'.,;!-_ \t\n\r\x0b\x1c\x1f\x85\xa0　́éÉİΣ2³中\U0001f600<|>/▁",
    *["'re", "don't", "the", "<|endoftext|>", "   "],
]
TEXT = st.lists(st.sampled_from(SIGNS), max_size=40).map("".join)


def whole(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize(("path", "pieces"), [(BYTES, BYTE_LEVEL_PIECES), (WORDS, WORD_PIECES)])
def test_pieces_encode_as_whole_texts(path, pieces, texts):
    encoder, want = PieceEncoder(path, pieces), whole(path)
    some = [None, "", *texts.values(), "long piece " + "x" * 500, "a b " * 300_000]
    assert [encoder.encode(t) for t in some] == [want(t) for t in some]

    @settings(max_examples=300, deadline=None)
    @given(TEXT)
    def random_texts(text):
        assert encoder.encode(text) == want(text)

    random_texts()


@pytest.mark.parametrize(("path", "pieces"), [(BYTES, BYTE_LEVEL_PIECES), (WORDS, WORD_PIECES)])
def test_texts_encoded_together_are_as_alone(path, pieces, texts):
    encoder, library = PieceEncoder(path, pieces, added_tokens=True), Tokenizer.from_file(path)

    def same(some):
        found = encoder.ids_of_all(pa.array([None if t is None else t.encode() for t in some], pa.binary()))
        want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "u2").tobytes() for t in some]
        assert found == want

    same([])
    same([None, ""])
    same([None, "", " ", "\n", " one", "one ", "one\n", "\none", "one\n\ntwo", "one\u3000\ntwo", "one \ntwo", "one\n two"])
    same([None, "", *texts.values(), "x" * 500, "a b " * 300_000, "\x00", "été,\nÉté 5×5÷ ÿ'é, d'été.)"])
    signs = [*SIGNS, *" \n\n", "word", "Mots", "été", ").", "<|endoftext|>"]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(signs), max_size=20).map("".join), max_size=4))
    def random_texts(some):
        same(some)

    random_texts()


def test_a_chunk_is_looked_up_once_for_all_texts():
    asked = []

    class Counted(PieceCache):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    encoder = PieceEncoder(BYTES, BYTE_LEVEL_PIECES)
    alone = encoder.ids(b"one two three\none two").tobytes()
    encoder.led = Counted(encoder.led.make)
    assert encoder.ids_of_all(pa.array([b"one two three\none two"] * 50, pa.binary())) == [alone] * 50
    assert sorted(asked) == [b"one", b"three", b"two"]


def test_backtracking_encodes_as_the_library(texts):
    encoder = MergeEncoder(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def same(text):
        assert encoder.encode(text) == np.array(library.encode(text), "<u4").tobytes()

    for t in [*texts.values(), "a" * 3000, " " * 500, "ab" * 5000, "the" * 999, "=" * 77, "\x00", "x" * 70]:
        same(t)

    @settings(max_examples=300, deadline=None)
    @given(TEXT)
    def random_texts(text):
        same(text)

    random_texts()


def test_pieces_of_odd_rows(odd, none):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = encode_and_decode(odd, MODEL).collect()
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        decoded = library.decode(ids)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert encode_and_decode(none, MODEL).collect() == []


def test_range_coder_round_trip():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 65_536, n).astype(np.int32) for n in (0, 1, 2, 700, 33, 700)]
    blocks += [np.full(900, 7, np.int32), np.tile(np.arange(50, dtype=np.int32), 30), rng.integers(0, 3, 800).astype(np.int32)]
    codes = range_coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, range_coder.decode(codes, [len(b) for b in blocks]), strict=True))
    assert len(codes[6]) < 60 and len(codes[7]) < 1500  # what repeats costs little
    # a block's code does not depend on its neighbours
    assert range_coder.encode(blocks[3:4]) == codes[3:4]
    assert range_coder.encode([]) == [] and range_coder.decode([], []) == []


def test_range_coder_keeps_its_code():
    """Files that were written before are read, and any number of blocks side by side gives the same code."""
    n = np.arange(3_000)
    blocks = [n * n % k % 65_536 for k in (7, 211, 50_021, 65_536)] + [n // 40, n[:1], n[:0], 65_535 - n]
    codes = range_coder.encode(blocks * 20)
    assert codes == range_coder.encode(blocks) * 20
    assert [(len(c), zlib.crc32(c)) for c in codes[: len(blocks)]] == [
        (44, 1890222341), (464, 1047950108), (6012, 835621172), (6112, 2692672095),
        (260, 2986193503), (8, 1366983497), (8, 1696784233), (4648, 3270755912),
    ]
    decoded = range_coder.decode(codes, [len(b) for b in blocks] * 20)
    assert all(np.array_equal(a, b) for a, b in zip(blocks * 20, decoded, strict=True))


def test_joined_checksums():
    for a, b in [(b"", b""), (b"abc", b""), (b"", b"xyz"), (b"12345", b"abcdefgh" * 1000)]:
        assert joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_joined_checksums_of_many():
    rng = np.random.default_rng(4)
    parts = [rng.bytes(int(n)) for n in [*rng.integers(0, 3_000, 500), 0, 1, 100_000, 0, 0]]
    first = np.unique([0, *rng.integers(1, len(parts), 100), len(parts) - 1])
    sizes = np.array([len(p) for p in parts])
    found = joined_crc32s(np.array([zlib.crc32(p) for p in parts]), sizes, first)
    assert found.tolist() == [zlib.crc32(b"".join(parts[a:b])) for a, b in zip(first, [*first[1:], len(parts)], strict=True)]
    # parts of any size: as two at a time
    crcs, sizes = np.array([5, 7, 9]), np.array([3, 1 << 40, 4 * (2**31 - 1)])
    want = joined_crc32(joined_crc32(5, 7, 1 << 40), 9, 4 * (2**31 - 1))
    assert joined_crc32s(crcs, sizes, np.array([0])).tolist() == [want]


def digest_of(rows, path):
    """(doc_id, start, n_tokens, crc) of (id, text) in order."""
    encode, out, at = whole(path), [], 0
    for k, t in rows:
        ids = encode(t) + np.array([2], "<u4").tobytes()
        out.append((k, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


@pytest.mark.parametrize("block_ids", [64, 8192])
def test_token_files(spark, documents, texts, block_ids):
    path = os.path.join(tempfile.mkdtemp(), "files")
    write_token_files(documents, path, BYTES, BYTE_LEVEL_PIECES, 2, block_ids=block_ids, lanes=50)
    got = sorted(map(tuple, token_digest(spark, path).collect()), key=lambda r: r[1])
    assert got == digest_of(texts.items(), BYTES)
    ids = {}
    for r in read_token_files(spark, path).orderBy("segment", "block", "nth").collect():
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    library = Tokenizer.from_file(BYTES)
    assert all(library.decode(np.frombuffer(ids[k], "<u4")[:-1]) == t for k, t in texts.items())


def test_token_files_of_odd_rows(spark, odd, none):
    path = os.path.join(tempfile.mkdtemp(), "files")
    write_token_files(odd, path, BYTES, BYTE_LEVEL_PIECES, 2, block_ids=512)
    rows = sorted(token_digest(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 8]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    texts = {(r.doc_id, digest_of([(0, r.text)], BYTES)[0][2:]) for r in odd.collect()}
    assert {(r.doc_id, (r.n_tokens, r.ids_crc32)) for r in rows} == texts
    write_token_files(none, path + "-none", BYTES, BYTE_LEVEL_PIECES, 2)
    assert token_digest(spark, path + "-none").collect() == []


def test_damaged_blocks_are_found(spark, documents):
    path = os.path.join(tempfile.mkdtemp(), "files")
    write_token_files(documents.limit(5), path, BYTES, BYTE_LEVEL_PIECES, 2)
    rows = [r.asDict() | {"crc32": r.crc32 ^ 1} for r in spark.read.parquet(path).collect()]
    spark.createDataFrame(rows, FORMAT).write.parquet(path + "-damaged")
    with pytest.raises(Exception, match="is damaged"):
        read_token_files(spark, path + "-damaged").collect()


@given(st.lists(st.integers(1, 100), min_size=1, max_size=40), st.integers(1, 8))
@settings(max_examples=200, deadline=None)
def test_differencing_is_a_partition(sizes, k):
    sizes = np.array(sizes)
    found, sums = differencing(sizes, k)
    assert sorted(np.bincount(found, weights=sizes, minlength=k).astype(int)) == sorted(sums)
    dense, n = windows(sizes, 100)
    assert np.bincount(dense, weights=sizes).max() <= 100 and set(dense) == set(range(n))


def test_differencing_balances():
    assert differencing(np.array([8, 7, 6, 5, 4]), 2)[1].tolist() == [16, 14]
    rng = np.random.default_rng(1)
    sums = differencing(rng.integers(1, 4096, 2000), 500)[1]
    assert sums[0] - sums[-1] < 0.05 * sums.mean()


def packed_right(rows, texts, capacity):
    """texts: (id, text); every id in one piece, sequences gapless and numbered."""
    want = sorted((k, *digest_of([(0, t)], WORDS)[0][2:]) for k, t in texts)
    docs = {}
    for r in rows:
        docs.setdefault((r.doc_id or -1, r.doc_tokens), []).append(r)
    assert sum(r.length for r in rows) == sum(w[1] for w in want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return docs


def test_packing(documents, texts):
    rows = pack(documents, WORDS, WORD_PIECES, 2, capacity=256, group_rows=50).collect()
    docs = packed_right(rows, texts.items(), 256)
    encode = whole(WORDS)
    for (k, n), pieces in docs.items():
        ids = encode(texts[0 if k == -1 else k]) + np.array([2], "<u4").tobytes()
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == n == len(ids) // 4
    used = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) > 0.95 * 256 * used


def test_packing_of_odd_rows(odd, none):
    rows = pack(odd, WORDS, WORD_PIECES, 2, capacity=64, group_rows=2).collect()
    packed_right(rows, [(r.doc_id or -1, r.text) for r in odd.collect()], 64)
    assert [r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert pack(none, WORDS, WORD_PIECES, 2).collect() == []


@pytest.mark.parametrize(("path", "pieces"), [(BYTES, BYTE_LEVEL_PIECES), (WORDS, WORD_PIECES)])
def test_added_tokens_as_in_the_plain_call(path, pieces):
    library, encoder = Tokenizer.from_file(path), PieceEncoder(path, pieces, added_tokens=True)
    same = lambda t: encoder.encode(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert same("one <|endoftext|> two") and same("<|endoftext|>" * 3) and same("a b <|endoftext|>" * 100_000)
    signs = [*SIGNS, "<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "<|endof"]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(signs), max_size=40).map("".join))
    def random_texts(text):
        assert same(text)

    random_texts()


def test_operators_take_added_tokens(spark):
    texts = ["one <|endoftext|> two", "three", "<|startoftext|>four<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def crcs(path):
        library = Tokenizer.from_file(path)
        return [zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for t in texts]

    path = os.path.join(tempfile.mkdtemp(), "files")
    write_token_files(docs, path, BYTES, BYTE_LEVEL_PIECES, 2)
    assert [r.ids_crc32 for r in token_digest(spark, path).orderBy("doc_id").collect()] == crcs(BYTES)
    assert [r.ids_crc32 for r in pack(docs, WORDS, WORD_PIECES, 2).orderBy("doc_id").collect()] == crcs(WORDS)
