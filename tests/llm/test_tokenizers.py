"""Operators 3, 4 and 9 against the libraries."""

import hashlib
import io
import zlib

import numpy as np
import pytest
from helpers_llm import docs, odd_rows, same_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from larder.llm import sentencepiece_codec as codec
from larder.llm import token_counts, token_file
from larder.llm.queries import PIECES, WORDS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sp():
    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pieces():
    return codec.PieceCodec(PIECES)


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(PIECES, token_counts.prove_whole_tokens(PIECES))


TEXTS = st.text(alphabet=st.one_of(st.sampled_from("the in ▁ \n\t.,aeiouéß🙂\0"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_codec_and_counts_equal_the_library(text, sp, pieces, counter):
    ids = sp.encode(text)
    assert pieces.encode(text) == ids
    assert counter.count(text) == len(ids)
    assert pieces.decode([*ids, 2]) == sp.decode([*ids, 2])


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.integers(0, 31999), max_size=12))
def test_decode_of_any_ids(ids, sp, pieces):
    assert pieces.decode(ids) == sp.decode(ids)


def test_whole_tokens_are_proven(sp):
    whole = token_counts.prove_whole_tokens(PIECES)
    assert len(whole) > 10_000
    assert all(len(sp.encode(w)) == 1 for w in sorted(whole)[::50])


def test_pieces_that_merging_cannot_build_are_left_out(pieces):
    for piece in list(pieces.id_of)[::97]:
        assert pieces.automaton.exists(piece) == (pieces.merge(piece) == [piece])


def test_count_tokens_on_odd_rows(spark, sp):
    got = token_counts.count_tokens(docs(spark), PIECES).collect()
    want = [(i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t, *_ in odd_rows()]
    assert same_rows([tuple(r) for r in got], want)
    assert token_counts.count_tokens(docs(spark, []), PIECES).collect() == []


def test_round_trip_on_odd_rows(spark, sp):
    def row(i, t):
        ids = [*sp.encode(t or ""), 2]
        return (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(sp.decode(ids).encode()).hexdigest())

    got = codec.round_trip_digests(docs(spark), PIECES).collect()
    assert same_rows([tuple(r) for r in got], [row(i, t) for i, t, *_ in odd_rows()])
    assert codec.round_trip_digests(docs(spark, []), PIECES).collect() == []


def test_encode_then_decode_frames(spark, sp):
    df = docs(spark)
    ids = codec.encode_texts(df, PIECES)
    back = codec.decode_ids(ids, PIECES).collect()
    assert same_rows([tuple(r) for r in back], [(i, sp.decode(sp.encode(t or ""))) for i, t, *_ in odd_rows()])


def test_documents_of_the_table(spark, sp):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    for r in codec.round_trip_digests(df, PIECES).collect():
        ids = [*sp.encode(text[r.doc_id]), 2]
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


# ------------------------------------------------------------------ token files


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("Don't I'LL 12 éÉß×÷ \n\t!?<|endoftext|>"), st.characters(codec="utf-8")), max_size=60))
def test_word_encoder_equals_the_library(text):
    lib = token_file.encoder(WORDS).lib
    enc = token_file.encoder(WORDS)
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == lib.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="stremvld'' é9.\n", max_size=12) | st.sampled_from([None, "中 12", "<|endoftext|>"]), max_size=8))
def test_texts_are_cut_together(texts):
    enc = token_file.WordEncoder.__new__(token_file.WordEncoder)
    enc.__dict__ |= token_file.encoder(WORDS).__dict__ | {"known": {}}
    asked = []
    enc._encode_words = lambda words: asked.extend(words) or token_file.WordEncoder._encode_words(enc, words)
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode_many(texts)]
    assert got == [enc.lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    # The library is given each pre-token once, not each run between white space.
    assert len(asked) == len(set(asked)) and all(w.isalpha() or not any(c.isalpha() for c in w[1:]) or w[0] == "'" for w in asked)


def test_texts_in_parts_and_a_full_table(monkeypatch):
    monkeypatch.setattr(token_file, "CHARS_AT_ONCE", 20)
    monkeypatch.setattr(token_file, "CACHE_WORDS", 5)
    enc = token_file.WordEncoder(WORDS)
    texts = ["we'll see, won't we?", "", "a b c d e f g h", None, "é" * 70 + " é", "we'll see"] * 2
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode_many(texts)]
    assert got == [enc.lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert b"we" in enc.known and not any(len(w) > token_file.CACHE_WORD_CHARS for w in enc.known)


@settings(max_examples=100, deadline=None)
@given(counts=st.lists(st.integers(0, 10_000), min_size=1, max_size=40), limit=st.integers(6, 9))
def test_code_lengths_are_a_complete_code_within_the_limit(counts, limit):
    n = token_file.code_lengths(np.array(counts), limit)
    used = [int(x) for x in n if x]
    assert len(used) == sum(c > 0 for c in counts)
    assert all(x <= limit for x in used)
    if len(used) > 1:
        assert sum(2.0 ** -x for x in used) == 1.0


def test_code_lengths_are_optimal_without_a_limit():
    import heapq

    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((token_file.code_lengths(counts, 16) * counts).sum()) == cost


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 300), max_size=1500))
def test_pack_and_unpack(ids):
    ids = np.array(ids, np.int64)
    n = token_file.code_lengths(np.bincount(ids, minlength=301))
    words, checkpoints, _ = token_file.pack(ids, token_file.canonical_codes(n), n)
    assert (token_file.unpack(words, checkpoints, len(ids), token_file.decode_table(n)) == ids).all()


def test_file_blocks_read_back():
    ids = np.arange(1000) % 37
    n = token_file.code_lengths(np.bincount(ids, minlength=40))
    codes = token_file.canonical_codes(n)
    data = token_file.file_head(n) + b"".join(
        token_file.block_bytes([(5, False, 400), (0, True, 100)], ids[:500], codes, n) for _ in range(2))
    blocks = list(token_file.read_blocks(io.BytesIO(data)))
    assert len(blocks) == 2
    doc, null, each, got = blocks[1]
    assert doc.tolist() == [5, 0] and null.tolist() == [0, 1] and each.tolist() == [400, 100] and (got == ids[:500]).all()


def test_token_files_on_odd_rows(spark):
    lib = Tokenizer.from_file(WORDS)
    rows = odd_rows()
    got = token_file.write_and_read(docs(spark), WORDS).collect()
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(lib.encode(t or "", add_special_tokens=False).ids + [2])
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        assert (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r.doc_id]}
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert token_file.write_and_read(docs(spark, []), WORDS).collect() == []


def test_token_files_hold_the_ids_and_roll(spark, tmp_path):
    lib = Tokenizer.from_file(WORDS)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    files = token_file.write_tokens(df, WORDS, f"file://{tmp_path}/ids", 2, file_bytes=1)
    assert not list((tmp_path / "ids").glob("_tmp*")) and (tmp_path / "ids" / "manifest.json").exists()
    got = {r.doc_id: r.ids for r in token_file.read_tokens(spark, files).collect()}
    for r in df.collect():
        assert got[r.doc_id] == lib.encode(r.text, add_special_tokens=False).ids + [2]
