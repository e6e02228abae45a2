"""Operator 12 against the tokenizers library."""

import hashlib
import json

import pytest
from helpers_llm import docs, odd_rows, prose, same_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import byte_bpe
from larder.llm.queries import BYTES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteCodec(BYTES)


def expected(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    decoded = lib.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


PARTS = st.sampled_from(["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'S", "é", "ß", "日本", "🙂", "́", "\x1c", "\x85", "\xa0",
                         "​", "<|endoftext|>", "<|endo", "12", "²", "½", "٣", "՘", "\U00010940", "\x00", "aaaa", "x" * 70])
TEXTS = st.one_of(st.lists(PARTS, max_size=12).map("".join), st.text(alphabet=st.characters(codec="utf-8"), max_size=40))


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(TEXTS, max_size=4))
def test_equals_the_library(texts, lib, codec):
    ids = codec.encode_many(texts)
    assert ids == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [codec.decode(i) for i in ids] == [lib.decode(i, skip_special_tokens=False) for i in ids] == texts


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.integers(0, 50256), max_size=10))
def test_decode_of_any_ids(ids, lib, codec):
    assert codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(words=st.lists(st.text(alphabet="aeinst", min_size=1, max_size=30), max_size=12))
def test_the_index_merges_each_word_as_alone(words, codec):
    def alone(word):
        parts = [codec.first[b] for b in word]
        while True:
            ranks = [codec.rank.get(a << codec.shift | b) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            at = ranks.index(best)
            parts[at:at + 2] = [codec.made[best]]

    data = [w.encode() for w in words]
    assert codec.merge_all(data) == [alone(w) for w in data]


def test_characters_that_are_cut_here_have_the_library_s_classes(codec):
    for c in map(chr, range(byte_bpe.FIRST_UNSURE)):
        for text in ("a" + c + "a", "1" + c + "1", "!" + c + "!", c + c + "a"):
            assert codec.pretokens(text) == [text[lo:hi] for _, (lo, hi) in codec._cutter.pre_tokenize_str(text)], repr(text)


def test_a_full_table_and_long_pretokens_change_nothing(lib, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 2000)
    monkeypatch.setattr(byte_bpe, "INDEX_CHARS", 50)
    c = byte_bpe.ByteCodec(BYTES)
    for k in range(6):
        texts = [prose(k, 40), "y" * 300 + " " + prose(k + 1, 5), None, ""]
        assert c.encode_many(texts) == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert c.held < 20_000


def test_other_kinds_of_files_are_refused(tmp_path):
    with open(BYTES, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = [*spec["model"]["merges"][1:], spec["model"]["merges"][0]]  # no order of making
    wrong = tmp_path / "wrong.json"
    wrong.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="ranks before"):
        byte_bpe.ByteCodec(str(wrong))


def test_odd_rows(spark, lib):
    out = byte_bpe.round_trip_digests(docs(spark), BYTES)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert same_rows([tuple(r) for r in out.collect()], [(r[0], *expected(lib, r[1])) for r in odd_rows()])
    assert byte_bpe.round_trip_digests(docs(spark, []), BYTES).collect() == []


def test_ids_and_texts_as_tables(spark, lib):
    ids = byte_bpe.encode_texts(docs(spark), BYTES)
    assert same_rows([(r.doc_id, r.ids) for r in ids.collect()],
                     [(r[0], lib.encode(r[1] or "", add_special_tokens=False).ids) for r in odd_rows()])
    back = byte_bpe.decode_ids(ids, BYTES)
    assert same_rows([tuple(r) for r in back.collect()], [(r[0], r[1] or "") for r in odd_rows()])
    nulls = spark.createDataFrame([(1, None), (2, [None, 64, 10**6])], "doc_id long, ids array<int>")
    assert same_rows([tuple(r) for r in byte_bpe.decode_ids(nulls, BYTES).collect()], [(1, ""), (2, "a")])


def test_whole_table(spark, lib):
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_byte_bpe"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows == {r.doc_id: expected(lib, r.text) for r in texts}
