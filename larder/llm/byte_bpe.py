"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens that a partition meets for the first time are laid out
side by side as one linked row of byte tokens.  An index maps each pair of
neighbours that the vocabulary merges to all its positions in that row, and a
heap holds the ranks of the pairs in the index.  The smallest rank is taken,
all its positions are merged from left to right, and only the lists of the
pairs to the left and right of each merge are updated.  As no pair has a
smaller rank than the merge that made one of its tokens (proven from the file
when it is loaded), ranks are taken in ascending order and each pre-token gets
the merges it would get alone.  Ids of short pre-tokens are remembered in a
table bounded in bytes.

Texts are cut by the pattern of the vocabulary.  Characters below U+0558 have
the same classes here and in the tokenizers library; others are replaced by a
character of the class that the library itself puts them in, once for each
character.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from larder.llm.common import slices

# Remembered pre-tokens of a worker, in bytes; an entry costs about 160 bytes
# besides its text.
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 160
CACHE_WORD_CHARS = 64
# Texts whose pre-tokens are looked up together, and new pre-tokens that are
# indexed together, in characters; a longer one is handled alone.
TEXT_CHARS = 1 << 20
INDEX_CHARS = 1 << 17
# The first character whose class the library may see in another way.
FIRST_UNSURE = 0x558


def _ranges(belongs: Callable[[str], object]) -> str:
    """The characters below ``FIRST_UNSURE`` of a class, as ranges."""
    out, start = [], None
    for c in range(FIRST_UNSURE + 1):
        inside = c < FIRST_UNSURE and bool(belongs(chr(c)))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return "".join(out)


_SURE = re.compile(f"[\\x00-\\u{FIRST_UNSURE - 1:04x}]*")
_L, _N, _S = (_ranges(regex.compile(c).match) for c in (r"\p{L}", r"\p{N}", r"\s"))
# Fixed value: the pattern of byte-level vocabularies of this kind, for the
# characters above.
_PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    visible Latin-1 characters for themselves, the others from U+0100 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class ByteCodec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut, decoder = spec["model"], spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        if model["type"] != "BPE" or not plain or spec["normalizer"] or decoder.get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE file that leaves texts as they are")
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("this kind of BPE model is not supported")
        added = spec["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self._cutter = Tokenizer.from_file(path).pre_tokenizer
        vocab: dict[str, int] = model["vocab"]
        chars = byte_characters()
        self.first = [vocab[chars[b]] for b in range(256)]  # the id of each byte
        byte_of = {c: b for b, c in chars.items()}
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            known = all(c in byte_of for c in token)
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.digits = [b"%d" % i for i in range(size)]
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, longest_first))) if self.added else None

        # pair -> rank, as one integer key; what a rank joins and makes
        self.shift = size.bit_length()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.left = [vocab[a] for a, _ in pairs]
        self.right = [vocab[b] for _, b in pairs]
        self.made = [vocab[a + b] for a, b in pairs]
        self.rank = {a << self.shift | b: r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))}
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], order  # the same table for whole arrays
        last_made: dict[int, int] = {}
        for r, i in enumerate(self.made):
            last_made[i] = r
        if any(last_made.get(side[r], -1) >= r for r in range(len(pairs)) for side in (self.left, self.right)):
            raise ValueError("a pair ranks before the merge that makes one of its tokens")

        self.known: dict[str, bytes] = {}  # pre-token -> decimal ids joined by commas
        self.held = 0  # bytes of it
        self.stand_in: dict[int, str] = {}  # unsure character -> one of its class

    # ------------------------------------------------------------- cutting

    def _class(self, char: str) -> str:
        """A plain character of the class that the library puts ``char`` in."""
        joins = lambda a: self._cutter.pre_tokenize_str(a + char)[0][1] == (0, 2)
        return "x" if joins("x") else "0" if joins("0") else "#" if joins("#") else "\t"

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without added tokens."""
        if _SURE.fullmatch(text):
            return _PATTERN.findall(text)
        for c in set(text):
            if ord(c) >= FIRST_UNSURE and ord(c) not in self.stand_in:
                if len(self.stand_in) > 1 << 16:
                    self.stand_in.clear()
                    return self.pretokens(text)
                self.stand_in[ord(c)] = self._class(c)
        return [text[m.start():m.end()] for m in _PATTERN.finditer(text.translate(self.stand_in))]

    def pieces(self, text: str | None) -> list[str]:
        """Pre-tokens and added tokens of a whole text, in order."""
        if not text:
            return []
        if self._added is None or not self._added.search(text):
            return self.pretokens(text)
        out, at = [], 0
        for m in self._added.finditer(text):
            out += self.pretokens(text[at:m.start()]) if m.start() > at else []
            out.append(m.group())
            at = m.end()
        return out + (self.pretokens(text[at:]) if at < len(text) else [])

    # ------------------------------------------------------------- merging

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word, merged together through the occurrence index."""
        data = b"".join(words)
        n, shift, rank = len(data), self.shift, self.rank
        token = array("i", map(self.first.__getitem__, data))
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        end = 0
        for w in words:  # no pair reaches over the end of a word
            if w:
                before[end] = -1
                end += len(w)
                after[end - 1] = -1
        places = self._index(np.frombuffer(token, np.int32), np.frombuffer(after, np.int32))
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b, made = self.left[r], self.right[r], self.made[r]
            for at in sorted(places.pop(r)):
                nxt = after[at]
                if token[at] != a or nxt < 0 or token[nxt] != b:
                    continue  # an earlier merge took one of the two
                token[at], token[nxt] = made, -1
                far, near = after[nxt], before[at]
                after[at] = far
                if far >= 0:
                    before[far] = at
                    s = rank.get(made << shift | token[far])
                    if s is not None:
                        if s in places:
                            places[s].append(at)
                        else:
                            places[s] = [at]
                            heapq.heappush(active, s)
                if near >= 0:
                    s = rank.get(token[near] << shift | made)
                    if s is not None:
                        if s in places:
                            places[s].append(near)
                        else:
                            places[s] = [near]
                            heapq.heappush(active, s)
        out, at = [], 0
        for w in words:
            out.append([i for i in token[at:at + len(w)] if i >= 0])
            at += len(w)
        return out

    def _index(self, token: np.ndarray, after: np.ndarray) -> dict[int, list[int]]:
        """rank of a pair -> its positions in the row, ascending."""
        at = np.flatnonzero(after >= 0)
        if not len(at) or not len(self.keys):
            return {}
        pair = token[at].astype(np.int64) << self.shift | token[at + 1]
        k = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        found = self.keys[k] == pair
        at, ranks = at[found], self.key_ranks[k[found]]
        if not len(at):
            return {}
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        first = np.flatnonzero(np.diff(ranks, prepend=-1))
        ends = [*first[1:].tolist(), len(at)]
        positions = at.tolist()
        return {r: positions[lo:hi] for r, lo, hi in zip(ranks[first].tolist(), first.tolist(), ends, strict=True)}

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of the words that aren't known yet; short ones are remembered,
        long ones returned."""
        long: dict[str, bytes] = {}
        group: list[str] = []
        size = 0
        for w in [*words, None]:
            if group and (w is None or size + len(w) > INDEX_CHARS):
                merged = self.merge_all([x.encode() for x in group])
                for x, ids in zip(group, merged, strict=True):
                    text = b",".join([self.digits[i] for i in ids])
                    if b"".join([self.bytes_of[i] for i in ids]) != x.encode():
                        raise AssertionError("ids of a pre-token do not give its bytes")
                    if len(x) > CACHE_WORD_CHARS:
                        long[x] = text
                    else:
                        self.known[x] = text
                        self.held += ENTRY_BYTES + len(x) + len(text)
                group, size = [], 0
            if w is not None:
                group.append(w)
                size += len(w)
        return long

    def _start(self) -> None:
        self.known = {content: self.digits[i] for content, i in self.added.items()}
        self.held = 0

    def encode_digits(self, texts: list[str | None]) -> list[bytes]:
        """For each whole text its decimal ids joined by commas."""
        cut = [self.pieces(t) for t in texts]
        if self.held > CACHE_BYTES or not self.known:
            self._start()
        long = self.learn(set().union(*cut).difference(self.known))
        known = self.known
        get = (lambda w: known.get(w) or long[w]) if long else known.__getitem__
        return [b",".join(map(get, words)) for words in cut]

    def encode_many(self, texts: list[str | None]) -> list[list[int]]:
        return [list(map(int, d.split(b","))) if d else [] for d in self.encode_digits(texts)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, added tokens included; ids that the file does not
        have add nothing, bytes that are part of no character give U+FFFD."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids if 0 <= i < len(table)]).decode("utf-8", "replace")


_CODECS: dict[str, ByteCodec] = {}


def codec(path: str) -> ByteCodec:
    if path not in _CODECS:
        _CODECS[path] = ByteCodec(path)
    return _CODECS[path]


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(index of the first, texts) in runs of about ``TEXT_CHARS`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > TEXT_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, texts[start:]


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the ids of each whole text (array of int).

    Null text counts as empty and has no ids; repeated rows and null ids stay
    as they are; other columns are not read; an empty table gives none."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for lo, texts in _runs(batch.column("text").to_pylist()):
                ids = pa.array(codec(path).encode_many(texts), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, len(texts)), ids], ["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the text of each array of ids; null counts as no ids, null
    entries add nothing."""
    rows = df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            c = codec(path)
            text = [c.decode(i for i in ids or [] if i is not None) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(text, pa.string())], ["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text, decode its ids, and return id, n_tokens,
    ids_sha256 (decimal ids joined by commas) and decoded_sha256.

    Null text counts as empty: no tokens, the digest of nothing.  Repeated
    rows and null ids stay as they are; other columns are not read; an empty
    table gives none."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            c = codec(path)
            table = {d: b for d, b in zip(c.digits, c.bytes_of, strict=True)}
            for lo, texts in _runs(batch.column("text").to_pylist()):
                n, of_ids, of_text = [], [], []
                for digits in c.encode_digits(texts):
                    ids = digits.split(b",") if digits else []
                    n.append(len(ids))
                    of_ids.append(sha(digits).hexdigest())
                    data = b"".join(map(table.__getitem__, ids))
                    try:
                        data.decode()
                    except UnicodeDecodeError:
                        data = data.decode("utf-8", "replace").encode()
                    of_text.append(sha(data).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, len(texts)), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
