"""Exact encoding and decoding with a merge-type (BPE) SentencePiece model.

Encoding is by backtracking instead of merging: an Aho-Corasick automaton over
the vocabulary finds every piece that starts at each position; the longest is
tried first.  A piece may follow another only if the two are compatible, that
is if merging their joined characters again gives just these two pieces.  When
no piece fits, the position is marked in a bitfield of failed positions, the
last piece is taken back and the next shorter one is tried.  Two neighbouring
characters that stand together in no piece are never merged, so texts are cut
there first; characters outside the vocabulary become byte pieces.

Texts are cut at the starts of space runs first where the model proves that
nothing merges across them (``token_counts.splits_at_spaces``), so results of
common pre-tokens are remembered in a bounded table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import held_by, slices
from larder.llm.token_counts import SPACE, _model_proto, pretokens, splits_at_spaces

# Remembered pre-tokens of a worker, in bytes; an entry costs about 160 bytes
# besides its text and ids.
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 160
CACHE_PARTS = 50_000
CACHE_WORD_CHARS = 64
CACHE_PAIRS = 200_000


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick

        proto = _model_proto(path)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("not a BPE model that leaves texts as they are")
        if any(p.type == 4 for p in proto.pieces):
            raise ValueError("symbols set by the user are not supported")
        self.prefix = norm.add_dummy_prefix
        self.split = splits_at_spaces(proto)
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == 1}
        self.id_of = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.unk = next(i for i, t in enumerate(self.types) if t == 2)
        self.end = self.pieces.index("</s>")
        self.chars = {c for p in self.id_of for c in p}
        # Neighbouring characters of any piece: nothing merges across others.
        self.inside = {p[i:i + 2] for p in self.id_of for i in range(len(p) - 1)}
        self.memo: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        # Only pieces that merging can build at all may be matched.
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.pieces]
        self.digits = [str(i) for i in range(len(self.pieces))]
        # What an id adds to the text; None for bytes, which are joined first.
        self.surface = [" ⁇ " if t == 2 else "" if t == 3 else None if t == 6 else p.replace(SPACE, " ")
                        for p, t in zip(self.pieces, self.types, strict=True)]

    def merge(self, text: str) -> list[str]:
        """The model's own merges, on a few characters: the best pair first,
        the leftmost of equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            x, y = self.pieces[a], self.pieces[b]
            known = self.merge(x + y) == [x, y]
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[(a, b)] = known
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        whole = self.id_of.get(text)
        if whole is not None and self.automaton.exists(text):
            return [whole]
        n = len(text)
        at: list[list[int]] = [[] for _ in text]  # pieces by start, the longest last
        for end, (length, i) in self.automaton.iter(text):
            at[end - length + 1].append(i)
        length_of, known, compatible = self.length, self.pairs.get, self.compatible
        failed = bytearray(n + 1)
        ids: list[int] = []
        tried: list[int] = []  # for each id, its index among the pieces of its start
        pos, k, last = 0, len(at[0]) - 1, None
        while pos < n:
            options = at[pos]
            while k >= 0:
                i = options[k]
                if not failed[pos + length_of[i]]:
                    if last is None:
                        break
                    fits = known((last, i))
                    if compatible(last, i) if fits is None else fits:
                        break
                k -= 1
            if k >= 0:
                ids.append(i)
                tried.append(k)
                last = i
                pos += length_of[i]
                k = len(at[pos]) - 1 if pos < n else 0
            else:
                if last is None:
                    raise AssertionError("a text of known characters has an encoding")
                failed[pos] = 1
                pos -= length_of[ids.pop()]
                k = tried.pop() - 1
                last = ids[-1] if ids else None
        return ids

    def encode_marked(self, text: str) -> list[int]:
        """Ids of a text in which spaces are already space marks."""
        if len(text) > 1 and self.inside.issuperset(map(str.__add__, text, text[1:])):
            return self._known(text)  # no cut, as in most pre-tokens
        ids: list[int] = []
        start, inside = 0, self.inside
        for i in range(1, len(text) + 1):
            if text[i - 1:i + 1] not in inside:  # at the end this is one character
                part, start = text[start:i], i
                if len(part) > 1 or part in self.chars:
                    ids += self._remembered(part)
                elif self.byte_id:
                    ids += [self.byte_id[b] for b in part.encode("utf-8")]
                elif not ids or ids[-1] != self.unk:
                    ids.append(self.unk)
        return ids

    def _remembered(self, part: str) -> list[int]:
        ids = self.memo.get(part)
        if ids is None:
            ids = self._known(part)
            if len(part) <= CACHE_WORD_CHARS:
                if len(self.memo) >= CACHE_PARTS:
                    self.memo.clear()
                self.memo[part] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without begin and end ids."""
        if not text:
            return []
        if not self.split:
            return self.encode_marked((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        return [i for word in pretokens(text) for i in self.encode_marked(SPACE + word.replace(" ", SPACE))]

    def decode_part(self, ids: list[int]) -> str:
        """The text of ids with the space mark in front still a space."""
        out = [self.surface[i] for i in ids]
        if None not in out:
            return "".join(out)
        surfaces, out = out, []
        held = bytearray()
        for i, surface in zip(ids, surfaces, strict=True):
            if surface is None:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_utf8(held))
                held = bytearray()
            out.append(surface)
        if held:
            out.append(_utf8(held))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        front = next((i for i in ids if self.types[i] != 3), None)
        marked = front is not None and self.types[front] == 1 and self.pieces[front].startswith(SPACE)
        return text[1:] if self.prefix and marked else text


def _utf8(held: bytearray) -> str:
    """Bytes as text; each byte that is part of no character is U+FFFD."""
    out, k, data = [], 0, bytes(held)
    while k < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[k:k + n].decode("utf-8"))
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


class _Words(dict):
    """pre-token -> its ids as decimal text.

    What the ids decode to is kept only for the pre-tokens that do not come
    back as they are; the others are their own decoded text."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec
        self.odd: dict[str, str] = {}
        self.held = 0

    def __missing__(self, word: str) -> bytes:
        codec = self.codec
        ids = codec.encode_marked(SPACE + word.replace(" ", SPACE))
        value = " ".join([codec.digits[i] for i in ids]).encode()
        decoded = codec.decode_part(ids)
        if decoded != " " + word:
            self.odd[word] = decoded
            self.held += ENTRY_BYTES + len(word) + len(decoded)
        if len(word) <= CACHE_WORD_CHARS:
            self[word] = value
            self.held += ENTRY_BYTES + len(word) + len(value)
        return value

    def make_room(self) -> None:
        """Between texts: forget all when the memory set for it is full."""
        if self.held > CACHE_BYTES:
            self.clear()
            self.odd.clear()
            self.held = 0

    def decoded(self, words: list[str]) -> str:
        """The decoded text of pre-tokens whose ids were taken, without the
        mark in front."""
        if self.odd.keys().isdisjoint(words):
            return " ".join(words)
        return "".join([self.odd.get(w) or " " + w for w in words])[1:]


def codec(path: str) -> PieceCodec:
    held = held_by("sentencepiece")
    if path not in held:
        held[path] = PieceCodec(path)
    return held[path]


def encode_texts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 add_end: bool = True) -> DataFrame:
    """id and the ids of each text (array of int); null text counts as empty."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            c = codec(model_path)
            tail = [c.end] if add_end else []
            ids = [c.encode(t) + tail for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the text of each array of ids; null counts as no ids."""
    rows = df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            c = codec(model_path)
            text = [c.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(text, pa.string())], ["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text with an end id, decode the ids, and return their
    digests: id, n_tokens, ids_sha256, decoded_sha256.

    Null text counts as empty: only the end id, decoded to an empty text.
    Repeated rows and null ids stay; other columns are not read.
    """
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        words = _Words(c)  # of the task: a worker that goes on to other steps keeps none
        for batch in slices(batches):
            n, of_ids, of_text = [], [], []
            for text in batch.column("text").to_pylist():
                if text and c.split:
                    words.make_room()
                    cut = pretokens(text)
                    ids = b"%b %d" % (b" ".join(map(words.__getitem__, cut)), c.end)
                    n.append(ids.count(b" ") + 1)
                    of_ids.append(sha(ids).hexdigest())
                    of_text.append(sha(words.decoded(cut).encode()).hexdigest())
                else:
                    every = [*c.encode(text), c.end]
                    n.append(len(every))
                    of_ids.append(sha(" ".join(map(str, every)).encode()).hexdigest())
                    of_text.append(sha(c.decode(every).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
