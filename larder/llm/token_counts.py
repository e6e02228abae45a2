"""Token counts by the whole-token shortcut.

A SentencePiece BPE model whose pieces hold the space mark only at their front
never merges across the start of a space run, so a text falls into independent
pre-tokens: a run of spaces with the non-spaces that follow.  Offline, each
vocabulary string that is a possible pre-token is encoded alone once; those
that give exactly one token are the proven whole tokens.  Counting looks each
pre-token up in that table and merges (with the library) only the rest, whose
counts are remembered in a bounded table of the worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from larder.llm.common import slices

SPACE = "▁"
_RUNS = re.compile(r" +[^ ]*")

# Remembered counts of a worker: about 100 bytes each.
CACHE_WORDS = 600_000
CACHE_WORD_CHARS = 64


def _model_proto(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return proto


def splits_at_spaces(proto) -> bool:
    """Whether pre-tokens are proven independent: BPE, no text rewriting, a
    space mark in front of the text, no symbols set by the user, and no piece
    with a space mark after another character."""
    norm = proto.normalizer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    bpe = proto.trainer_spec.model_type == 2 and not proto.trainer_spec.treat_whitespace_as_suffix
    front = all(SPACE not in p.piece.lstrip(SPACE) for p in proto.pieces)
    return bool(plain and bpe and front and all(p.type != 4 for p in proto.pieces))


def prove_whole_tokens(path: str) -> frozenset[str] | None:
    """Pre-tokens (without their first space) that encode as one token.

    None if pre-tokens of this model cannot be proven independent; whole
    texts are then encoded.
    """
    from sentencepiece import SentencePieceProcessor

    proto = _model_proto(path)
    if not splits_at_spaces(proto):
        return None
    sp = SentencePieceProcessor(model_file=path)
    words = [p.piece[1:].replace(SPACE, " ") for p in proto.pieces if p.type == 1 and p.piece.startswith(SPACE)]
    words = [w for w in words if w]
    return frozenset(w for w, ids in zip(words, sp.encode(words, num_threads=1), strict=True) if len(ids) == 1)


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty, each without its first space
    (the first one's is the mark that the model puts before the text)."""
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [run[1:] for run in _RUNS.findall(" " + text)]


class TokenCounter(dict):
    """pre-token -> number of tokens; starts from the proven whole tokens."""

    def __init__(self, path: str, whole: frozenset[str] | None):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=path)
        self.whole = None if whole is None else dict.fromkeys(whole, 1)
        super().__init__(self.whole or {})

    def __missing__(self, word: str) -> int:
        # The library gives an empty text no tokens; a lone space mark is one.
        n = len(self.sp.encode(word)) if word else len(self.sp.encode("a ")) - len(self.sp.encode("a"))
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
                self.update(self.whole)
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole is None:
            return len(self.sp.encode(text))
        return sum(map(self.__getitem__, pretokens(text)))


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(df: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the library without begin and end ids.  Null text
    counts as empty (0 tokens); repeated rows and null ids stay as they are;
    other columns are not read; an empty table gives an empty result.
    """
    spark = df.sparkSession
    whole = spark.sparkContext.broadcast(prove_whole_tokens(model_path))  # at most the vocabulary
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counter = _COUNTERS.get(model_path)
            if counter is None:
                counter = _COUNTERS[model_path] = TokenCounter(model_path, whole.value)
            text = batch.column("text")
            n = pa.array([counter.count(t) for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(text).cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, n, pc.greater(n, limit)],
                                             ["id", "n_bytes", "n_tokens", "over_limit"])

    out = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
