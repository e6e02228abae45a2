"""Benchmark decontamination: documents that hold passages of test items.

Words are runs of ASCII digits, letters (A-Z taken as a-z) and all characters
beyond ASCII.  Every ten words of an item in a row are a window; an item of
fewer words is one window.  The hashes of all windows form a set that each task
gets as a broadcast; documents are scanned as bytes, every candidate is
verified by its words, and a document word inside any occurrence is hit.

The set is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows: a test set
beyond that is scanned for in several passes whose hits are merged, so the
broadcast is bounded and nothing is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import joined, rows_where, slices, stored, text_chunks, word_hashes

WINDOW = 10
BLOCK_WINDOWS = 400_000
_FILTER_BITS = 22

# Bytes as they count in words: A-Z as a-z; whether a byte is part of a word.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[ord("0"):ord("9") + 1] = True
_IS_WORD[ord("a"):ord("z") + 1] = True
_IS_WORD[0x80:] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes, word hashes, first bytes, end bytes, document of each word)."""
    data, starts = joined(run)
    data = _LOWER[data]
    h, first, end = word_hashes(data, _IS_WORD[data], starts)
    doc = np.searchsorted(starts, first, side="right") - 1
    # Empty texts share their start with the next one: count to the last of them.
    return data, h, first, end, doc


def _window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (of those that have k)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * _STEP + h[j:j + n]
        return out ^ (out >> np.uint64(29)) ^ np.uint64(k)


class WindowSet:
    """Windows of a block of items: (words, item) by length and hash."""

    def __init__(self, windows: list[tuple[int, int, str, int]]):
        """windows: (length in words, hash, words joined by one space, item)."""
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, dict[int, dict[bytes, list[int]]]]] = {}
        for k in sorted({w[0] for w in windows}):
            of: dict[int, dict[bytes, list[int]]] = {}
            for _, h, words, item in (w for w in windows if w[0] == k):
                of.setdefault(h, {}).setdefault(words.encode(), []).append(item)
            seen = np.zeros(1 << _FILTER_BITS, bool)
            hashes = np.array(sorted(of), np.uint64)
            seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.by_length[k] = (seen, hashes, of)

    def hits(self, run: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[set[int]], np.ndarray, np.ndarray]:
        """(words, hit words, items) per document, and whether each word is hit
        with its document."""
        data, h, first, end, doc = _words(run)
        mark = np.zeros(len(h) + 1, np.int64)
        items: list[set[int]] = [set() for _ in run]
        for k, (seen, hashes, of) in self.by_length.items():
            w = _window_hashes(h, k)
            if not len(w):
                continue
            at = np.flatnonzero(seen[(w >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            at = at[doc[at] == doc[at + k - 1]]
            place = np.searchsorted(hashes, w[at])
            place[place == len(hashes)] = 0
            for i in at[hashes[place] == w[at]].tolist():
                words = b" ".join(data[first[j]:end[j]].tobytes() for j in range(i, i + k))
                found = of[int(w[i])].get(words)
                if found:
                    mark[i] += 1
                    mark[i + k] -= 1
                    items[doc[i]].update(found)
        hit = np.cumsum(mark[:-1]) > 0
        n = len(run)
        return np.bincount(doc, minlength=n), np.bincount(doc[hit], minlength=n), items, hit, doc


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of all items: k (words), h (hash), words, item.  Items
    that are null or have no word have none; an item without an id cannot be
    named in a result, so by rule it is no item and its passages are no hits."""
    rows = benchmark.select(benchmark["item_id"].alias("item"), benchmark["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("item").to_pylist()
            k_of, h_of, words_of, item_of = [], [], [], []
            for start, texts in text_chunks(batch.column("text").to_pylist()):
                data, h, first, end, doc = _words(texts)
                for d in range(len(texts)):
                    own = np.flatnonzero(doc == d)
                    if not len(own) or ids[start + d] is None:
                        continue
                    lo, n = int(own[0]), len(own)
                    words = [data[first[j]:end[j]].tobytes().decode() for j in range(lo, lo + n)]
                    k = min(WINDOW, n)
                    hashes = _window_hashes(h[lo:lo + n], k).tolist()
                    for i, value in enumerate(hashes):
                        k_of.append(k)
                        h_of.append(value - (1 << 64) if value >= 1 << 63 else value)
                        words_of.append(" ".join(words[i:i + k]))
                        item_of.append(ids[start + d])
            yield pa.RecordBatch.from_arrays(
                [pa.array(k_of, pa.int32()), pa.array(h_of, pa.int64()), pa.array(words_of, pa.string()),
                 pa.array(item_of, pa.int64())], ["k", "h", "words", "item"])

    return rows.mapInArrow(run, "k int, h long, words string, item long").distinct()


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, int, str, int]]]:
    """All windows in blocks that fit a broadcast (one empty block if none)."""
    windows = stored(benchmark.sparkSession, item_windows(benchmark), "benchmark-windows")
    n = windows.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    for b in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("k", "h"), F.lit(blocks)) == b)
        yield [(r.k, r.h % (1 << 64), r.words, r.item) for r in part.collect()]


_OUT = "doc_id {kind}, n_words long, n_hit long, items array<long>"


def find_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items (ids of the items found, sorted as strings).

    Null or empty texts have no words and no hits; repeated documents are
    judged one by one; null ids stay; other columns are not read.  An empty
    test set hits nothing.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    sets = list(_blocks(benchmark))
    if len(sets) == 1:
        found = rows.mapInArrow(_scan(spark.sparkContext.broadcast(sets[0])), _OUT.format(kind=kind))
    else:
        found = _merged(rows, [spark.sparkContext.broadcast(s) for s in sets], kind)
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        ids.alias("items"),
    )


def _scan(windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(windows.value)
        for batch in slices(batches):
            n_words, n_hit, items = [], [], []
            for _, texts in text_chunks(batch.column("text").to_pylist()):
                n, hit, found, _, _ = known.hits(texts)
                n_words += n.tolist()
                n_hit += hit.tolist()
                items += [list(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.int64()))], ["doc_id", "n_words", "n_hit", "items"])

    return run


def _merged(rows: DataFrame, blocks: list, kind: str) -> DataFrame:
    """Hits of several passes: each pass adds its marks to the document's row,
    so a word that two blocks hit counts once."""
    from functools import reduce

    marked = rows.withColumn("spans", F.lit(None).cast("array<long>")).withColumn("items", F.lit(None).cast("array<long>"))
    marked = marked.withColumn("n_words", F.lit(0).cast("long"))

    def step(df: DataFrame, windows) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = WindowSet(windows.value)
            for batch in slices(batches):
                old = batch.column("items").to_pylist(), batch.column("spans").to_pylist()
                spans, items, n_words = [], [], []
                for start, texts in text_chunks(batch.column("text").to_pylist()):
                    n, _, found, hit, doc = known.hits(texts)
                    at = np.concatenate([[0], np.cumsum(n)])
                    for d in range(len(texts)):
                        own = np.flatnonzero(hit[at[d]:at[d + 1]]).tolist()
                        spans.append(sorted({*own, *(old[1][start + d] or ())}))
                        items.append(sorted({*found[d], *(old[0][start + d] or ())}))
                    n_words += n.tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(spans, pa.list_(pa.int64())),
                     pa.array(items, pa.list_(pa.int64())), pa.array(n_words, pa.int64())],
                    ["doc_id", "text", "spans", "items", "n_words"])

        shape = f"doc_id {kind}, text string, spans array<long>, items array<long>, n_words long"
        return df.select("doc_id", "text", "spans", "items", "n_words").mapInArrow(run, shape)

    out = reduce(step, blocks, marked)
    return out.select("doc_id", "n_words", F.size("spans").cast("long").alias("n_hit"), "items")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any hit word, with all their columns.

    The decision is made row by row beside the scan, so repeated rows, null
    ids and clashing column names need no join.  Null and empty texts have no
    words and stay; an empty benchmark removes nothing.
    """
    out = docs
    for block in _blocks(benchmark):
        windows = docs.sparkSession.sparkContext.broadcast(block)

        def judge(windows=windows):
            known = WindowSet(windows.value)
            return lambda texts: [bool(n == 0) for _, run_ in text_chunks(texts) for n in known.hits(run_)[1]]

        out = rows_where(out, judge)
    return out


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with hit words cut from ``text`` (from the first byte of
    a hit run to its last); a text that loses all its words becomes empty, a
    null one stays null.  Other columns, repeated rows and null ids stay."""
    out = docs
    for block in _blocks(benchmark):
        windows = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            known = WindowSet(windows.value)
            for batch in slices(batches):
                texts = batch.column("text").to_pylist()
                new: list[str | None] = []
                for start, run_ in text_chunks(texts):
                    _, n_hit, _, hit, doc = known.hits(run_)
                    new += _cut(run_, texts[start:start + len(run_)], n_hit, hit, doc)
                at = batch.schema.get_field_index("text")
                yield batch.set_column(at, "text", pa.array(new, batch.schema.field("text").type))

        out = out.mapInArrow(run, docs.schema)
    return out


def _cut(run: list[bytes], texts: list[str | None], n_hit: np.ndarray, hit: np.ndarray, doc: np.ndarray) -> list[str | None]:
    out = list(texts)
    if not hit.any():
        return out
    data, _, first, end, _ = _words(run)
    _, starts = joined(run)
    raw = b"".join(run)
    for d in np.flatnonzero(n_hit).tolist():
        own = np.flatnonzero(doc == d)
        flags = hit[own]
        kept, at = [], int(starts[d])
        stop = at + len(run[d])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            kept.append(raw[at:int(first[own[a]])])
            at = int(end[own[b - 1]])
        kept.append(raw[at:stop])
        out[d] = b"".join(kept).decode("utf-8")
    return out
