"""Language identification by nearest centroid.

A text is the TF-IDF vector, of length one, of the hashed n-grams (1 to 3
bytes of lower-case letters in UTF-8, with word ends as spaces).  Document
frequencies are counted over all learning documents.  Each language has
several centroids, found by spherical k-means on a bounded sample of its
documents.  A text takes the language of the centroid with the largest cosine;
it is rejected if that cosine is below the distance within which nearly all of
the language's own sample lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import id_fold, joined, rows_where, slices, text_chunks

DIMS = 4096
#: Documents of each language that the centroids are fitted on, at most.
SAMPLE_PER_LANGUAGE = 2000
CENTROIDS = 3
ROUNDS = 10
#: A text is rejected below this share of the language's 1st percentile.
SLACK = 0.5
UNKNOWN = "und"

# Bytes that stand for letters: a-z and everything beyond ASCII; others end words.
_LETTER = np.zeros(256, np.uint8) + ord(" ")
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 256)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed n-grams, a row per (lower-case) text."""
    data, _ = joined([t + b"  " for t in texts])
    out = np.zeros(len(texts) * DIMS)
    if not len(data):
        return out.reshape(len(texts), DIMS)
    c = _LETTER[data].astype(np.uint32)
    base = np.repeat(np.arange(len(texts)) * DIMS, [len(t) + 2 for t in texts])
    blank = c == ord(" ")
    one = c[:-2]
    two = one << np.uint32(8) | c[1:-1]
    three = two << np.uint32(8) | c[2:]
    full = ~blank[:-2], ~(blank[:-2] & blank[1:-1]), ~(blank[1:-1] & (blank[:-2] | blank[2:]))
    for size, (code, use) in enumerate(zip((one, two, three), full, strict=True)):
        mixed = (code + np.uint32(1 + size << 24)) * np.uint32(0x9E3779B1)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)
        out += np.bincount(base[:-2][use] + mixed[use], minlength=len(out))
    return out.reshape(len(texts), DIMS)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(term_counts(texts)) * idf).astype(np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _lowered(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    return text_chunks([t.lower() if t else t for t in texts], rows=256)


def _document_frequencies(learn: DataFrame) -> tuple[int, np.ndarray]:
    """Number of learning documents and how many hold each hashed n-gram: one
    number per dimension on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS + 1, np.int64)
        for batch in slices(batches):
            total[DIMS] += batch.num_rows
            for _, texts in _lowered(batch.column("text").to_pylist()):
                total[:DIMS] += (term_counts(texts) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(total)], ["dim", "n"])

    counts = np.zeros(DIMS + 1, np.int64)
    for row in learn.select("text").mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        counts[row.dim] = row.n
    return int(counts[DIMS]), counts[:DIMS]


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; seeds are taken farthest first from the mean."""
    mean = x.sum(axis=0)
    seeds, near = [], x @ (mean / (np.linalg.norm(mean) or 1))
    for _ in range(min(k, len(x))):
        seeds.append(x[int(np.argmin(near))])
        near = np.maximum(near, x @ seeds[-1])
    c = np.array(seeds)
    for _ in range(ROUNDS):
        of = np.argmax(x @ c.T, axis=1)
        c = np.array([x[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


class Centroids:
    """The fitted model: bounded by the number of languages times ``CENTROIDS``."""

    def __init__(self, idf: np.ndarray, langs: list[str], centre: np.ndarray, least: np.ndarray):
        self.idf, self.langs, self.centre, self.least = idf, langs, centre, least

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, rejected = [], [], []
        for start, run in _lowered(texts):
            if self.langs:
                cosine = vectors(run, self.idf) @ self.centre.T
                best = np.argmax(cosine, axis=1)
                top = np.clip(cosine[np.arange(len(run)), best], 0, 1).astype(float)
            for i in range(len(run)):
                if not self.langs or not has_letter(texts[start + i]):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    rejected.append(True)
                else:
                    lang.append(self.langs[best[i]])
                    score.append(float(top[i]))
                    rejected.append(bool(top[i] < self.least[best[i]]))
        return lang, score, rejected


def fit(docs: DataFrame, folds: int = 4, held_out: int = 2, sample: int = SAMPLE_PER_LANGUAGE,
        centroids: int = CENTROIDS) -> Centroids:
    """Learn from text and lang of documents outside the held-out fold."""
    learn = docs.select("doc_id", "text", "lang").where(
        (id_fold("doc_id", folds) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n, df = _document_frequencies(learn)
    idf = np.log((1 + n) / (1 + df)) + 1
    # A bounded sample of each language: first by a hash below a threshold that
    # expects 1.2 times the bound, then the bound itself among those.
    counts = learn.groupBy("lang").count()
    mark = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    some = learn.join(F.broadcast(counts), "lang").withColumn("mark", mark)  # a row per language
    some = some.where(F.col("mark") < F.lit(1.2 * sample) / F.col("count") * (1 << 30))
    order = Window.partitionBy("lang").orderBy("mark", "doc_id", "text")
    some = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample).select("lang", "text")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        texts = [t for t in table.column("text").to_pylist() if has_letter(t)]
        if not texts:
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "least": pa.array([], pa.float64())})
        x = np.concatenate([vectors(run_, idf) for _, run_ in _lowered(texts)])
        c = _cluster(x, centroids)
        top = (x @ c.T).max(axis=1)
        least = float(SLACK * np.quantile(top, 0.01))
        return pa.table({"lang": [key[0].as_py()] * len(c), "centre": [v.astype("<f4").tobytes() for v in c], "least": [least] * len(c)})

    rows = some.groupBy("lang").applyInArrow(run, "lang string, centre binary, least double").collect()
    rows.sort(key=lambda r: (r.lang, r.centre))
    centre = np.array([np.frombuffer(r.centre, "<f4") for r in rows]) if rows else np.zeros((0, DIMS), np.float32)
    return Centroids(idf, [r.lang for r in rows], centre, np.array([r.least for r in rows]))


def identify(docs: DataFrame, model: Centroids, folds: int = 4, held_out: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (cosine, 0 to
    1), rejected.

    Only the text is read for a prediction.  Null texts and texts without a
    letter are ``und`` with score 0 and rejected; ties go to the language that
    sorts first; without any learned language all texts are ``und``.  A null
    id is in no fold: held_out is false.
    """
    return _judged(docs.select("doc_id", "text"), model, "doc_id").select(
        "doc_id", F.coalesce(id_fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "rejected")


def _judged(rows: DataFrame, model: Centroids, id_col: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score, rejected = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [id_col, "lang_pred", "score", "rejected"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Centroids) -> DataFrame:
    """Documents that are not rejected, with all their columns as they are.

    Null texts and texts without a letter are in no language and go; repeated
    rows are judged one by one; null ids stay; without any learned language
    all rows go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows_where(docs, lambda: lambda texts: [not r for r in shared.value.predict(texts)[2]])
