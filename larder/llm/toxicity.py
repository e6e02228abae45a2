"""Toxicity: a linear classifier with a counterfactual penalty.

A text's features are its distinct words and their first four and five
characters, hashed.  The weights minimise logistic loss, an L1 penalty that
leaves most words without weight, and the squared change of a text's score when
the identity terms in it are swapped for others of their group, so that naming
a group is not taken for an insult.  They are fitted on a bounded, stratified
sample of labelled documents; scoring reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import id_fold, rows_where, slices

BITS = 22
#: Labelled documents of each label that the weights are fitted on, at most.
SAMPLE_PER_LABEL = 3000
#: Features that occur in fewer sampled documents get no weight.
LEAST_DOCS = 4
MAX_FEATURES = 40_000
L1 = 0.002
COUNTERFACTUAL = 1.0
STEPS = 250
CACHE_WORDS = 200_000

#: Groups of terms that may be swapped for one another (a parameter).
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"),
    ("immigrant", "native"), ("immigrants", "natives"), ("old", "young"), ("blind", "deaf"),
    ("frau", "mann"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("musulman", "chrétien", "juif"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("musulmán", "cristiano", "judío"),
)

_WORD = re.compile(r"\w+")


def distinct_words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def word_features(word: str) -> list[int]:
    """Hashed features of a word: the word, and its first 4 and 5 characters."""
    data = [word, *("^" + word[:n] for n in (4, 5) if len(word) >= n)]
    return [zlib.crc32(d.encode()) & (1 << BITS) - 1 for d in data]


def swaps(words: set[str], groups: tuple[tuple[str, ...], ...]) -> list[tuple[str, str]]:
    """Each identity term of a text with the next of its group."""
    return [(g[i], g[(i + 1) % len(g)]) for g in groups for i in range(len(g)) if g[i] in words]


class _Rows:
    """Sparse rows for products with a vector and its transpose."""

    def __init__(self, n: int, columns: int, row: np.ndarray, col: np.ndarray, val: np.ndarray):
        self.n, self.columns = n, columns
        self.row, self.col, self.val = row.astype(np.int32), col.astype(np.int32), val.astype(np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * r[self.row], minlength=self.columns)


def _joined(parts: list[np.ndarray], kind: str) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


def fit_weights(ids: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray, differences: list[Counter],
                penalty: float = COUNTERFACTUAL, l1: float = L1) -> tuple[dict[int, float], float]:
    """(weights by feature, intercept) by accelerated proximal gradient steps.

    ``ids``, ``counts``: the distinct features of each text and how many of its
    words have them; ``differences``: features of a text less those of its
    swapped version.
    """
    if not len(toxic) or toxic.min() == toxic.max():
        return {}, -20.0 if not len(toxic) or not toxic[0] else 20.0
    row = np.repeat(np.arange(len(ids), dtype=np.int32), [len(i) for i in ids])
    feature, value = _joined(ids, "<u4"), _joined(counts, "<u4")
    one, zero = toxic.sum(), (1 - toxic).sum()
    docs = np.bincount(feature, minlength=1 << BITS)
    p = np.bincount(feature[toxic[row] == 1], minlength=1 << BITS)
    kept = np.flatnonzero(docs >= LEAST_DOCS)
    p, q = p[kept].astype(float), (docs - p)[kept].astype(float)
    gap = np.abs(p / one - q / zero) / np.sqrt((p + q + 1) / (one + zero))
    chosen = np.sort(kept[np.lexsort((kept, -gap))[:MAX_FEATURES]])
    m = bias = len(chosen)

    def place(f: np.ndarray) -> np.ndarray:
        """Column of each feature, -1 for those without one."""
        at = np.minimum(np.searchsorted(chosen, f), max(m - 1, 0))
        return np.where(chosen[at] == f, at, -1) if m else np.full(len(f), -1)

    col = place(feature)
    use = col >= 0
    n = len(ids)
    x = _Rows(n, m + 1, np.concatenate([row[use], np.arange(n)]), np.concatenate([col[use], np.full(n, bias)]),
              np.concatenate([value[use], np.ones(n)]))
    # Columns are scaled by their size so that one step length suits all.
    size = np.sqrt(np.bincount(x.col, x.val ** 2, minlength=m + 1) / x.n)
    scale = 1 / np.maximum(size, 0.05)
    scale[bias] = 1.0
    x.val *= scale[x.col]
    changed = [(k, f, v) for k, t in enumerate(differences) for f, v in t.items() if v]
    at = place(np.array([f for _, f, _ in changed], np.int64))
    has = at >= 0
    d = _Rows(len(differences), m + 1, np.array([k for k, _, _ in changed], np.int32)[has], at[has],
              np.array([v for _, _, v in changed], float)[has])
    d.val *= scale[d.col]
    weight = np.where(toxic == 1, 0.5 / one, 0.5 / zero)  # both labels count alike

    def spread(rows: _Rows, by: np.ndarray | float) -> float:
        v = np.ones(rows.columns)
        for _ in range(20):
            v = rows.back(by * rows.dot(v / (np.linalg.norm(v) or 1)))
        return float(np.linalg.norm(v))

    step = 1 / (0.25 * spread(x, weight) + (2 * penalty / d.n * spread(d, 1.0) if d.n else 0) + 1e-9)
    w = z = np.zeros(m + 1)
    t = 1.0
    shrink = np.full(m + 1, l1 * step)
    shrink[bias] = 0
    for _ in range(STEPS):
        error = weight * (1 / (1 + np.exp(-np.clip(x.dot(z), -35, 35))) - toxic)
        grad = x.back(error)
        if d.n:
            grad += 2 * penalty / d.n * d.back(d.dot(z))
        new = z - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    w = w * scale
    return {int(chosen[j]): float(w[j]) for j in np.flatnonzero(w[:m])}, float(w[bias])


class ToxicityModel:
    """Weights (at most ``MAX_FEATURES``) and the score of a text."""

    def __init__(self, weights: dict[int, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"weights": self.weights, "intercept": self.intercept, "known": {}}

    def word(self, word: str) -> float:
        value = sum(self.weights.get(f, 0.0) for f in word_features(word))
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = value
        return value

    def score(self, text: str | None) -> float:
        known = self.known
        # Sorted, so that the sum does not depend on the order in a set.
        values = sorted(v for w in distinct_words(text) if (v := known[w] if w in known else self.word(w)))
        total = self.intercept + sum(values)
        return float(1 / (1 + np.exp(-min(max(total, -35.0), 35.0))))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample: int = SAMPLE_PER_LABEL,
        groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = COUNTERFACTUAL) -> ToxicityModel:
    """Learn from labelled documents outside the held-out fold.

    A document with several labels is toxic if any says so.  Without labels of
    both kinds every text gets the score of the one kind (0 if none).
    """
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_fold("doc_id", folds) != held_out))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    mark = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30))
    share = F.when(F.col("toxic") == 1, F.lit(1.2 * sample / n.get(1, 1))).otherwise(F.lit(1.2 * sample / n.get(0, 1)))
    some = known.withColumn("mark", mark).where(F.col("mark") < share * (1 << 30))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("toxic").orderBy("mark", "doc_id")))
    some = some.where(F.col("rank") <= sample).select("doc_id", "toxic")
    # At most twice ``sample`` ids are broadcast, and as many texts' features gathered.
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, counts, less, more = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = distinct_words(text)
                of = Counter(f for w in words for f in word_features(w))
                ids.append(np.array(sorted(of), "<u4").tobytes())
                counts.append(np.array([of[f] for f in sorted(of)], "<u4").tobytes())
                pairs = swaps(words, groups)
                less.append([f for a, _ in pairs for f in word_features(a)])
                more.append([f for _, b in pairs for f in word_features(b)])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()),
                 pa.array(less, kind), pa.array(more, kind)], ["doc_id", "toxic", "ids", "counts", "less", "more"])

    shape = "doc_id long, toxic int, ids binary, counts binary, less array<int>, more array<int>"
    found = rows.mapInArrow(run, shape).collect()
    found.sort(key=lambda r: (r.doc_id, r.ids, r.counts))
    ids = [np.frombuffer(r.ids, "<u4") for r in found]
    counts = [np.frombuffer(r.counts, "<u4") for r in found]
    differences = []
    for r in found:
        if r.less:
            change = Counter(r.less)
            change.subtract(Counter(r.more))
            differences.append(change)
    toxic = np.array([r.toxic for r in found], np.float64)
    return ToxicityModel(*fit_weights(ids, counts, toxic, differences, penalty))


def score(docs: DataFrame, model: ToxicityModel, folds: int = 5, held_out: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    Only the text is read.  Null and empty texts score as a text without
    words; repeated rows are scored one by one; a null id is in no fold.
    """
    rows = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [shared.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", F.coalesce(id_fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Documents with a score below 0.5, with all their columns as they are.

    Null and empty texts score as a text without words; repeated rows are
    judged one by one; null ids stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows_where(docs, lambda: lambda texts: [shared.value.score(t) < 0.5 for t in texts])
