"""Labelling by a model that the caller gives, and a fitted default.

``apply_model`` runs any object with a ``name`` and ``predict(texts) -> labels``
over the rows in Arrow batches.  ``fit_multinomial`` makes such a model from
labelled texts: its word counts are Spark aggregates, only the vocabulary (at
most ``max_words`` words) comes to the driver.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import constants as C
from larder.operators.classify import tokens

# Bytes of a pickled model that may be sent to every task.
MODEL_BYTES = 256 << 20
# Texts a task remembers the label of, and texts per call of a model.
REMEMBERED = 100_000
TEXTS_AT_ONCE = 256
MAX_WORDS = 200_000


class LabelModel(Protocol):
    """``predict`` must depend on each text alone: tasks that run again, and
    batches cut in another way, then give the same labels."""

    name: str

    def predict(self, texts: list[str]) -> list[str | None]: ...


def apply_model(df: DataFrame, id_col: str, text_col: str, model: LabelModel, label_col: str = "label",
                remembered: int = REMEMBERED) -> DataFrame:
    """(id, label) of each row: the model's label of its text.

    Each task asks the model once for a text it remembers, in calls of at most
    ``TEXTS_AT_ONCE`` texts.  A null text has a null label; repeated rows and
    null ids stay; other columns are not read; an empty table gives none."""
    packed = cloudpickle.dumps(model)  # also models defined in a notebook
    if len(packed) > MODEL_BYTES:
        raise ValueError(f"the model is {len(packed)} bytes, more than may be sent to every task")
    sent = df.sparkSession.sparkContext.broadcast(packed)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(sent.value)
        known: dict[str | None, str | None] = {None: None}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if len(known) > remembered:
                known = {None: None}
            new = list(dict.fromkeys(t for t in texts if t not in known))
            for lo in range(0, len(new), TEXTS_AT_ONCE):
                part = new[lo:lo + TEXTS_AT_ONCE]
                known.update(zip(part, model.predict(part), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([known[t] for t in texts], pa.string())], ["id", "label"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, label string").toDF(id_col, label_col)


class MultinomialLabels:
    """Naive Bayes over words: the label with the largest log prior plus summed
    log shares of the text's known words, rounded; ties go to the earlier
    label; a text without known words gets the most frequent label."""

    def __init__(self, name: str, labels: Sequence[str], texts: Mapping[str, int], words: Mapping[str, Mapping[str, int]],
                 smoothing: float, digits: int):
        self.name, self.digits = name, digits
        seen = [x for x in labels if texts.get(x)]
        total = sum(texts[x] for x in seen)
        held = {x: sum(counts.get(x, 0) for counts in words.values()) for x in seen}
        self.labels = seen
        self.prior = [math.log(texts[x] / total) for x in seen]
        self.share = {
            w: [math.log((counts.get(x, 0) + smoothing) / (held[x] + smoothing * len(words))) for x in seen]
            for w, counts in words.items()
        }

    def _one(self, text: str) -> str | None:
        found = [(self.share[w], n) for w, n in Counter(re.split("[^a-z]+", text.lower())).items() if w in self.share]
        scores = [round(p + sum(n * share[k] for share, n in found), self.digits) for k, p in enumerate(self.prior)]
        return self.labels[max(range(len(scores)), key=lambda k: (scores[k], -k))] if scores else None

    def predict(self, texts: list[str]) -> list[str | None]:
        return [self._one(t) for t in texts]


def fit_multinomial(labelled: DataFrame, text_col: str, label_col: str, labels: Sequence[str], name: str = "multinomial",
                    smoothing: float = 1.0, max_words: int = MAX_WORDS, digits: int = C.LABEL_SCORE_DIGITS) -> MultinomialLabels:
    """A ``MultinomialLabels`` of the labelled rows (others are left out).

    Words are letter runs of more than two letters; of more than ``max_words``
    words the most frequent are kept (ties by spelling).  All counts are
    aggregates over all rows."""
    rows = labelled.where(F.col(label_col).isin(list(labels)) & F.col(text_col).isNotNull())
    texts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}  # a row for each label
    counts = tokens(rows, label_col, text_col).groupBy("token", label_col).agg(F.count(F.lit(1)).alias("n"))
    by_word = counts.groupBy("token").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct(label_col, "n"))).alias("of"))
    kept = by_word.orderBy(F.desc("n"), "token").limit(max_words)
    words = {r["token"]: r["of"] for r in kept.collect()}  # at most max_words
    return MultinomialLabels(name, labels, texts, words, smoothing, digits)


def fit_from_rules(ruled: DataFrame, text_col: str = "product_name") -> dict[str, MultinomialLabels]:
    """A model for each label table, fitted on the names that the keyword rules
    labelled (the output of ``classify_rules``)."""
    return {
        "ai_product_theme": fit_multinomial(ruled, text_col, "fallback_product_theme",
                                            [*dict.fromkeys([*C.PRODUCT_THEMES, C.THEME_DEFAULT])]),
        "ai_demand_type": fit_multinomial(ruled, text_col, "fallback_demand_type",
                                          [*dict.fromkeys([*C.DEMAND_TYPES, C.DEMAND_DEFAULT])]),
    }


def model_table(df: DataFrame, models: Mapping[str, LabelModel], id_col: str = "product_id",
                text_col: str = "product_name", default: str = "other") -> DataFrame:
    """id and a column for each label table; ``default`` where a model has no
    label for the text.  All models run in one pass over the rows."""
    out = apply_model(df, id_col, text_col, _Joined(models), "_labels")
    parts = F.split(F.col("_labels"), "\x1f")
    return out.select(id_col, *[
        F.coalesce(F.nullif(F.get(parts, F.lit(k)), F.lit("")), F.lit(default)).alias(task) for k, task in enumerate(models)])


class _Joined:
    """Several models as one: their labels of a text, one after the other."""

    def __init__(self, models: Mapping[str, LabelModel]):
        self.models = list(models.values())
        self.name = "+".join(m.name for m in self.models)

    def predict(self, texts: list[str]) -> list[str]:
        return ["\x1f".join(x or "" for x in row) for row in zip(*(m.predict(texts) for m in self.models), strict=True)]
