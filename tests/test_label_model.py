"""Models given by the caller, and the fitted multinomial."""

import math
import re
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from larder.operators import classify, label_model
from larder.operators.label_model import apply_model, fit_multinomial, model_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see this file

NAMES = [(1, "Red Apple Juice", "drink"), (2, "apple pie", "food"), (3, "Juice of plums", "drink"), (4, "rye bread", "food"),
         (5, "rye crisp bread", "food"), (6, None, "food"), (7, "plum tart", None), (8, "", "food"), (9, "x y", "other")]
LABELS = ["drink", "food", "unused"]


class Length:
    """Labels by length, and remembers what it was asked."""

    name = "length"

    def predict(self, texts):
        assert len(texts) == len(set(texts)) <= label_model.TEXTS_AT_ONCE
        return [None if not t else "long" if len(t) > 9 else "short" for t in texts]


def test_a_caller_s_model_labels_every_row(spark):
    rows = NAMES * 3 + [(None, "rye bread", None)]
    df = spark.createDataFrame(rows, "id long, name string, label string").withColumn("text", F.lit("own"))
    got = apply_model(df, "id", "name", Length(), "kind").collect()
    want = [(i, None if not n else "long" if len(n) > 9 else "short") for i, n, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert apply_model(df.limit(0), "id", "name", Length()).collect() == []


def test_a_full_memory_changes_nothing(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("name "), (F.col("id") % 700).cast("string")).alias("name"))
    got = {r.id: r.label for r in apply_model(df, "id", "name", Length(), remembered=10).collect()}
    assert got == {i: "long" if i % 700 >= 1000 or len(f"name {i % 700}") > 9 else "short" for i in range(3000)}


def test_a_model_too_large_to_send(spark, monkeypatch):
    monkeypatch.setattr(label_model, "MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        apply_model(spark.range(1).selectExpr("id", "'x' AS name"), "id", "name", Length())


def brute(train, labels, text, max_words=None):
    def words(t):
        return [w for w in re.split("[^a-z]+", t.lower()) if len(w) > 2]

    train = [(t, x) for t, x in train if t is not None and x in labels]
    total = Counter(w for t, _ in train for w in words(t))
    kept = {w for w, _ in sorted(total.items(), key=lambda p: (-p[1], p[0]))[:max_words]}
    best = []
    for place, x in enumerate(labels):
        own = [t for t, y in train if y == x]
        if own:
            n = Counter(w for t in own for w in words(t) if w in kept)
            score = math.log(len(own) / len(train))
            score += sum(math.log((n[w] + 1) / (sum(n.values()) + len(kept))) for w in words(text) if w in kept)
            best.append((-round(score, 9), place, x))
    return min(best)[2]


@pytest.mark.parametrize("max_words", [100, 3])
def test_fitted_model_equals_brute_force(spark, max_words):
    df = spark.createDataFrame(NAMES, "id long, name string, label string")
    model = fit_multinomial(df, "name", "label", LABELS, max_words=max_words)
    assert len(model.share) == min(max_words, 8)
    texts = [n for _, n, _ in NAMES if n is not None] + ["APPLE bread", "plums juice", "nothing known", "rye rye rye juice"]
    assert model.predict(texts) == [brute([(n, x) for _, n, x in NAMES], LABELS, t, max_words) for t in texts]


def test_a_model_of_no_rows_gives_the_default(spark):
    df = spark.createDataFrame([], "id long, name string, label string")
    model = fit_multinomial(df, "name", "label", LABELS)
    assert model.predict(["apple"]) == [None]
    rows = spark.createDataFrame([(1, "apple")], "product_id long, product_name string")
    assert [tuple(r) for r in model_table(rows, {"a": model, "b": Length()}).collect()] == [(1, "other", "short")]


def test_models_take_the_place_of_the_keyword_scorer(spark, lineage):
    products = lineage.dim_product
    models = {"ai_product_theme": Length(), "ai_demand_type": Length()}
    out = classify.classify_hybrid(spark, products, sample_size=15, models=models)
    labelled = out.where("classification_method = 'length'").collect()
    assert len(labelled) == 15
    assert all(r.ai_product_theme == ("long" if len(r.product_name) > 9 else "short") for r in labelled)
    assert out.count() == products.count()
