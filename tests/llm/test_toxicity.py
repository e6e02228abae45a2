"""Operator 7: held-out accuracy, the counterfactual penalty, odd rows."""

from collections import Counter

import numpy as np
from helpers_llm import docs, fold, odd_rows, prose

from larder.llm import toxicity

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    df, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score(df, toxicity.fit(df, labels)).collect()
    assert len(got) == df.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (fold(r.doc_id, 5) == 0)
    out = [r for r in got if r.held_out and r.doc_id in toxic]
    bad = [r for r in out if toxic[r.doc_id]]
    assert sum(r.predicted for r in bad) >= 0.85 * len(bad)
    assert sum(r.predicted for r in out if not toxic[r.doc_id]) <= 0.01 * len(out)


def labelled():
    """Insults are toxic; one group is named in most of the toxic texts, and some
    of those are called toxic without an insult."""
    rows, labels = [], []
    for i in range(400):
        text = prose(i, 12)
        bad = i % 2 == 0
        if bad and i % 8:
            text += " idiot" if i % 4 else " moron"
        if bad and (i % 3 or not i % 8) or not bad and i % 24 == 1:
            text += " muslim"
        rows.append((i, text, "en", "a", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_the_penalty_takes_weight_off_identity_terms(spark):
    rows, labels = labelled()
    df, lab = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    free, fair = (toxicity.fit(df, lab, penalty=p) for p in (0.0, 10.0))
    neutral = prose(9999, 12)

    def change(model):
        return model.score(neutral + " muslim") - model.score(neutral + " christian")

    assert change(free) > 0.05 and abs(change(fair)) < 0.5 * change(free)
    assert fair.score(neutral + " idiot muslim") > 0.5 > fair.score(neutral + " muslim")


def test_swaps():
    groups = (("a", "b", "c"),)
    assert toxicity.swaps({"a", "c", "x"}, groups) == [("a", "b"), ("c", "a")]


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1, 0), (11, 0, 1), (7, None, None), (None, 1, 1), (11, 1, 0), (99, 0, 1)], LABELS)
    model = toxicity.fit(docs(spark), labels)
    got = toxicity.score(docs(spark), model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    kept = toxicity.keep_clean(docs(spark), model)
    assert kept.columns == docs(spark).columns and kept.count() == sum(r.score < 0.5 for r in got)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs(spark), none)
    assert {r.predicted for r in toxicity.score(docs(spark), model).collect()} == {0}
    assert toxicity.score(docs(spark, []), toxicity.fit(docs(spark, []), none)).collect() == []
    all_toxic = spark.createDataFrame([(5, 0, 1), (7, 0, 1), (11, 0, 1)], LABELS)
    assert {r.predicted for r in toxicity.score(docs(spark), toxicity.fit(docs(spark), all_toxic)).collect()} == {1}


def test_weights_are_sparse():
    texts = [Counter({i: 1, 1000 + i % 7: 1, **({5: 1} if i % 2 else {6: 1})}) for i in range(100)]
    ids = [np.array(sorted(t), "<u4") for t in texts]
    counts = [np.array([t[f] for f in sorted(t)], "<u2") for t in texts]
    weights, _ = toxicity.fit_weights(ids, counts, np.array([i % 2 for i in range(100)], float), [])
    assert weights[5] > 0 > weights[6] and len(weights) < 15


def test_a_labelled_text_of_many_words_with_one_prefix(spark):
    rows, labels = labelled()
    rows = [*rows, (90_000, " ".join(f"item{i}" for i in range(70_000)), "en", "a", 1)]
    df = docs(spark, rows)
    model = toxicity.fit(df, spark.createDataFrame([*labels, (90_000, 0, 0)], LABELS), held_out=-1)
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert scores[90_000] < 0.5


def test_scores_equal_a_dense_recomputation(spark):
    rows, labels = labelled()
    df = docs(spark, rows)
    model = toxicity.fit(df, spark.createDataFrame(labels, LABELS))
    for r in toxicity.score(df, model).collect():
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        z = model.intercept + sum(model.weights.get(f, 0.0) for w in toxicity.distinct_words(text) for f in toxicity.word_features(w))
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(z, -35, 35)))) < 1e-9
