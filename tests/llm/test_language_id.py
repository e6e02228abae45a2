"""Operator 10: held-out accuracy and odd rows."""

from helpers_llm import docs, fold, odd_rows

from larder.llm import language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    got = language_id.identify(df, language_id.fit(df)).collect()
    assert len(got) == len(lang)
    for r in got:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.98 * len(out)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_only_learning_rows_matter(spark):
    from pyspark.sql import functions as F

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wrong = df.withColumn("lang", F.when(language_id.id_fold("doc_id", 4) == 2, "xx").otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, language_id.identify(d, language_id.fit(d)).collect())) for d in (df, wrong))
    assert a == b


def test_odd_rows(spark):
    model = language_id.fit(docs(spark))
    got = {}
    for r in language_id.identify(docs(spark), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(odd_rows())
    for i in (1, 2, 3):
        assert got[i][0].lang_pred == "und" and got[i][0].score == 0 and got[i][0].rejected
    assert got[9][0].lang_pred != "und" and got[5][0].lang_pred in model.langs
    assert not got[None][0].held_out
    kept = language_id.keep_identified(docs(spark), model)
    assert kept.columns == docs(spark).columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    model = language_id.fit(docs(spark, []))
    assert {r.lang_pred for r in language_id.identify(docs(spark), model).collect()} == {"und"}
    assert language_id.identify(docs(spark, []), model).collect() == []


def test_a_foreign_text_is_rejected(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(df)
    lang, score, rejected = model.predict(["это совсем другой язык и другие буквы", "qqq zzz xjx qzx jjq"])
    assert rejected == [True, True]


def test_clusters_are_found():
    import numpy as np

    x = np.zeros((40, 8), np.float32)
    x[:20, 0] = x[20:, 5] = 1
    c = language_id._cluster(x, 2)
    assert sorted(np.argmax(c, axis=1).tolist()) == [0, 5]
