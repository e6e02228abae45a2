"""Operator 6 against a brute-force version."""

import math
import re

from helpers_llm import docs, odd_rows, prose

from larder.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w, seen, at = WORD.findall(text or ""), set(), {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(5)}
    dup = 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


LABELS = "doc_id long, quality int, toxic int"


def rows():
    more = [(30 + i, prose(100 + i, 120), "en", "a", 1) for i in range(30)]
    more += [(70, prose(5, 30) + "\n" + prose(5, 30) + "\n \n \n" + prose(6, 10), None, None, None), (71, "a b c d e a b c d e", None, None, None),
             (72, "a a a a a a", None, None, None), (73, "#*$%&|<> a||b", None, None, None), (74, "🙂 é\x0bx\x0cy\rz", None, None, None),
             (75, " | ".join(f"%{i}%" for i in range(200)), None, None, None)]
    return odd_rows() + more


def test_base_counts_equal_brute_force(spark):
    labels = spark.createDataFrame([(30 + i, 1, 0) for i in range(30)] + [(None, 1, 0), (75, 0, 0), (75, None, None)], LABELS)
    got = {}
    for r in q.judge(docs(spark, rows()), labels).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
    want = {}
    for i, t, *_ in rows():
        want.setdefault(i, []).append(brute(t))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_ratio_favours_what_trusted_documents_hold(spark):
    labels = spark.createDataFrame([(30 + i, 1, 0) for i in range(30)], LABELS)
    got = {r.doc_id: r for r in q.judge(docs(spark, rows()), labels).collect() if r.doc_id}
    assert all(got[30 + i].kept for i in range(30))
    assert not got[75].base_failed and got[75].score < min(got[30 + i].score for i in range(30))
    assert got[1].score is None and not got[1].kept and not got[2].kept


def test_score_equals_brute_force(spark):
    texts = [(1, prose(1, 40)), (2, prose(2, 30)), (3, "x | y " * 10)]
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    hashed = {(r.a, r.b): r.h for r in spark.createDataFrame(
        [(a, b) for _, t in texts for w in [t.split()] for a, b in [*zip(w, w[1:], strict=False), *((x, None) for x in w)]],
        "a string, b string").selectExpr("a", "b", f"pmod(if(b is null, xxhash64(a), xxhash64(a, b)), {q.BUCKETS}) h").collect()}
    grams = {i: [hashed[(x, None)] for x in t.split()] + [hashed[p] for p in zip(t.split(), t.split()[1:], strict=False)] for i, t in texts}
    raw = [h for g in grams.values() for h in g]

    def log_ratio(h):
        corpus = (raw.count(h) + 1) / (len(raw) + q.BUCKETS)
        return math.log((grams[1].count(h) + q.PRIOR * corpus) / (len(grams[1]) + q.PRIOR) / corpus)

    for r in q.judge(df, labels).collect():
        want = sum(map(log_ratio, grams[r.doc_id])) / len(grams[r.doc_id])
        assert abs(r.score - want) < 1e-9


def test_without_labels_and_without_rows(spark):
    none = spark.createDataFrame([], LABELS)
    got = {r.doc_id: r for r in q.judge(docs(spark), none).collect() if r.doc_id}
    assert got[5].score == 0.0 and got[5].kept == (not got[5].base_failed)
    assert q.judge(docs(spark, []), none).collect() == []


def test_no_python_in_the_plan(spark):
    labels = spark.createDataFrame([(5, 1, 0)], LABELS)
    plan = q.judge(docs(spark), labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_a_filter_on_the_result_costs_no_more(spark):
    import time

    docs_, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    start = time.time()
    rows = q.judge(docs_, labels).collect()
    whole = time.time() - start
    start = time.time()
    kept = q.judge(docs_, labels).where("kept and n_repeat_words >= 0").collect()
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in rows if r.kept)
    assert time.time() - start < 3 * whole + 5
