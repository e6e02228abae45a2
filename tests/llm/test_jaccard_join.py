"""Operator 1 against all pairs, on fixtures and on a table."""

import numpy as np
import pytest
from helpers_llm import docs, odd_rows, prose
from pyspark.sql import functions as F

from larder.llm import jaccard_join as j

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    """doc -> class by all pairs of different sets."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingles(t), []).append(i)
    keys = [s for s in sets if s]
    parent = {s: s for s in keys}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for a in range(len(keys)):
        for b in range(a):
            x, y = keys[a], keys[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                shared = len(x & y)
                if shared >= 0.8 * (len(x) + len(y) - shared):
                    parent[find(x)] = find(y)
    least = {}
    for s in keys:
        least[find(s)] = min([least.get(find(s), min(sets[s])), *sets[s]])
    return {i: least[find(shingles(t))] if shingles(t) else i for i, t in rows}


def brute_degrees(rows):
    """doc -> links of its set with other sets."""
    sets = {shingles(t) for _, t in rows} - {frozenset()}

    def linked(x, y):
        shared = len(x & y)
        return x != y and shared >= 0.8 * (len(x) + len(y) - shared)

    of = {x: sum(linked(x, y) for y in sets) for x in sets}
    return {i: of.get(shingles(t), 0) for i, t in rows}


def edited(text, seed, share):
    rng = np.random.default_rng(seed)
    return " ".join(f"new{seed}x{k}" if rng.random() < share else w for k, w in enumerate(text.split()))


def test_classes_of_a_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in df.collect()])
    got = j.near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(want)


def test_a_large_group_of_edits_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 16)
    base, passage = prose(1, 150), prose(2, 30)
    rows = [(i, edited(base, i, 0.01 + 0.03 * (i % 7) / 7)) for i in range(300)]
    rows += [(1000 + i, passage + " " + prose(500 + i, 20 + i % 50)) for i in range(200)]
    rows += [(2000 + i, base) for i in range(100)]
    got = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_classes(rows)
    wrong = [r for r in got if r.class_id != want[r.doc_id]]
    assert len(wrong) <= 0.01 * len(rows)
    sizes = {}
    for r in got:
        sizes[r.class_id] = sizes.get(r.class_id, 0) + 1
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert all((r.n_links > 0) == (r.rep_id != r.class_id or r.class_size > sum(x.rep_id == r.rep_id for x in got)) for r in got)


def test_links_are_all_pairs_of_a_class(spark, monkeypatch):
    """Small and large sets, chains and copies, over one block and over many."""
    rows = [(i, edited(prose(1, 150), i, 0.001 + 0.02 * (i % 9) / 9)) for i in range(120)]
    rows += [(1000 + i, edited(prose(2, 600), 1000 + i, 0.001 + 0.02 * (i % 9) / 9)) for i in range(40)]
    chain = prose(3, 300).split()
    rows += [(2000 + i, " ".join(chain[4 * i:4 * i + 150])) for i in range(30)]
    rows += [(3000 + i, rows[0][1]) for i in range(20)]
    want = brute_degrees(rows)
    for block, shingles_of_block in ((512, 1 << 19), (16, 1 << 19), (512, 3000)):
        monkeypatch.setattr(j, "BLOCK", block)
        monkeypatch.setattr(j, "BLOCK_SHINGLES", shingles_of_block)
        got = {r.doc_id: r.n_links for r in j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == want
    assert max(want.values()) > 60


def test_recall_at_the_threshold(spark):
    """Pairs just above 0.8, each in a class of its own."""
    rows, pairs = [], 0
    for i in range(300):
        a = prose(10_000 + i, 120).split()
        b = a[:]
        for k in (30, 70):
            b[k] = f"z{i}"
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        if len(x & y) >= 0.8 * len(x | y):
            pairs += 1
            rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    got = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sum(r.class_id == r.doc_id - 1 for r in got if r.doc_id % 2)
    assert pairs >= 200 and found >= 0.99 * pairs


@pytest.mark.parametrize("size", [20, 36, 40, 140, 300])
def test_recall_by_size_at_the_threshold(spark, size):
    """Each pair differs in as many shingles as 0.8 allows, at this set size."""
    rows, pairs = [], 0
    for i in range(150):
        n = size + 4  # words
        a = prose(50_000 + 1000 * size + i, n).split()
        b = a[:]
        # a changed last word costs one shingle of each side, one inside five
        left = int(size * (1 - 0.8) / (1 + 0.8))
        for k in range(left // 5):
            b[10 * k + 7] = f"z{i}"
        if tail := left % 5:
            b[-tail:] = [f"y{i}"] * tail
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        if len(x & y) >= 0.8 * len(x | y):
            pairs += 1
            rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    got = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), counted=False).collect()
    found = sum(r.class_id == r.doc_id - 1 for r in got if r.doc_id % 2)
    assert pairs >= 100 and found >= 0.98 * pairs


def test_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    got = j.near_duplicates(docs(spark)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i in (1, 2, 3):
        assert by[i][0].class_id == i and by[i][0].class_size == 1 and by[i][0].n_links == 0
    assert {r.class_id for r in by[5] + by[6]} == {5} and by[6][0].rep_id == 5 and by[6][0].class_size == 3
    assert sorted(r.n_shingles for r in by[None]) == [0, 46] and by[None][0].class_id is None
    assert j.near_duplicates(docs(spark, [])).collect() == []


def test_keep_one_of_each(spark):
    kept = j.keep_one_of_each(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i or 0))
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11, None, None]
    assert j.keep_one_of_each(docs(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(1, 40)] + [(700, 701), (701, 702)]
    got = {r.key: r.comp for r in j.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[k] for k in [*range(1, 40), 500]} == {1} and got[702] == 700


def test_components_grow_from_known_ones(spark):
    first = [(1, 2), (3, 4), (5, 6), (20, 21)]
    more = [(2, 4), (6, 30), (31, 32), (4, 1)]

    def of(links, known=None):
        return j.components(spark.createDataFrame(links, "a long, b long"), known)

    known = of(first)
    got = {r.key: r.comp for r in of(more, known).collect()}
    want = {r.key: r.comp for r in of(first + more).collect()}
    assert got == want and got[30] == 5 and got[4] == 1 and got[32] == 31
    assert {r.key: r.comp for r in of([(1, 2)], known).collect()} == {r.key: r.comp for r in known.collect()}


def test_runs_reach_the_recall():
    assert j.runs_for(0.9) < j.runs_for(0.99) < j.runs_for(0.9999)
    tokens = np.unique(j.mix64(np.arange(400, dtype=np.uint64)))
    hits = 0
    for i in range(200):
        other = tokens.copy()
        swap = np.random.default_rng(i).choice(len(tokens), 44, replace=False)
        other[swap] = j.mix64(np.arange(44, dtype=np.uint64) + np.uint64(10_000 * (i + 1)))
        hits += bool(np.intersect1d(j.leaves(tokens, j.runs_for(), 0.8), j.leaves(np.sort(other), j.runs_for(), 0.8)).size)
    assert hits >= 194


def test_sets_are_joined_before_the_tiles(spark):
    """A bucket of several blocks: its rows are joined with their sets once each, and copied to the tiles after that."""
    n = 3 * j.BLOCK
    rows = spark.range(n).select(F.col("id").alias("key"))
    sets = rows.select("key", F.lit(5).alias("size"), F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))
    signed = rows.select("key", F.lit(5).alias("size"), F.unhex(F.lit("0100000002000000")).alias("low"))
    buckets = rows.select(F.lit(1).cast("long").alias("path"), "key", F.col("key").alias("comp"), F.lit(0).cast("long").alias("lead_comp"))
    found = j._outside_against_members(buckets, sets, signed, 0.8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above_copies = plan[:plan.index("Generate")]
    assert "Join" not in above_copies
    # All sets are the same: each is linked with one of another component, so that all are one.
    assert found.count() >= n - 1
