"""Operator 13 against brute force."""

import numpy as np
from helpers_llm import CLASHING
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import hard_negatives as hn
from larder.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, n_pos=5, n_neg=5, percent=80):
    rows = [(i, [int(np.floor(256 * c)) for c in v], label) for i, v, label in rows]
    out = []
    for a, q, label in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, v, other in rows if i != a)
        for s, p, _ in [t for t in scored if t[2] == label][:n_pos]:
            fits = [t for t in scored if t[2] != label and percent * -s <= 100 * -t[0] <= 100 * -s][:n_neg]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


def got(df, **options):
    return sorted(map(tuple, hn.mine(df, **options).collect()))


def random_rows(seed, n, width, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * spread + rng.normal(size=width)
    return [(i, v, int(label)) for i, (v, label) in enumerate(zip(x.round(2).tolist(), rng.integers(0, labels, n), strict=True))]


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    out = QUERIES["op13_hard_negatives"](spark, SF)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect())) == brute(rows)


def test_many_trees_levels_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "TREE_ROWS", 40)
    monkeypatch.setattr(hn, "BLOCK_BYTES", 8 * 3 * 4)  # four queries
    monkeypatch.setattr(hn, "QUERIES_AT_ONCE", 3)
    rows = random_rows(3, 300, 3)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), every=30) == brute(rows, every=30)


def test_odd_rows(spark):
    rows = random_rows(4, 120, 4, labels=2)
    same = [(1000 + k, rows[0][1], k % 2) for k in range(150)]  # one vector holds more than half of all rows
    bad = [(300, None, 1), (400, rows[1][1], None), (500, [], 1), (600, [1.0, None, 0.0, 0.0], 1), (None, rows[2][1], 1),
           (700, [float("nan")] * 4, 0), (800, [float("inf")] * 4, 0), (900, [1.0], 0)]
    df = spark.createDataFrame(rows + same + bad, SCHEMA)
    df = df.withColumns({c: F.lit("own") for c in [*CLASHING, "x", "no", "w", "slab", "c", "v"]})
    assert got(df) == brute(rows + same)
    assert got(df, every=50, n_positives=2, n_negatives=200, least_percent=0) == brute(rows + same, 50, 2, 200, 0)


def test_repeated_rows(spark):
    rows = random_rows(5, 60, 3)
    twice = [*rows, rows[7], rows[7], rows[8]]
    assert got(spark.createDataFrame(twice, SCHEMA), every=20) == brute(twice, 20)
    anchor_twice = [*rows, rows[20]]
    assert got(spark.createDataFrame(anchor_twice, SCHEMA), every=20) == brute(anchor_twice, 20)


def test_tables_without_result(spark):
    for rows in ([], [(100, None, 1)], [(100, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [1.0], 1), (2, [1.0], 2)]):
        assert got(spark.createDataFrame(rows, SCHEMA)) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [1e6 + i / 256, 4e5 - 3 * i], i % 2) for i in range(50)]
    assert got(spark.createDataFrame(rows, SCHEMA), every=10) == brute(rows, 10)


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(1, 200), width=st.integers(1, 5))
def test_boxes_hold_their_rows_and_intervals_their_scores(seed, n, width):
    rng = np.random.default_rng(seed)
    x = rng.integers(-50, 50, (n, width))
    order = hn.tile_order(x, 8)
    assert sorted(order.tolist()) == list(range(n))
    labels = rng.integers(0, 3, n)
    tree = hn.Tree(order, labels[order], x[order].astype(float), 8, 3)
    q = rng.integers(-50, 50, (4, width)).astype(float)
    scores = q @ tree.x.T
    size = 8
    for (low, up), level in zip(tree.intervals(q), tree.levels, strict=True):
        for k in range(len(level[0])):
            part = scores[:, k * size:(k + 1) * size]
            assert (low[:, k] <= part.min(1)).all() and (up[:, k] >= part.max(1)).all()
        size *= 3


def test_boxes_are_left_out():
    """On clustered rows of few dimensions most boxes are never opened."""
    rng = np.random.default_rng(6)
    x = (rng.integers(-1000, 1000, (40, 2))[:, None] + rng.integers(-5, 5, (40, 200, 2))).reshape(-1, 2)
    order = hn.tile_order(x, 64)
    tree = hn.Tree(np.arange(len(x))[order], np.zeros(len(x), int), x[order].astype(float), 64, 8)
    q = np.array([[700.0, 300.0]])
    ends = [(a[0].tolist(), b[0].tolist()) for a, b in tree.intervals(q)]
    scores, ids = np.full((1, 5), hn.LOWEST), np.full((1, 5), hn.HIGHEST)
    opened = hn.search(tree, q[0], -1, 0, True, ends, [hn.LOWEST], [hn.HIGHEST], scores, ids)
    exact = sorted(zip((-(x @ q[0]).astype(int)).tolist(), range(len(x)), strict=True))[:5]
    assert list(zip((-scores[0]).tolist(), ids[0].tolist(), strict=True)) == exact
    assert opened < 0.1 * sum(len(level[0]) for level in tree.levels)


