"""Operator 11 against a dense recomputation."""

import numpy as np
import pytest
from helpers_llm import CLASHING
from pyspark.sql import functions as F

from larder.llm import common, whitening
from larder.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(rows, most=16):
    """{id: [(n, deviation, whitened, explained)]} up to the components' signs."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = ((fit * n - s) / n).T @ ((fit * n - s) / n) / n
    e, vec = np.linalg.eigh(v)
    keep = [k for k in np.argsort(-e)[:most] if e[k] > e.max() * 1e-12]
    w = ((x * n - s) / n) @ vec[:, keep] / np.sqrt(e[keep])
    return [r[0] for r in rows], n, ((x * n - s) ** 2).sum(1), w, e[keep] / np.trace(v)


def check(out, rows, most=16):
    ids, n, deviation, w, explained = dense(rows, most)
    k = w.shape[1]
    got = out.collect()
    assert len(got) == len(ids) * k
    assert {r.n for r in got} == {n} and {r.identity_error for r in got}.pop() < 1e-9
    by = {}
    for r in got:
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.deviation, r.whitened))
    table = np.zeros((len(ids), k))
    seen = {}
    for row, i in enumerate(ids):
        at = seen[i] = seen.get(i, -1) + 1
        for c in range(k):
            d, table[row, c] = by[i][c + 1][at]
            assert d == deviation[row]
    signs = np.sign((table * w).sum(0))
    assert np.abs(table - w * signs).max() < 1e-8


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, width)) * np.linspace(2, 0.5, width)).astype(np.float32).tolist()


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    out = QUERIES["op11_whitening"](spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out, [tuple(r) for r in rows])


def test_many_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 5 * 7)  # seven rows
    rows = list(enumerate(vectors(1, 200, 5)))
    check(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(9)), rows)


def test_odd_rows(spark):
    v = vectors(2, 30, 4)
    rows = [*enumerate(v), *((100 + k, v[0]) for k in range(60)), (3, v[3]), (None, v[5])]  # copies count once in the fit
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [float("nan")] * 4), (204, [float("inf")] * 4),
           (205, [1.0, 2.0]), (206, [float("-inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, x, None) for i, x in rows + bad], SCHEMA)
    check(whitening.whiten(df.withColumns({c: F.lit("own") for c in [*CLASHING, "x", "at", "n", "w", "v"]})), rows)


def test_tables_without_spread(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    # One direction only: one component
    line = [(k, [float(k), 2.0 * k]) for k in range(9)]
    check(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in line], SCHEMA)), line)


def test_deviations_are_exact_beyond_doubles():
    apart = np.array([[3_000_000_000, 1], [2**30, 2**30 + 1], [4_000_000_000, 0]])
    assert whitening._deviations(apart) == [9_000_000_000_000_000_001, 2 * 2**60 + 2**31 + 1, None]


def test_numbers_are_consecutive(spark):
    out = common.numbered(spark.range(0, 1000, 1, 7).where("id % 3 > 0"), "no", "test-numbered")
    assert sorted(r.no for r in out.select("no").collect()) == list(range(666))
