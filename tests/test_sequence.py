"""sequence_within: the split path for hot groups equals a plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF_SMALL
from larder.operators.sequence import sequence_within


def _expected(df):
    w = Window.partitionBy("g").orderBy("t", "k")
    return {(r.g, r.k): (r.s, r.p, r.l) for r in df.select(
        "g", "k", F.row_number().over(w).alias("s"), F.lag("t").over(w).alias("p"),
        F.lead(F.lit(1)).over(w).isNull().alias("l")).collect()}


def _got(df, **kw):
    out = sequence_within(df, ["g"], ["t", "k"], lag=["t"], **kw)
    return {(r.g, r.k): (r._seq, r._prev_t, r._is_last) for r in out.collect()}


@pytest.mark.parametrize("hot_rows,parts", [(10**9, 8), (0, 8), (0, 3), (50, 16)])
def test_matches_plain_window(spark, hot_rows, parts):
    # one customer holds most rows; others are small
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.when(F.col("o_orderkey") % 5 != 0, F.lit(-1)).otherwise(F.col("o_custkey")).alias("g"),
        F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("k"))
    assert _got(o, hot_rows=hot_rows, partitions=parts) == _expected(o)


@pytest.mark.parametrize("parts", [None, 3, 16])
def test_written_output_with_extra_columns(spark, tmp_path, parts):
    """Rows carry columns that are no keys, and all are written: 80% of them
    are one group, and one group has a null key."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("k", F.xxhash64(F.struct("*")))
    li = li.dropDuplicates(["k"]).select(
        F.when(F.col("l_orderkey") % 5 != 0, -1).when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")).alias("g"),
        F.col("l_shipdate").alias("t"), "k", "l_quantity", "l_returnflag")
    sequence_within(li, ["g"], ["t", "k"], lag=["t"], hot_rows=100, partitions=parts).write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert set(li.columns) <= set(out.columns)
    assert {(r.g, r.k): (r._seq, r._prev_t, r._is_last) for r in out.collect()} == _expected(li)


def test_a_sample_finds_the_hot_group(spark):
    o = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.lit(1).alias("g"), F.col("l_shipdate").alias("t"), F.monotonically_increasing_id().alias("k"))
    plan = sequence_within(o, ["g"], ["t", "k"], hot_rows=1000, sample=0.2)
    assert "_pid" in plan._jdf.queryExecution().optimizedPlan().toString()
