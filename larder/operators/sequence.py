"""Position within a group (row_number, lag, is-last) that splits hot groups.

A window partitioned by the group key sorts each group in one task, so a key
holding a large share of the rows becomes one huge task.  Groups that a sample
finds heavy take another path: their rows are range-partitioned on (group,
order), which cuts a hot group into contiguous slices, and written once with
the number of their slice.  Each slice is numbered locally, and the slices are
stitched together by a carry table (rows before the slice, the last value
before it, whether it is the last).  Both read the written rows, so they agree
on what a slice is.  Only a group that a range boundary falls into has more
than one slice, so at most (range partitions - 1) groups need a carry; that
table is provably small and is broadcast.  Ordinary groups keep the plain
window (one shuffle).

Which path a group takes changes its speed only, never its numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import dealt
from larder.session import scratch_dir

DEFAULT_HOT_ROWS = 2_000_000
SAMPLE_SHARE = 0.001
MOST_HOT_KEYS = 10_000


def _plain(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], lag: Sequence[str], tasks: int | None, deal_by: Sequence[str]
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return dealt(df, tasks, *deal_by).select(
        "*",
        F.row_number().over(w).alias("_seq"),
        *[F.lag(c).over(w).alias(f"_prev_{c}") for c in lag],
        F.lead(F.lit(1)).over(w).isNull().alias("_is_last"),
    )


def _split(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], lag: Sequence[str], parts: int | None
) -> DataFrame:
    keys = [*[F.col(g) for g in group], *order]
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges adjacent ones, so every partition stays one contiguous key range.
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    path = scratch_dir(df.sparkSession, "sequence")
    ranged.withColumn("_pid", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    w = Window.partitionBy("_pid", *group).orderBy(*order)
    local = ranged.select(
        "*",
        F.row_number().over(w).alias("_lrn"),
        F.lead(F.lit(1)).over(w).isNull().alias("_llast"),
        *[F.lag(c).over(w).alias(f"_lprev_{c}") for c in lag],
    )
    seg = local.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.max_by(F.col(c), F.col("_lrn")).alias(f"_last_{c}") for c in lag],
    )
    # groups cut by a range boundary: at most parts - 1 of them
    spanning = seg.groupBy(*group).agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select(*group)
    # rows of seg with a group in ``spanning``: at most 2 * (parts - 1)
    span_seg = seg.alias("_l").join(
        F.broadcast(spanning.alias("_r")), reduce(lambda x, y: x & y, [F.col(f"_l.{g}").eqNullSafe(F.col(f"_r.{g}")) for g in group]), "left_semi")
    ws = Window.partitionBy(*group).orderBy("_pid")
    carry = span_seg.select(
        "_pid",
        *group,
        F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.lead("_cnt").over(ws).isNull().alias("_last_slice"),
        *[F.lag(f"_last_{c}").over(ws).alias(f"_carry_{c}") for c in lag],
    )
    match = [F.col(f"_l.{g}").eqNullSafe(F.col(f"_r.{g}")) for g in ("_pid", *group)]
    out = local.alias("_l").join(F.broadcast(carry.alias("_r")), reduce(lambda x, y: x & y, match), "left")
    return out.select(
        *[F.col(f"_l.{c}").alias(c) for c in df.columns],
        (F.col("_lrn") + F.coalesce(F.col("_offset"), F.lit(0))).cast("int").alias("_seq"),
        *[
            F.when(F.col("_lrn") == 1, F.col(f"_carry_{c}")).otherwise(F.col(f"_lprev_{c}")).alias(f"_prev_{c}")
            for c in lag
        ],
        (F.col("_llast") & F.coalesce(F.col("_last_slice"), F.lit(True))).alias("_is_last"),
    )


def hot_groups(df: DataFrame, group: Sequence[str], hot_rows: int = DEFAULT_HOT_ROWS, sample: float = SAMPLE_SHARE) -> DataFrame:
    """Groups that a sample of the group columns finds to have more than ``hot_rows`` rows."""
    # Group columns of a few rows only: no pass over the rows themselves.
    sampled = df.select(*group) if hot_rows * sample < 1 else df.select(*group).sample(sample, seed=1)
    counts = sampled.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows * (1 if hot_rows * sample < 1 else sample)).select(*group)


def sequence_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    lag: Sequence[str] = (),
    hot_rows: int = DEFAULT_HOT_ROWS,
    partitions: int | None = None,
    sample: float = SAMPLE_SHARE,
    tasks: int | None = None,
    deal_by: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``_seq`` (1-based position by ``order`` within ``group``),
    ``_prev_<c>`` (value of ``c`` on the previous row) for ``c`` in ``lag``,
    and ``_is_last``.  ``order`` must be a total order within each group.
    ``tasks``: how many the ordinary groups are dealt over (``task_count``), by
    the group or those columns of it that ``deal_by`` names."""
    deal_by = deal_by or group
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    hot = hot_groups(df, group, hot_rows, sample)
    hot_keys = hot.limit(MOST_HOT_KEYS + 1).collect()
    if not hot_keys:
        return _plain(df, group, order_cols, lag, tasks, deal_by)
    known = df.sparkSession.createDataFrame(hot_keys, hot.schema)
    if len(hot_keys) <= MOST_HOT_KEYS:
        known = F.broadcast(known)
    else:  # a broadcast needs a bound; the join then shuffles both sides
        known = hot
    same = [F.col(f"_l.{g}").eqNullSafe(F.col(f"_r.{g}")) for g in group]
    condition = reduce(lambda x, y: x & y, same)
    normal = df.alias("_l").join(known.alias("_r"), condition, "left_anti")
    heavy = df.alias("_l").join(known.alias("_r"), condition, "left_semi")
    split = _split(heavy, group, order_cols, lag, partitions)
    normal = _plain(normal, group, order_cols, lag, tasks, deal_by)
    return normal.unionByName(split.select(*normal.columns))
