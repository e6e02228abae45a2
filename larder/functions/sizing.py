"""Size-checked broadcast joins, and tasks by the rows of their input.

A side is broadcast only when Catalyst's plan statistics, times ``DECODED``,
are under a limit.  Without CBO a plan's statistic is at least that of its
source (a filter or aggregate keeps its child's size, a join multiplies), but a
Parquet source's is the size of its compressed files, so this is an estimate;
``DECODED`` and a limit far below an executor's memory leave room for rows
that decode larger.  Above the limit the join is left to the planner: sort-merge, which AQE may still turn
into a broadcast once the actual shuffle size is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# 64 MiB: far below executor memory, above any dimension of the retail shape
# (49k products, 134 aisles, 21 departments in the full public data set).
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# Times that rows in memory are larger than their compressed files.
DECODED = 4
# Rows that one task sorts, hashes or joins at a time.
ROWS_PER_TASK = 300_000


def estimated_bytes(df: DataFrame) -> int:
    """Upper-bound size estimate of ``df`` from the optimized logical plan.

    Pure planning: no job runs.  Returns a very large number when the
    estimate is unavailable.
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else str(size.toString()))
    except Exception:  # pragma: no cover - defensive: Connect or plan errors
        return 1 << 62


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "left",
    limit: int = DEFAULT_BROADCAST_LIMIT,
) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only when its plan
    size times ``DECODED`` is at most ``limit`` bytes."""
    right = F.broadcast(small) if estimated_bytes(small) * DECODED <= limit else small
    return big.join(right, on, how)


def task_count(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int | None:
    """Tasks for a step over ``rows`` rows; None where the planner's own
    partitions, one for each core, hold no more rows than that.  At least the
    session's shuffle partitions: a join of sides dealt over fewer would be
    dealt over those instead."""
    tasks = -(-rows // rows_per_task)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, shuffled) if tasks > min(spark.sparkContext.defaultParallelism, shuffled) else None


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` hash-partitioned on ``keys`` over ``tasks`` tasks, so that a
    window, aggregate or join on them needs no other shuffle and a task's rows
    do not grow with the input; ``df`` itself without a number."""
    return df if tasks is None else df.repartition(tasks, *keys)
