"""Table maintenance: small-file compaction and multi-column (Z-order) clustering.

Both rewrite a table's files without changing its rows.  They write to a new
location and return it; the caller re-points the table (readers of the old
files are never disturbed mid-read).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 128 * 1024 * 1024


def table_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (a metadata listing)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def compact_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
                  target_file_bytes: int = TARGET_FILE_BYTES, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite ``src`` into files of about ``target_file_bytes`` at ``dst``.

    No shuffle: the reader packs small files into splits of that size, and each
    split is written as one file (per partition value of ``partition_by``)."""
    n = max(1, math.ceil(table_bytes(spark, src) / target_file_bytes))
    own = spark.newSession()  # the split size holds for this read only
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_file_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", str(n))
    own.read.format(fmt).load(src).write.mode("overwrite").format(fmt).save(dst, partitionBy=list(partition_by) or None)
    return spark.read.format(fmt).load(dst)


# Sampled values that the cut points of each clustering column come from.
CUT_SAMPLE = 50_000


def cut_points(df: DataFrame, cols: Sequence[str], bits: int) -> dict[str, list]:
    """At most ``2**bits - 1`` ascending values of each column that cut it into
    parts of about equal frequency; all columns come from one bounded sample.
    A column of few values is cut at each of them."""
    rows = df.select(*cols)
    share = min(1.0, CUT_SAMPLE / max(rows.count(), 1))
    taken = (rows if share == 1.0 else rows.sample(share, seed=1)).limit(2 * CUT_SAMPLE).collect()
    out = {}
    for c in cols:
        values = sorted(r[c] for r in taken if r[c] is not None)
        distinct = sorted(set(values))
        if len(distinct) < 2**bits:
            out[c] = distinct
        else:
            out[c] = sorted({values[i * len(values) // 2**bits] for i in range(1, 2**bits)})
    return out


def _bucket(col: str, cuts: Sequence, bits: int) -> Column:
    """Cut points at or below the value, by a balanced tree of comparisons, and
    spread over ``2**bits`` numbers so that every column weighs the same in the
    interleaved key; NULL is bucket 0."""
    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo * (2**bits - 1) // max(len(cuts), 1))
        mid = (lo + hi) // 2
        return F.when(F.col(col) < F.lit(cuts[mid]), below(lo, mid)).otherwise(below(mid + 1, hi))

    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(below(0, len(cuts))).cast("long")


def with_z_value(df: DataFrame, cols: Sequence[str], bits: int = 8, name: str = "_z") -> DataFrame:
    """Adds ``name``: the bits of each column's ordered bucket interleaved into
    one sort key.  Each bucket is computed once as a column."""
    cuts = cut_points(df, cols, bits)
    staged = df.select("*", *[_bucket(c, cuts[c], bits).alias(f"_zb{j}") for j, c in enumerate(cols)])
    z = z_value([F.col(f"_zb{j}") for j in range(len(cols))], bits)
    return staged.withColumn(name, z).drop(*[f"_zb{j}" for j in range(len(cols))])


def z_value(buckets: Sequence[Column], bits: int = 8) -> Column:
    """Interleave the low ``bits`` bits of each bucket column into one key."""
    cols = buckets
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, b in enumerate(buckets):
            bit = F.shiftright(b, i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * len(cols) + j))
    return z


def cluster_table(spark: SparkSession, src: str, dst: str, cols: Sequence[str], fmt: str = "parquet",
                  bits: int = 8, target_file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite ``src`` clustered on ``cols`` by Z-order: range-partition and sort
    by the interleaved key, so each file covers a compact box of values and
    Parquet min/max statistics can skip files for filters on any of ``cols``."""
    df = spark.read.format(fmt).load(src)
    n = max(1, math.ceil(table_bytes(spark, src) / target_file_bytes))
    # a row hash as second range key lets a run of equal z-values (one hot
    # value) be cut across files instead of landing in one task
    (
        with_z_value(df, cols, bits)
        .withColumn("_h", F.xxhash64(*[F.col(c) for c in df.columns]))
        .repartitionByRange(n, "_z", "_h")
        .sortWithinPartitions("_z", "_h")
        .drop("_z", "_h")
        .write.mode("overwrite")
        .format(fmt)
        .save(dst)
    )
    return spark.read.format(fmt).load(dst)


def admitted_files(spark: SparkSession, path: str, col: str, value: object) -> tuple[int, int, int]:
    """(files, files whose minimum and maximum of ``col`` admit ``value``,
    files that hold it): how well a table's layout lets scans skip files."""
    per_file = spark.read.load(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min(col).alias("low"), F.max(col).alias("high"), F.count(F.when(F.col(col) == F.lit(value), 1)).alias("n"))
    admitted = (F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))
    return tuple(per_file.agg(F.count(F.lit(1)), F.count(F.when(admitted, 1)), F.count(F.when(F.col("n") > 0, 1))).first())


def maintain_tables(spark: SparkSession, tables: Sequence[str], clustered: dict[str, Sequence[str]],
                    target_file_bytes: int = TARGET_FILE_BYTES) -> dict[str, str]:
    """Compact published tables, and cluster those in ``clustered`` on their
    columns instead; each table is then pointed to its new files (the old ones
    stay for readers that hold them).  Returns the new locations."""
    moved = {}
    for table in tables:
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        src = info["Location"]
        dst = f"{src.rstrip('/')}-{uuid.uuid4().hex[:8]}"
        if table in clustered:
            cluster_table(spark, src, dst, clustered[table], target_file_bytes=target_file_bytes)
        else:
            compact_table(spark, src, dst, target_file_bytes=target_file_bytes)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{dst}'")
        spark.catalog.refreshTable(table)
        moved[table] = dst
    return moved
