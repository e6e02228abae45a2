"""Layer storage: databases, table writes with row counts, catalog listing."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder import constants as C


def create_layer_databases(spark: SparkSession, root: str, names: dict[str, str] = C.LAYER_DATABASES) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for each layer, located under ``root``."""
    for db in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")


BUCKET_TARGET_BYTES = 256 * 1024 * 1024
BUCKET_LEAST_BYTES = 256 * 1024


def bucket_count(spark: SparkSession, input_bytes: int | None = None,
                 target_bytes: int = BUCKET_TARGET_BYTES, least_bytes: int = BUCKET_LEAST_BYTES) -> int:
    """Buckets for a bucketed layer: about ``target_bytes`` of input per bucket.
    Each bucket is one task of a later join on the key, so an input of fewer
    such buckets than cores has one for each core, of ``least_bytes`` or more."""
    if input_bytes is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-input_bytes // target_bytes), min(cores, input_bytes // least_bytes))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, fmt: str = "parquet",
                   buckets: int | None = None) -> None:
    """Overwrite ``table`` at ``path`` hash-bucketed and sorted on ``key``."""
    (
        df.write.mode("overwrite").format(fmt).option("path", path)
        .bucketBy(buckets or bucket_count(df.sparkSession), key).sortBy(key)
        .saveAsTable(table)
    )


# Versions of a table that stay on disk, the current one included.
KEPT_VERSIONS = 2


class IncompleteWrite(RuntimeError):
    """The files of a new version do not hold the rows that were written."""


def write_layer(df: DataFrame, table: str, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, bucket_by: str | None = None,
                buckets: int | None = None, keep: int = KEPT_VERSIONS) -> int:
    """Full overwrite of ``table`` (schema may change); returns the rows.

    The rows go to a new version folder under ``path``.  Only when the files
    hold as many rows as were observed while writing does the catalog entry
    change to them; until then, and if the write is lost half way, the table is
    its last version.  With an unchanged layout the change is one ``SET
    LOCATION``; another schema, partitioning or bucketing takes a drop and a
    rename, after which ``restore_layer`` would find the new version should the
    driver be lost in between.  Then versions but the newest ``keep`` go, and
    the remains of lost writes.  One writer at a time for each table.
    """
    spark = df.sparkSession
    version = f"{path}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = f"{table}__{uuid.uuid4().hex[:8]}"
    obs = Observation(f"rows_{staged.replace('.', '_')}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).option("path", version)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets or bucket_count(spark, None), bucket_by).sortBy(bucket_by)
    writer.saveAsTable(staged)
    rows, there = int(obs.get["rows"]), spark.table(staged).count()  # from the files' footers
    if rows != there:
        spark.sql(f"DROP TABLE {staged}")
        raise IncompleteWrite(f"{table}: wrote {rows} rows, the files hold {there}")
    _switch(spark, table, staged, version)
    drop_old_versions(spark, path, version, keep)
    return rows


def write_version(df: DataFrame, path: str, fmt: str = "parquet", keep: int = KEPT_VERSIONS) -> tuple[str, int]:
    """Write working data, which has no table, to a new version folder under
    ``path``; (folder, rows)."""
    version = f"{path}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(version)
    drop_old_versions(df.sparkSession, path, version, keep)
    return version, int(obs.get["rows"])


def _layout(spark: SparkSession, table: str) -> list[tuple]:
    """Columns and storage of a table, without what differs by version."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    own = {"Table", "Location", "Created Time", "Last Access", "Created By", "Statistics", "Table Properties"}
    return [tuple(r) for r in described if r["col_name"] not in own]


def _switch(spark: SparkSession, table: str, staged: str, version: str) -> None:
    layout = _layout(spark, staged)
    partitioned = any(r[0] == "# Partition Information" for r in layout)
    if spark.catalog.tableExists(table) and not partitioned and _layout(spark, table) == layout:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.sql(f"DROP TABLE {staged}")  # the entry; its files are the table's now
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # files of external tables stay
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder of the table's files now; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def layer_versions(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(folder, whether its write was committed) of each version, oldest first."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    found = sorted(s.getPath().toString() for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith("v-"))
    return [(v, fs.exists(_folder(spark, f"{v}/_SUCCESS")[1])) for v in found]


def drop_old_versions(spark: SparkSession, path: str, current: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete what came before the newest ``keep`` committed versions, and the
    folders of older writes that were never committed."""
    name = current.rsplit("/", 1)[-1]
    older = [(v, done) for v, done in layer_versions(spark, path) if v.rsplit("/", 1)[-1] < name]
    stay = [v for v, done in older if done][-(keep - 1):] if keep > 1 else []
    for v, _ in older:
        if v not in stay:
            fs, at = _folder(spark, v)
            fs.delete(at, True)


def restore_layer(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> str | None:
    """Register a missing ``table`` on its newest committed version, unbucketed;
    the folder, or None if there is none.  An existing table is left as it is."""
    done = [v for v, committed in layer_versions(spark, path) if committed]
    if spark.catalog.tableExists(table) or not done:
        return None
    spark.catalog.createTable(table, path=done[-1], source=fmt)
    return done[-1]


def catalog_listing(spark: SparkSession, names: dict[str, str] = C.LAYER_DATABASES) -> DataFrame:
    """(database, table_name) of every table in the layer databases."""
    rows = [
        (db, t.name)
        for db in names.values()
        if spark.catalog.databaseExists(db)
        for t in spark.catalog.listTables(db)
    ]
    return spark.createDataFrame(rows, "database string, table_name string")
