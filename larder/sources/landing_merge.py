"""Landings folded into a current table, each landing read once.

``fold_landings`` keeps the current rows of an entity as a versioned Parquet
folder next to the list of landings already in it.  A later call reads only the
landings that are not in the list, and joins them with the current rows: of a key,
the rows of its newest landing stay.  A row without a whole key is its own key,
so the same such row landed twice is kept once for each time it stands in its
newest landing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.landing import RAW_KEYS, RAW_SCHEMAS, landing_dates, raw_schema

KEPT_VERSIONS = 2


def row_key(entity: str) -> Column:
    """What tells rows apart, as text: the key columns, or every column where one
    of these is null.  Null fields are left out of the text, so the two forms
    never meet: the second lacks a key column that the first has."""
    keys = RAW_KEYS[entity]
    whole = F.lit(True)
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    return F.when(whole, F.to_json(F.struct(*keys))).otherwise(F.to_json(F.struct(*RAW_SCHEMAS[entity])))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, state: str) -> list[str]:
    """Committed versions, oldest first: those whose list of landings is there,
    which is written after the rows."""
    fs, at = _fs(spark, state)
    if not fs.exists(at):
        return []
    found = sorted(s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("v-"))
    return [v for v in found if fs.exists(_fs(spark, f"{v}/landings/_SUCCESS")[1])]


def folded_landings(spark: SparkSession, state: str) -> list[str]:
    """Dates of the landings in the newest version."""
    versions = _versions(spark, state)
    if not versions:
        return []
    return sorted(r.ingestion_date for r in spark.read.schema("ingestion_date string").json(f"{versions[-1]}/landings").collect())


def current_rows(spark: SparkSession, state: str, entity: str) -> DataFrame:
    """The entity's columns, ``ingestion_date`` and ``source_file``; no rows
    before the first fold."""
    versions = _versions(spark, state)
    fields = [*raw_schema(entity).fields, T.StructField("ingestion_date", T.DateType()), T.StructField("source_file", T.StringType())]
    if not versions:
        return spark.createDataFrame([], T.StructType(fields))
    return spark.read.schema(T.StructType(fields)).parquet(f"{versions[-1]}/rows")


def read_dates(spark: SparkSession, root: str, entity: str, dates: Sequence[str], escape: str | None = None) -> DataFrame:
    """Rows of the given landings alone; only their folders are listed."""
    reader = spark.read.schema(raw_schema(entity)).option("header", True).option("basePath", f"{root}/{entity}")
    if escape is not None:
        reader = reader.option("escape", escape)
    df = reader.csv([f"{root}/{entity}/ingestion_date={d}" for d in dates])
    return df.select(*RAW_SCHEMAS[entity], F.col("ingestion_date").cast("date").alias("ingestion_date"),
                     F.col("_metadata.file_path").alias("source_file"))


def merged(current: DataFrame, landed: DataFrame, entity: str, late: bool = True) -> DataFrame:
    """Of current and landed rows, those of the newest landing of each key.

    The newest date of each key that landed is one aggregate over the landed
    rows, combined before the shuffle (a key's many rows meet as one); the join
    with it carries the rows, whose hot keys AQE can split.  ``late``: a landed
    date may be older than one in the current rows, so their dates count too."""
    newest = landed.groupBy(row_key(entity).alias("_key")).agg(F.max("ingestion_date").alias("_newest"))
    if late:
        held = current.groupBy(row_key(entity).alias("_key")).agg(F.max("ingestion_date").alias("_held"))
        newest = newest.join(held, "_key", "left").select("_key", F.greatest("_newest", "_held").alias("_newest"))
    both = current.unionByName(landed).withColumn("_key", row_key(entity))
    kept = both.join(newest, "_key", "left").where(F.col("_newest").isNull() | (F.col("ingestion_date") == F.col("_newest")))
    return kept.drop("_key", "_newest")


def fold_landings(spark: SparkSession, root: str, entity: str, state: str, escape: str | None = None) -> DataFrame:
    """Fold what landed since the last call into ``state``; the current rows.

    The result does not depend on how the landings were dealt over calls.  A
    landing folder is folded once: rows added to it afterwards are not seen.  A
    call that is lost leaves the last version; without new landings nothing is
    read or written.  One writer at a time for each ``state``."""
    done = folded_landings(spark, state)
    new = [d for d in landing_dates(spark, root, entity) if d not in set(done)]
    if new:
        version = f"{state}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        landed = read_dates(spark, root, entity, new, escape)
        late = bool(done) and min(new) < max(done)
        merged(current_rows(spark, state, entity), landed, entity, late).write.parquet(f"{version}/rows")
        listed = spark.createDataFrame([(d,) for d in done + new], "ingestion_date string")
        listed.coalesce(1).write.json(f"{version}/landings")
        for old in _versions(spark, state)[:-KEPT_VERSIONS]:
            fs, at = _fs(spark, old)
            fs.delete(at, True)
    return current_rows(spark, state, entity)
