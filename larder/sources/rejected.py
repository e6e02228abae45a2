"""Malformed lines of landed CSV files: captured, never cut to fit.

A line whose number of fields differs from the entity's columns is rejected
with its text; every line of a file without the expected header line is
rejected too, as nothing says which column is which.  Valid and rejected lines
together are all lines of the files but the header lines (blank lines are no
lines to the reader).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import constants as C
from larder.functions import join_small
from larder.session import scratch_dir
from larder.sources.landing import RAW_SCHEMAS, landing_dates, raw_schema

CORRUPT = "_corrupt"
WRONG_HEADER, WRONG_FIELDS = "header", "field_count"


def land_lines(lines: DataFrame, root: str, entity: str, ingestion_date: str, header: str | None = None) -> str:
    """Write lines of text (one column) as CSV files of an entity, each file
    under a header line (the entity's own unless given)."""
    path = f"{root}/{entity}/ingestion_date={ingestion_date}"
    named = lines.toDF(header or ",".join(RAW_SCHEMAS[entity]))
    named.write.mode("append").options(header=True, sep="\x01", quote="", escape="").csv(path)
    return path


def _lines(spark: SparkSession, root: str, entity: str, escape: str | None) -> DataFrame:
    """Every line as fields, or as its text under ``CORRUPT``, and whether it
    is a header line.  The corrupt column keeps the reader from cutting lines
    to the columns that a query asks for."""
    schema = T.StructType([*raw_schema(entity).fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).options(header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if escape is not None:
        reader = reader.option("escape", escape)
    names: list[Column] = [F.col(c).eqNullSafe(F.lit(c)) for c in RAW_SCHEMAS[entity]]
    is_header = F.col(CORRUPT).isNull() & reduce(lambda a, b: a & b, names)
    return reader.csv(f"{root}/{entity}").withColumns({"_file_path": F.col("_metadata.file_path"), "_is_header": is_header})


def checked_lines(spark: SparkSession, root: str, entity: str, escape: str | None = None) -> DataFrame:
    """The entity's columns, ``ingestion_date``, ``_file_path``, ``CORRUPT`` and
    ``_reason`` (null: valid) of each line that is no header line.

    One pass finds the files without a header line; their names (few or none)
    are written, so the join that marks their lines knows its real size.  An
    entity that never landed has no lines."""
    if not landing_dates(spark, root, entity):
        columns = [*RAW_SCHEMAS[entity], "_file_path", CORRUPT, "_reason"]
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", ingestion_date date")
    lines = _lines(spark, root, entity, escape)
    headed = lines.groupBy("_file_path").agg(F.max("_is_header").alias("headed"))
    path = scratch_dir(spark, "files-without-header")
    headed.where(~F.col("headed")).select("_file_path", F.lit(True).alias("_wrong")).write.parquet(path)
    marked = join_small(lines.where(~F.col("_is_header")), spark.read.parquet(path), "_file_path", "left")
    reason = F.when(F.col("_wrong"), WRONG_HEADER).when(F.col(CORRUPT).isNotNull(), WRONG_FIELDS)
    return marked.withColumn("_reason", reason).drop("_wrong", "_is_header")


def quarantine_csv(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES,
                   escape: str | None = None) -> DataFrame:
    """Rejected lines of all landings: entity, ingestion_date, source_file,
    raw_line, reason, quarantine_ts.  A line of a wrong-headed file that has
    the right number of fields is given as its fields in CSV."""
    frames = []
    for e in entities:
        lines = checked_lines(spark, root, e, escape).where(F.col("_reason").isNotNull())
        fields = F.to_csv(F.struct(*RAW_SCHEMAS[e]))
        frames.append(lines.select(
            F.lit(e).alias("entity"), F.col("ingestion_date").cast("string").alias("ingestion_date"),
            F.col("_file_path").alias("source_file"), F.coalesce(F.col(CORRUPT), fields).alias("raw_line"),
            F.col("_reason").alias("reason"), F.current_timestamp().alias("quarantine_ts")))
    return reduce(DataFrame.unionByName, frames)


def line_accounting(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES,
                    escape: str | None = None) -> DataFrame:
    """(entity, ingestion_date, n_lines, n_valid, n_rejected) of each landing;
    the lines are counted as text, apart from the CSV reader."""
    frames = []
    for e in entities:
        if not landing_dates(spark, root, e):
            continue
        checked = checked_lines(spark, root, e, escape).groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(
            F.count_if(F.col("_reason").isNull()).alias("n_valid"), F.count_if(F.col("_reason").isNotNull()).alias("n_rejected"))
        text = spark.read.text(f"{root}/{e}").where(F.length(F.trim("value")) > 0)
        header = F.col("value") == ",".join(RAW_SCHEMAS[e])
        counted = text.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(F.count_if(~header).alias("n_lines"))
        frames.append(counted.join(checked, "ingestion_date", "left").select(
            F.lit(e).alias("entity"), "ingestion_date", "n_lines", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_valid", "n_rejected")]))
    if not frames:
        return spark.createDataFrame([], "entity string, ingestion_date string, n_lines long, n_valid long, n_rejected long")
    return reduce(DataFrame.unionByName, frames)
