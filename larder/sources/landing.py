"""Raw landing zone: CSV files per entity under ``ingestion_date=`` folders.

Layout ``<root>/<entity>/ingestion_date=YYYY-MM-DD/part-*.csv``.  Reading the
entity folder makes ``ingestion_date`` a partition column, so choosing a
landing date prunes whole folders instead of re-reading every landing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import constants as C

# Every raw column is read as text under an explicit schema: no inference
# pass, and a malformed key stays visible as text until silver types it.
RAW_SCHEMAS = {
    "orders": ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
               "days_since_prior_order"],
    "order_products_prior": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    "order_products_train": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    "products": ["product_id", "product_name", "aisle_id", "department_id"],
    "aisles": ["aisle_id", "aisle"],
    "departments": ["department_id", "department"],
}


def raw_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_SCHEMAS[entity]])


# What tells the rows of an entity apart when it lands more than once.
RAW_KEYS = {
    "orders": ["order_id"],
    "order_products_prior": ["order_id", "product_id"],
    "order_products_train": ["order_id", "product_id"],
    "products": ["product_id"],
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
}


def land_entity(df: DataFrame, root: str, entity: str, ingestion_date: str, files: int | None = None) -> str:
    """Write one entity as header CSV into its dated landing folder, as
    ``files`` files if that is given."""
    path = f"{root}/{entity}/ingestion_date={ingestion_date}"
    df = df.select(*RAW_SCHEMAS[entity])
    (df.repartition(files) if files else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def land_all(tables: dict[str, DataFrame], root: str, ingestion_date: str,
             entities: Iterable[str] = C.RAW_ENTITIES, files: int | None = None) -> dict[str, str]:
    return {e: land_entity(tables[e], root, e, ingestion_date, files) for e in entities if e in tables}


def landing_dates(spark: SparkSession, root: str, entity: str) -> list[str]:
    """Dates of the landing folders of ``entity`` (a metadata listing, no data read)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{entity}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("ingestion_date="))


def landed_files(spark: SparkSession, root: str, entity: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of every landed file of ``entity`` (metadata only)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{entity}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    files, found = fs.listFiles(path, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def newest_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of the landings that hold a key, its rows of the newest one.  Rows
    without a whole key are never replaced."""
    newest = df.groupBy(*keys).agg(F.max("ingestion_date").alias("_newest"))
    kept = df.join(newest, keys, "left")
    return kept.filter(F.col("_newest").isNull() | (F.col("ingestion_date") == F.col("_newest"))).drop("_newest")


def read_landing(
    spark: SparkSession,
    root: str,
    entity: str,
    ingestion_date: str | None = None,
    escape: str | None = None,
    every_version: bool = False,
    reject_malformed: bool = False,
) -> DataFrame:
    """Header CSV of one entity with a text schema plus ``ingestion_date``.

    All landings are read, and of a key that landed several times only the
    newest rows are kept (``every_version=True`` keeps all), so landings may be
    increments or whole copies.  A given ``ingestion_date`` reads that landing
    alone (a partition filter).  ``escape`` is the CSV quote-escape character;
    the reader default is a backslash, with which a doubled quote followed by
    a comma shifts the columns of that row.  An entity that never landed has
    no rows.

    The reader fits a line with too many or too few fields to the columns; with
    ``reject_malformed`` such lines, and files without the header, are left out
    (``rejected.quarantine_csv`` holds them).
    """
    dates = landing_dates(spark, root, entity)
    if not dates:
        schema = T.StructType([*raw_schema(entity).fields, T.StructField("ingestion_date", T.DateType(), True)])
        return spark.createDataFrame([], schema)
    if reject_malformed:
        from larder.sources.rejected import CORRUPT, checked_lines

        df = checked_lines(spark, root, entity, escape).where(F.col("_reason").isNull()).drop("_reason", CORRUPT)
    else:
        reader = spark.read.schema(raw_schema(entity)).option("header", True)
        if escape is not None:
            reader = reader.option("escape", escape)
        df = reader.csv(f"{root}/{entity}")
    if ingestion_date is not None:
        return df.filter(F.col("ingestion_date") == F.lit(ingestion_date).cast(df.schema["ingestion_date"].dataType))
    if every_version or len(dates) == 1:
        return df
    # the join would hide the files' metadata column
    named = df if "_file_path" in df.columns else df.withColumn("_file_path", F.col("_metadata.file_path"))
    return newest_of_each(named, RAW_KEYS[entity])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def file_inventory(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES) -> DataFrame:
    """Per landed file, empty ones included: entity, ingestion date, path, size, rows."""
    schema = "entity string, ingestion_date string, file_path string, file_size long, row_count long"
    frames = [spark.createDataFrame([], schema)]
    for e in entities:
        if not landing_dates(spark, root, e):
            continue
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(f"{root}/{e}").select(
            F.col("ingestion_date").cast("string").alias("ingestion_date"), F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"))
        rows = spark.read.schema(raw_schema(e)).option("header", True).csv(f"{root}/{e}").groupBy(
            F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(files.join(rows, "file_path", "left").select(
            F.lit(e).alias("entity"), "ingestion_date", "file_path", "file_size",
            F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count")))
    return _union(frames)


def row_counts(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES) -> DataFrame:
    """(entity, row_count) of each landed entity, one job."""
    frames = [spark.createDataFrame([], "entity string, row_count long")]
    frames += [
        read_landing(spark, root, e).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(e).alias("entity"), "row_count"
        )
        for e in entities
        if landing_dates(spark, root, e)
    ]
    return _union(frames)


def preview(spark: SparkSession, root: str, entity: str, n: int = 5) -> DataFrame:
    """First ``n`` rows of an entity (a plain limit, for display)."""
    return read_landing(spark, root, entity).limit(n)


def preview_rows(spark: SparkSession, root: str, entity: str, n: int = C.QUERY_PREVIEW_ROWS) -> DataFrame:
    """The ``n`` first rows of an entity by its key as numbers, then all
    fields: (entity, place, fields), the fields by name.  A top-k cut."""
    df = read_landing(spark, root, entity).select(*RAW_SCHEMAS[entity])
    order = [F.col(c).try_cast("long").asc_nulls_last() for c in RAW_KEYS[entity]] + [F.col(c) for c in RAW_SCHEMAS[entity]]
    top = df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.orderBy(*order))  # n rows
    fields = F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c), F.lit(""))) for c in RAW_SCHEMAS[entity]])
    return top.select(F.lit(entity).alias("entity"), place.alias("place"), fields.alias("fields"))


def landing_report(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES) -> DataFrame:
    """Expected entities against what landed: status ``uploaded`` or ``skipped``
    (a left join of the expected list with the landed counts)."""
    entities = list(entities)
    expected = spark.createDataFrame(
        [(e, C.RAW_FILE_NAMES[e]) for e in entities], "entity string, file_name string"
    )
    landed = row_counts(spark, root, entities)
    return expected.join(landed, "entity", "left").select(
        "entity",
        "file_name",
        F.when(F.col("row_count").isNull(), F.lit("skipped")).otherwise(F.lit("uploaded")).alias("status"),
        "row_count",
    )


def landing_totals(report: DataFrame) -> DataFrame:
    """How many entities a landing report says were uploaded and skipped."""
    return report.agg(*[F.count(F.when(F.col("status") == x, 1)).alias(x) for x in ("uploaded", "skipped")])


def validate_raw(spark: SparkSession, root: str, entities: Iterable[str] = C.RAW_ENTITIES,
                 preview_rows: int = 5) -> dict[str, DataFrame]:
    """The raw-zone check: per-file inventory, per-entity row counts, and a
    ``preview_rows``-row preview of each landed entity (lazy DataFrames)."""
    entities = [e for e in entities if landing_dates(spark, root, e)]
    out = {"files": file_inventory(spark, root, entities), "counts": row_counts(spark, root, entities)}
    out.update({f"preview_{e}": preview(spark, root, e, preview_rows) for e in entities})
    return out
