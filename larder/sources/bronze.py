"""Bronze ingestion: landed CSV → one table per entity with lineage columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.sources.fixture import RawTables
from larder.sources.landing import RAW_SCHEMAS, landing_dates, read_landing


def read_bronze(
    spark: SparkSession,
    root: str,
    entity: str,
    ingestion_date: str | None = None,
    escape: str | None = None,
    reject_malformed: bool = False,
) -> DataFrame:
    """Landed rows plus ``source_file`` (the file each row came from) and
    ``bronze_ingestion_ts``."""
    df = read_landing(spark, root, entity, ingestion_date, escape, reject_malformed=reject_malformed)
    if not landing_dates(spark, root, entity):
        source = F.lit(None).cast("string")
    else:
        source = F.col("_file_path" if "_file_path" in df.columns else "_metadata.file_path")
    return df.select(
        *RAW_SCHEMAS[entity],
        source.alias("source_file"),
        F.current_timestamp().alias("bronze_ingestion_ts"),
    )


def ingest_bronze(
    spark: SparkSession,
    root: str,
    entities: Iterable[str] = C.RAW_ENTITIES,
    ingestion_date: str | None = None,
    escape: str | None = None,
    reject_malformed: bool = False,
) -> dict[str, DataFrame]:
    return {e: read_bronze(spark, root, e, ingestion_date, escape, reject_malformed) for e in entities}


def bronze_as_raw(bronze: dict[str, DataFrame]) -> RawTables:
    return RawTables(**{e: bronze[e] for e in C.RAW_ENTITIES})
