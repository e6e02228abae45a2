"""Bronze ingestion as a file-source stream.

The batch path re-reads a landing folder on every run.  As a stream, each
landed CSV file is read once: the source's checkpoint records which files
were committed, so a re-run (or a run after a lost executor) picks up only
new landings, and the sink commits each micro-batch atomically.  Run with
``availableNow`` it behaves like a scheduled incremental batch job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder import constants as C
from larder.sources.landing import RAW_SCHEMAS, raw_schema


def stream_bronze(spark: SparkSession, landing_root: str, entity: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of an entity's landed rows plus lineage columns."""
    src = (
        spark.readStream.schema(raw_schema(entity))
        .option("header", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .csv(f"{landing_root}/{entity}")
    )
    return src.select(
        *RAW_SCHEMAS[entity],
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("bronze_ingestion_ts"),
    )


def ingest_new_files(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    checkpoint_root: str,
    entities: Iterable[str] = C.RAW_ENTITIES,
) -> dict[str, str]:
    """Append every not-yet-ingested landed file to ``bronze_root/<entity>``
    (Parquet), one ``availableNow`` stream per entity; returns the paths."""
    out: dict[str, str] = {}
    queries: list[StreamingQuery] = []
    for e in entities:
        path = f"{bronze_root}/bronze_{e}"
        q = (
            stream_bronze(spark, landing_root, e)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{checkpoint_root}/bronze_{e}")
            .outputMode("append")
            .trigger(availableNow=True)
            .start(path)
        )
        queries.append(q)
        out[e] = path
    for q in queries:
        q.awaitTermination()
    return out
