"""A training corpus from ``documents``, in stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  Each stage works on all rows that its predecessor kept, learns and
counts on them alone, and drops what it rejects; all but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, jaccard_join, language_id, sentencepiece_codec, toxicity
from larder.llm.common import stored, table
from larder.llm.queries import PIECES


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text lies within some language's distance."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id."""
    return jaccard_join.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, as digests of them and of their decoding."""
    return sentencepiece_codec.round_trip_digests(docs, PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# SQL expresses neither the fitted classifiers nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
