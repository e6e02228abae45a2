"""Rows of embeddings as vectors of whole numbers, shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all entries are finite."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(ok, F.lit(False))


def scaled(vector: Column, factor: int, plus: int = 0) -> Column:
    """``floor(factor * c) + plus`` of each entry, taken as double, as long."""
    return F.transform(vector, lambda c: F.floor(c * F.lit(float(factor))).cast("long") + F.lit(plus).cast("long"))


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with a finite vector of the table's length, entries as double.

    The length is the most frequent one (of equally frequent ones the
    smallest); a vector of another length takes no part."""
    rows = rows.withColumn(vector, F.col(vector).cast("array<double>")).where(finite(F.col(vector)))
    lengths = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    return rows.where(F.size(vector) == lengths[0]["n"]) if lengths else rows
