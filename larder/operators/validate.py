"""Final validation: row count or error status for each expected table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from larder import constants as C


class ValidationError(RuntimeError):
    pass


def validate_tables(spark: SparkSession, names: Iterable[str] = C.VALIDATION_TABLES,
                    strict: bool = False) -> DataFrame:
    """(table_name, row_count, status, reason) for every name.

    Each table is counted by a job of its own, so one that is missing or
    cannot be read spoils no other: its ``row_count`` is NULL, its status
    is an error and ``reason`` says why.  ``strict=True`` raises if any table is not OK."""
    rows = [_checked(spark, n) for n in names]
    bad = [f"{name} ({status})" for name, _, status, _ in rows if status != "OK"]
    if strict and bad:
        raise ValidationError(f"tables not OK: {', '.join(bad)}")
    return spark.createDataFrame(rows, "table_name string, row_count long, status string, reason string")


def _checked(spark: SparkSession, name: str) -> tuple[str, int | None, str, str | None]:
    """A row of the report."""
    try:
        if not spark.catalog.tableExists(name):
            return name, None, "ERROR: missing", "not in the catalog"
        return name, spark.table(name).count(), "OK", None
    except Exception as e:  # any failure is a row of the report
        return name, None, "ERROR: unreadable", str(e).strip().splitlines()[0][:500]
