"""The eleven dashboard queries, built from a few shared shapes.

Each takes the gold DataFrame it reads.  Top lists name every key of their
order, unique ones last, so a limit that cuts through ties is deterministic.
Tiers, thresholds and limits come from ``larder.constants``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import constants as C


def total(df: DataFrame, name: str, of: str | None = None, where: Column | None = None) -> DataFrame:
    """One number: rows, or the sum of a column."""
    kept = df if where is None else df.where(where)
    return kept.agg((F.count(F.lit(1)) if of is None else F.sum(of)).alias(name))


def totals_by(df: DataFrame, key: str, sums: dict[str, str], missing: str | None = None) -> DataFrame:
    """Sums by a label; rows without one fall under ``missing`` if that is given."""
    label = F.col(key) if missing is None else F.coalesce(key, F.lit(missing))
    return df.groupBy(label.alias(key)).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def reorder_rate_by(df: DataFrame, key: str) -> DataFrame:
    """Units, reordered units and their ratio by a product label, largest first."""
    both = {c: c for c in ("total_units_ordered", "total_reordered_units")}
    rate = F.round(F.col("total_reordered_units") / F.col("total_units_ordered"), C.RATE_DIGITS)
    return totals_by(df, key, both, C.NO_LABEL).withColumn("reorder_rate", rate).orderBy(F.desc("total_units_ordered"), key)


def by_tier(df: DataFrame, tier: str, measure: Column, name: str, order: str) -> DataFrame:
    """Products and one measure of each tier."""
    return df.groupBy(tier).agg(F.count(F.lit(1)).alias("product_count"), measure.alias(name)).orderBy(F.desc(order), tier)


def top(df: DataFrame, columns: Sequence[str], order: Sequence[Column], n: int, rounded: dict[str, int] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order``; ``rounded`` columns are ordered as shown."""
    shown = df.withColumns({c: F.round(c, k) for c, k in (rounded or {}).items()})
    return shown.orderBy(*order).limit(n).select(*columns)


def _high_risk() -> Column:
    return F.col("stockout_risk_tier").isin(C.HIGH_RISK_TIERS)


_LABELS = ["product_name", "department", "aisle"]

# name -> (gold table, query over it)
DASHBOARDS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "dash_01_total_records": ("fact_order_products", lambda df: total(df, "total_order_product_records")),
    "dash_02_high_risk_count": ("stockout_risk", lambda df: total(df, "high_risk_stockout_products", where=_high_risk())),
    "dash_03_overstock_units": ("overstock_alerts", lambda df: total(
        df, "total_overstock_exposure_units", of="estimated_capital_exposure_units")),
    "dash_04_departments": ("daily_product_demand", lambda df: totals_by(
        df, "department", {"total_units_sold": "units_sold"}).orderBy(F.desc("total_units_sold"), "department")),
    "dash_05_top_reordered": ("reorder_metrics", lambda df: top(
        df.where(F.col("total_units_ordered") >= C.TOP_REORDERED_LEAST_UNITS),
        [*_LABELS, "total_units_ordered", "total_reordered_units", "reorder_rate"],
        [F.desc("reorder_rate"), F.asc("product_id")], C.TOP_REORDERED, {"reorder_rate": C.RATE_DIGITS})),
    "dash_06_theme": ("reorder_metrics", lambda df: reorder_rate_by(df, "ai_product_theme")),
    "dash_07_demand_type": ("reorder_metrics", lambda df: reorder_rate_by(df, "ai_demand_type")),
    "dash_08_stockout_tiers": ("stockout_risk", lambda df: by_tier(
        df, "stockout_risk_tier", F.round(F.avg("days_of_stock_proxy"), C.STOCK_DIGITS), "avg_days_of_stock", "product_count")),
    "dash_09_priority": ("stockout_risk", lambda df: top(
        df.where(_high_risk()),
        [*_LABELS, "ai_product_theme", "ai_demand_type", "ending_inventory_qty", "avg_units_per_order_window_30",
         "days_of_stock_proxy", "stockout_risk_tier", "priority_score"],
        [F.desc("priority_score"), F.asc("days_of_stock_proxy"), F.asc("product_id")], C.TOP_PRIORITY,
        {"avg_units_per_order_window_30": C.STOCK_DIGITS, "days_of_stock_proxy": C.STOCK_DIGITS})),
    "dash_10_overstock_tiers": ("overstock_alerts", lambda df: by_tier(
        df, "overstock_tier", F.sum("estimated_capital_exposure_units"), "exposure_units", "exposure_units")),
    "dash_11_top_pairs": ("basket_affinity", lambda df: top(
        df, ["product_name_a", "product_name_b", "department_a", "department_b", "ai_product_theme_a", "ai_product_theme_b",
             "co_purchase_count"],
        [F.desc("co_purchase_count"), F.asc("product_id_a"), F.asc("product_id_b")], C.TOP_PAIRS)),
}


def dashboard_query(name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """Query ``name`` over its gold table, which ``table`` gives by name."""
    source, build = DASHBOARDS[name]
    return build(table(source))
