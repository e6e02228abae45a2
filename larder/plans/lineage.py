"""Wire every layer for one input: raw entities → bronze → silver → gold.

``Lineage`` builds DataFrames lazily and memoises them per instance, so one
query plan is constructed once and nothing runs until an action.  The raw
entities come either from the supplied test tables (fixture mapping) or
from any ``RawTables`` (e.g. a bronze layer read from CSV landing files).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.operators import classify, gold, silver
from larder.functions import estimated_bytes, task_count
from larder.plans.layers import bucket_count, write_bucketed
from larder.session import scratch_dir
from larder.sources.fixture import (
    RawTables,
    fixture_aisles,
    fixture_departments,
    fixture_order_lines,
    fixture_orders,
    fixture_product_ids,
    fixture_products,
    raw_tables,
    split_lines,
)

SCRATCH_DB = "larder_scratch"

AUDIT_COLUMNS = {
    "silver_updated_ts", "gold_updated_ts", "ai_classified_ts", "quarantine_ts",
    "bronze_ingestion_ts", "valid_from", "valid_to", "source_file",
}


def comparable(df: DataFrame) -> DataFrame:
    """Drop run-time audit columns (timestamps, lineage paths) for comparison."""
    return df.drop(*[c for c in df.columns if c in AUDIT_COLUMNS])


class Lineage:
    """All datasets of one run, built on demand.

    With ``materialize=True`` (the default) each layer dataset is written as a
    Parquet table under the session's shared checkpoint folder and read back
    before the next layer uses it, as the layered run does with its tables.
    That cuts the lineage (a lost executor recomputes from the last written
    layer, not from the raw inputs), keeps every plan short, and gives the
    next layer real file-size statistics for its broadcast checks.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        raw: RawTables | None = None,
        sample_size: int = C.MODEL_SAMPLE_SIZE,
        null_safe_inventory: bool = False,
        min_co_purchase: int = C.MIN_CO_PURCHASE,
        materialize: bool = True,
        root: str | None = None,
        sink: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None,
    ) -> None:
        if raw is None and sf_dir is None:
            raise ValueError("give sf_dir or raw")
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw
        self.sample_size = sample_size
        self.null_safe_inventory = null_safe_inventory
        self.min_co_purchase = min_co_purchase
        self.materialize = materialize
        self._root = root
        self._sink = sink

    @cached_property
    def root(self) -> str:
        return self._root or scratch_dir(self.spark, "lineage")

    def _layer(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: list[str] | None = None,
        bucket_by: str | None = None,
        buckets: int | None = None,
    ) -> DataFrame:
        if self._sink is not None:
            return self._sink(name, build)
        if not self.materialize:
            return build()
        path = f"{self.root}/{name}"
        if bucket_by is None:
            build().write.mode("overwrite").parquet(path, partitionBy=partition_by)
            return self.spark.read.parquet(path)
        # bucketed layout needs a catalog table (bucket metadata lives there)
        table = f"{SCRATCH_DB}.t_{self.root.rstrip('/').rsplit('/', 1)[-1]}_{name}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DB} LOCATION '{self.root}/_db'")
        write_bucketed(build(), table, path, bucket_by, buckets=buckets)
        # The plan keeps the bucket layout; the catalog entry is not needed any more.
        df = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")
        return df

    # raw / bronze ------------------------------------------------------------
    @cached_property
    def raw(self) -> RawTables:
        if self._raw is not None:
            return self._raw
        if not self.materialize:
            return raw_tables(self.spark, self.sf_dir)
        # orders first; the lines are derived from the written orders, so
        # nothing upstream is computed twice
        orders = self._layer("raw_orders", lambda: fixture_orders(self.spark, self.sf_dir))
        pids = fixture_product_ids(self.spark, self.sf_dir)
        written = {
            "orders": orders,
            "order_lines": self._layer(
                "raw_order_lines",
                lambda: fixture_order_lines(self.spark, self.sf_dir, orders),
                partition_by=["eval_set"],
            ),
            "products": self._layer("raw_products", lambda: fixture_products(pids)),
            "aisles": self._layer("raw_aisles", lambda: fixture_aisles(pids)),
            "departments": self._layer("raw_departments", lambda: fixture_departments(pids)),
        }
        return split_lines(written)

    # silver ------------------------------------------------------------------
    @cached_property
    def dim_aisle(self) -> DataFrame:
        return self._layer("dim_aisle", lambda: silver.dim_aisle(self.raw.aisles))

    @cached_property
    def dim_department(self) -> DataFrame:
        return self._layer("dim_department", lambda: silver.dim_department(self.raw.departments))

    @cached_property
    def products_clean(self) -> DataFrame:
        return silver.products_clean(self.raw.products)

    @cached_property
    def valid_products(self) -> DataFrame:
        return silver.valid_products(self.products_clean)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._layer("quarantine", lambda: silver.quarantine_products(self.products_clean))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._layer("dim_product", lambda: silver.build_dim_product(self.valid_products, self.dim_aisle, self.dim_department))

    @cached_property
    def sample(self) -> DataFrame:
        return self._layer("sample", lambda: classify.sample_products(self.dim_product, self.sample_size))

    @cached_property
    def model_labels(self) -> DataFrame:
        return self._layer("model_labels", lambda: classify.model_labels(self.spark, self.sample))

    @cached_property
    def product_labels(self) -> DataFrame:
        """The scorer's labels of every product with a name, not the sample alone."""
        return self._layer(
            "product_labels", lambda: classify.model_labels(self.spark, classify.named_products(self.dim_product)))

    @cached_property
    def dim_product_ai(self) -> DataFrame:
        return self._layer("dim_product_ai", lambda: classify.classify_overlay(self.dim_product, self.model_labels))

    @cached_property
    def attributes(self) -> DataFrame:
        return silver.product_attributes(self.dim_product_ai)

    @cached_property
    def quarantine_lines(self) -> DataFrame:
        r = self.raw
        return self._layer(
            "quarantine_lines", lambda: silver.quarantine_order_lines(r.order_products_prior, r.order_products_train))

    @cached_property
    def order_tasks(self) -> int | None:
        """Tasks for a step over all orders, as ``line_tasks``."""
        if self._sink is None and not self.materialize:
            return None
        return task_count(self.spark, self.raw.orders.count())

    @cached_property
    def fact_orders(self) -> DataFrame:
        """One typed row per order, written: the fact joins a plain scan of it."""
        return self._layer("fact_orders", lambda: silver.first_orders(self.raw.orders, self.order_tasks))

    @cached_property
    def _line_files(self) -> DataFrame:
        return self.raw.order_products_prior.unionByName(self.raw.order_products_train)

    @cached_property
    def line_tasks(self) -> int | None:
        """Tasks for a step over all order lines, from the rows of the line
        files; None where the planner's own are enough."""
        if self._sink is None and not self.materialize:
            return None
        return task_count(self.spark, self._line_files.count())

    @cached_property
    def fact_buckets(self) -> int:
        """A bucket is one task of the pair join, so there are as many as tasks;
        for few lines they follow from the real size of the line files."""
        return self.line_tasks or bucket_count(self.spark, estimated_bytes(self._line_files))

    @cached_property
    def fact(self) -> DataFrame:
        r = self.raw
        return self._layer(
            "fact",
            lambda: silver.build_fact(
                r.order_products_prior, r.order_products_train, self.fact_orders, self.dim_product_ai, orders_typed=True,
                tasks=self.line_tasks),
            bucket_by="order_id",
            buckets=self.fact_buckets if self._sink is None and self.materialize else None,
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self._layer(
            "inventory",
            lambda: silver.inventory_snapshots(
                self.fact, self.attributes, null_safe=self.null_safe_inventory, demand=self.demand
            ),
        )

    # gold --------------------------------------------------------------------
    @cached_property
    def demand(self) -> DataFrame:
        return self._layer("demand", lambda: gold.product_demand(self.fact, self.attributes, tasks=self.line_tasks))

    @cached_property
    def reorder(self) -> DataFrame:
        return self._layer("reorder", lambda: gold.reorder_metrics(self.fact, self.attributes, tasks=self.line_tasks))

    @cached_property
    def latest_inventory(self) -> DataFrame:
        # The last snapshot in closed form (equal to filtering the grid at its
        # highest number, which ``gold.latest_stock`` does; tested equal).
        return silver.latest_inventory_direct(
            self.fact, self.attributes, null_safe=self.null_safe_inventory, demand=self.demand
        )

    @cached_property
    def demand_summary(self) -> DataFrame:
        return gold.latest_demand(self.demand)

    @cached_property
    def stockout(self) -> DataFrame:
        return self._layer("stockout", lambda: gold.stockout_risk(self.latest_inventory, self.demand_summary))

    @cached_property
    def overstock(self) -> DataFrame:
        return self._layer("overstock", lambda: gold.overstock_alerts(self.latest_inventory, self.demand_summary))

    @cached_property
    def pairs(self) -> DataFrame:
        counts = self.reorder.select("product_id", F.col("total_units_ordered").alias("n"))
        return self._layer(
            "pairs",
            lambda: gold.basket_affinity(self.fact, self.attributes, self.min_co_purchase, product_counts=counts),
        )

    def table(self, name: str) -> DataFrame:
        """Dataset by its table name (as written by the layered run)."""
        return {
            "dim_aisle": lambda: self.dim_aisle,
            "dim_department": lambda: self.dim_department,
            "dim_product": lambda: self.dim_product,
            "dim_product_ai": lambda: self.dim_product_ai,
            "quarantine_malformed_products": lambda: self.quarantine,
            "fact_order_products": lambda: self.fact,
            "fact_inventory_snapshots": lambda: self.inventory,
            "daily_product_demand": lambda: self.demand,
            "reorder_metrics": lambda: self.reorder,
            "stockout_risk": lambda: self.stockout,
            "overstock_alerts": lambda: self.overstock,
            "basket_affinity": lambda: self.pairs,
        }[name]()
