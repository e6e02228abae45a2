"""Every query/operator by name: ``(spark, sf_dir) -> DataFrame``.

Each query rebuilds what it needs from the test tables in ``sf_dir`` (the
fixture mapping, then the layers), so its work grows with the data.  Run-time
audit columns (timestamps, file paths) are dropped so results compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import dealt, join_small
from larder.operators import gold, maintenance, silver, validate
from larder.operators.classify import classify_rules
from larder.operators.label_model import fit_from_rules, model_table
from larder.plans import dashboard, layers, medallion
from larder.plans.lineage import Lineage, comparable
from larder.plans.oracle import LANDING_DATE, RELANDING_DATE
from larder.session import scratch_dir
from larder.sources import bronze, landing, landing_merge, rejected
from larder.sources.fixture import text_lines

Query = Callable[[SparkSession, str], DataFrame]


# One lineage per application and input: queries share the layers that are
# already written.
_LINEAGES: dict[tuple[str, str], Lineage] = {}


def _lin(spark: SparkSession, sf_dir: str) -> Lineage:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINEAGES:
        _LINEAGES[key] = Lineage(spark, sf_dir, sample_size=C.QUERY_SAMPLE_SIZE)
    return _LINEAGES[key]


def _from(attr: str, *cols: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = comparable(getattr(_lin(spark, sf_dir), attr))
        return df.select(*cols) if cols else df

    return q


# ------------------------------------------------------------------ landing


def _landed(spark: SparkSession, sf_dir: str, without: str | None = None, files: int | None = None) -> str:
    """Land the raw entities (derived from the test tables) as CSV."""
    root = scratch_dir(spark, "landing")
    tables = _lin(spark, sf_dir).raw.as_dict()  # derived once, written, then landed
    landing.land_all(tables, root, LANDING_DATE, [e for e in C.RAW_ENTITIES if e != without], files)
    return root


def q_bronze_products(spark, sf_dir):
    root = _landed(spark, sf_dir)
    return comparable(bronze.read_bronze(spark, root, "products"))


def q_raw_row_counts(spark, sf_dir):
    return landing.row_counts(spark, _landed(spark, sf_dir))


def q_raw_file_inventory(spark, sf_dir):
    files = landing.file_inventory(spark, _landed(spark, sf_dir, files=C.QUERY_LANDING_FILES))
    return files.groupBy("entity", "ingestion_date").agg(F.count(F.lit(1)).alias("n_files"), F.sum("row_count").alias("row_count"))


def q_landing_report(spark, sf_dir):
    return landing.landing_report(spark, _landed(spark, sf_dir, without=C.QUERY_MISSING_ENTITY))


def q_landing_totals(spark, sf_dir):
    return landing.landing_totals(q_landing_report(spark, sf_dir))


def q_landing_latest_partition(spark, sf_dir):
    root = scratch_dir(spark, "landing")
    products = _lin(spark, sf_dir).raw.products
    for d in (LANDING_DATE, RELANDING_DATE):  # the same file landed twice
        landing.land_entity(products, root, "products", d)
    return landing.read_landing(spark, root, "products").select(*landing.RAW_SCHEMAS["products"])


def q_landing_merge(spark, sf_dir):
    """Products folded after each of two landings: all of them, then some under a
    new name; a row without a key is in both."""
    root, state = scratch_dir(spark, "landing"), scratch_dir(spark, "landing-merge")
    names = landing.RAW_SCHEMAS["products"]
    products = _lin(spark, sf_dir).raw.products.select(*[F.col(c).cast("string").alias(c) for c in names])
    keyless = spark.createDataFrame([(None, C.QUERY_KEYLESS_NAME, "1", "1")], ", ".join(f"{c} string" for c in names))
    renamed = products.where(F.col("product_id").cast("long") % C.QUERY_MALFORMED_MOD == C.QUERY_LONG_REM).withColumn(
        "product_name", F.concat(F.lit(C.QUERY_RENAMED), "product_id"))
    for date, rows in ((LANDING_DATE, products), (RELANDING_DATE, renamed)):
        landing.land_entity(rows.unionByName(keyless), root, "products", date)
        current = landing_merge.fold_landings(spark, root, "products", state)
    return current.select(*names, F.col("ingestion_date").cast("string").alias("ingestion_date"))


def _landed_with_malformed(spark, sf_dir) -> str:
    """Products landed with lines of too many and too few fields, and a second
    landing whose files have another header."""
    root = scratch_dir(spark, "landing")
    products = _lin(spark, sf_dir).raw.products
    pid = F.col("product_id").cast("long") % C.QUERY_MALFORMED_MOD
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in landing.RAW_SCHEMAS["products"]]
    line = F.when(pid == C.QUERY_LONG_REM, F.concat_ws(",", *fields, F.lit("more"))).when(
        pid == C.QUERY_SHORT_REM, F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
    rejected.land_lines(products.select(line), root, "products", LANDING_DATE)
    other = products.where(pid == C.QUERY_OTHER_HEADER_REM).select(F.concat_ws(",", *fields))
    rejected.land_lines(other, root, "products", RELANDING_DATE, header=C.QUERY_OTHER_HEADER)
    return root


def q_quarantine_csv_rows(spark, sf_dir):
    found = rejected.quarantine_csv(spark, _landed_with_malformed(spark, sf_dir), ["products"])
    return found.select("entity", "ingestion_date", "reason", "raw_line")


def q_csv_line_accounting(spark, sf_dir):
    return rejected.line_accounting(spark, _landed_with_malformed(spark, sf_dir))


def q_bronze_products_valid(spark, sf_dir):
    return comparable(bronze.read_bronze(spark, _landed_with_malformed(spark, sf_dir), "products", reject_malformed=True))


def q_raw_preview(spark, sf_dir):
    """The first rows by id of each landed entity, as one table."""
    root = _landed(spark, sf_dir)
    frames = [landing.preview_rows(spark, root, e) for e in C.RAW_ENTITIES]
    res = frames[0]
    for p in frames[1:]:
        res = res.unionByName(p)
    return res


def q_bronze_counts(spark, sf_dir):
    root = _landed(spark, sf_dir)
    out = scratch_dir(spark, "bronze")
    parts = []
    for entity, df in bronze.ingest_bronze(spark, root).items():
        path = f"{out}/bronze_{entity}"
        df.write.mode("overwrite").parquet(path)
        parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"bronze_{entity}").alias("table_name"), "row_count"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def q_stream_bronze_counts(spark, sf_dir):
    """Landed files ingested by an availableNow stream, then re-run: the
    second run finds no new files, so nothing is ingested twice."""
    from larder.streaming import ingest_new_files

    root = _landed(spark, sf_dir)
    out = scratch_dir(spark, "stream-bronze")
    ckpt = scratch_dir(spark, "stream-checkpoints")
    paths = ingest_new_files(spark, root, out, ckpt)
    ingest_new_files(spark, root, out, ckpt)
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(e).alias("entity"), "row_count") for e, p in paths.items()]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def q_final_validation(spark, sf_dir):
    out = scratch_dir(spark, "layers")
    medallion.run_layers(spark, _landed(spark, sf_dir), out, sample_size=C.QUERY_SAMPLE_SIZE, maintain=True)
    # A table over files that are no Parquet, and one that was never written.
    text = f"{out}/unreadable"
    _lin(spark, sf_dir).dim_aisle.selectExpr("aisle AS value").write.text(text)
    spark.sql(f"DROP TABLE IF EXISTS {C.QUERY_UNREADABLE_TABLE}")
    spark.sql(f"CREATE TABLE {C.QUERY_UNREADABLE_TABLE} (x INT) USING parquet LOCATION '{text}'")
    report = validate.validate_tables(spark, [*C.VALIDATION_TABLES, C.QUERY_ABSENT_TABLE, C.QUERY_UNREADABLE_TABLE])
    spark.sql(f"DROP TABLE {C.QUERY_UNREADABLE_TABLE}")
    return report.drop("reason")


def q_catalog_listing(spark, sf_dir):
    out = scratch_dir(spark, "catalog")
    layers.create_layer_databases(spark, out)
    layers.write_layer(comparable(_lin(spark, sf_dir).dim_aisle), f"{C.LAYER_DATABASES['silver']}.dim_aisle",
                       f"{out}/silver/dim_aisle")
    return layers.catalog_listing(spark)


# --------------------------------------------------------------- sinks, maintenance


def q_write_read_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "roundtrip")
    layers.create_layer_databases(spark, out)
    table = f"{C.LAYER_DATABASES['gold']}.reorder_metrics_roundtrip"
    layers.write_layer(_lin(spark, sf_dir).reorder, table, f"{out}/gold/reorder_metrics")
    return comparable(spark.table(table))


def q_safe_overwrite(spark, sf_dir):
    """A table written in part, overwritten whole, then by a write that is lost
    half way: its rows are those of the last whole write."""
    out = scratch_dir(spark, "overwrite")
    layers.create_layer_databases(spark, out)
    table, path = f"{C.LAYER_DATABASES['gold']}.reorder_metrics_overwritten", f"{out}/gold/reorder_metrics"
    rows = comparable(_lin(spark, sf_dir).reorder)
    layers.write_layer(rows.where("product_id % 2 = 0"), table, path)
    layers.write_layer(rows, table, path)
    broken = F.when(F.col("product_id") % 5 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("product_id"))
    try:
        layers.write_layer(rows.withColumn("product_id", broken), table, path)
    except PySparkException as lost:
        if "lost" not in str(lost):
            raise
    return spark.table(table)


def _scattered_demand(spark, sf_dir) -> str:
    """The demand table written as many small files (what compaction fixes)."""
    path = scratch_dir(spark, "maintenance") + "/daily_product_demand"
    comparable(_lin(spark, sf_dir).demand).repartition(16).write.mode("overwrite").parquet(path)
    return path


def q_compact_table(spark, sf_dir):
    src = _scattered_demand(spark, sf_dir)
    return maintenance.compact_table(spark, src, src + "_compacted")


def q_cluster_table(spark, sf_dir):
    src = _scattered_demand(spark, sf_dir)
    return maintenance.cluster_table(spark, src, src + "_clustered", ["product_id", "department"])


# ------------------------------------------------------------------ silver pieces


def q_union_prior_train(spark, sf_dir):
    r = _lin(spark, sf_dir).raw
    return silver.union_prior_train(r.order_products_prior, r.order_products_train)


def q_join_inner_orders(spark, sf_dir):
    r = _lin(spark, sf_dir).raw
    lines = silver.union_prior_train(r.order_products_prior, r.order_products_train)
    return lines.join(r.orders, "order_id", "inner").select(
        "order_id", "product_id", "user_id", "order_number", "eval_set", "eval_set_source")


def q_dedup_order_product(spark, sf_dir):
    return comparable(_lin(spark, sf_dir).fact).select(
        "order_id", "product_id", "user_id", "add_to_cart_order", "reordered", "eval_set_source")


def q_join_left_lookup(spark, sf_dir):
    L = _lin(spark, sf_dir)
    a = L.dim_aisle.select("aisle_id", "aisle")
    d = L.dim_department.select("department_id", "department")
    joined = join_small(join_small(L.valid_products, a, "aisle_id"), d, "department_id")
    return joined.select("product_id", "product_name", "aisle_id", "aisle", "department_id", "department")


def q_rule_product_theme(spark, sf_dir):
    return classify_rules(_lin(spark, sf_dir).dim_product).select("product_id", "department", "fallback_product_theme")


def q_rule_demand_type(spark, sf_dir):
    return classify_rules(_lin(spark, sf_dir).dim_product).select("product_id", "product_name", "fallback_demand_type")


def q_classify_labels_fitted(spark, sf_dir):
    products = _lin(spark, sf_dir).dim_product
    return model_table(products, fit_from_rules(classify_rules(products)))


def q_count_by_classification_method(spark, sf_dir):
    return _lin(spark, sf_dir).dim_product_ai.groupBy("classification_method").count()


def q_count_fact_by_classification_method(spark, sf_dir):
    return _lin(spark, sf_dir).fact.groupBy("classification_method").agg(F.count(F.lit(1)).alias("line_count"))


def q_quarantine_order_lines(spark, sf_dir):
    r = _lin(spark, sf_dir).raw
    return silver.quarantine_order_lines(text_lines(r.order_products_prior), text_lines(r.order_products_train))


def q_filter_not_null(spark, sf_dir):
    return _lin(spark, sf_dir).fact.filter(F.col("product_id").isNotNull() & F.col("order_number").isNotNull()) \
        .select("order_id", "product_id", "order_number")


def _fact_lines(spark, sf_dir):
    return _lin(spark, sf_dir).fact.filter(F.col("product_id").isNotNull())


def q_agg_count_by_department(spark, sf_dir):
    return _lin(spark, sf_dir).fact.groupBy("department").agg(F.count(F.lit(1)).alias("line_count"))


def q_agg_sum_reordered(spark, sf_dir):
    return _fact_lines(spark, sf_dir).groupBy("product_id").agg(F.sum("reordered").alias("reordered_units"))


def q_agg_distinct_customers(spark, sf_dir):
    lines = dealt(_fact_lines(spark, sf_dir), _lin(spark, sf_dir).line_tasks, "product_id", "user_id")
    return lines.groupBy("product_id").agg(
        F.count_distinct("user_id").alias("unique_customers"), F.count(F.lit(1)).alias("units"))


def q_agg_avg_cart_position(spark, sf_dir):
    return _fact_lines(spark, sf_dir).groupBy("product_id").agg(F.avg("add_to_cart_order").alias("avg_cart_position"))


def q_distinct_order_numbers(spark, sf_dir):
    return _lin(spark, sf_dir).fact.select("order_number").filter(F.col("order_number").isNotNull()).distinct()


# --------------------------------------------------------------------- gold pieces


def q_latest_snapshot(spark, sf_dir):
    return gold.latest_stock(_lin(spark, sf_dir).inventory).select(
        "inventory_snapshot_number", "product_id", "ending_inventory_qty")


def q_latest_demand(spark, sf_dir):
    return _lin(spark, sf_dir).demand_summary


def q_join_stock_demand(spark, sf_dir):
    L = _lin(spark, sf_dir)
    return L.latest_inventory.select("product_id", "ending_inventory_qty").join(
        L.demand_summary.select("product_id", "avg_units_per_order_window_30"), "product_id", "left")


def q_project_basket_sides(spark, sf_dir):
    f = _lin(spark, sf_dir).fact.filter(F.col("product_id").isNotNull())
    return f.select(
        "order_id", F.col("product_id").alias("product_id_a"),
        *[F.col(c).alias(f"{c}_a") for c in gold.PAIR_ATTRIBUTES])


def q_join_self_pairs(spark, sf_dir):
    L = _lin(spark, sf_dir)
    counts = L.reorder.select("product_id", F.col("total_units_ordered").alias("n"))
    return gold.co_purchase_counts(gold.basket_lines(L.fact), product_counts=counts)


# ----------------------------------------------------------------------- dashboard


def _dash(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        L = _lin(spark, sf_dir)
        return dashboard.dashboard_query(name, L.table)

    return q


QUERIES: dict[str, Query] = {
    # 2.1 sources
    "bronze_products": q_bronze_products,
    "raw_file_inventory": q_raw_file_inventory,
    "raw_row_counts": q_raw_row_counts,
    "landing_latest_partition": q_landing_latest_partition,
    "landing_merge": q_landing_merge,
    "landing_report": q_landing_report,
    "landing_totals": q_landing_totals,
    "quarantine_csv_rows": q_quarantine_csv_rows,
    "csv_line_accounting": q_csv_line_accounting,
    "bronze_products_valid": q_bronze_products_valid,
    "raw_preview": q_raw_preview,
    "bronze_counts": q_bronze_counts,
    "stream_bronze_counts": q_stream_bronze_counts,
    # 2.2 sinks, catalog, maintenance
    "write_read_roundtrip": q_write_read_roundtrip,
    "safe_overwrite": q_safe_overwrite,
    "catalog_listing": q_catalog_listing,
    "compact_table": q_compact_table,
    "cluster_table": q_cluster_table,
    "final_validation": q_final_validation,
    # 2.3 - 2.9 primitives and silver datasets
    "products_clean": _from("products_clean"),
    "quarantine_products": _from("quarantine"),
    "dim_aisle": _from("dim_aisle"),
    "dim_department": _from("dim_department"),
    "join_left_lookup": q_join_left_lookup,
    "dim_product": _from("dim_product"),
    "rule_product_theme": q_rule_product_theme,
    "rule_demand_type": q_rule_demand_type,
    "topk_sample_products": _from("sample"),
    "classify_labels": _from("product_labels"),
    "classify_labels_fitted": q_classify_labels_fitted,
    "classify_overlay": _from("dim_product_ai", "product_id", "ai_product_theme", "ai_demand_type",
                              "classification_method"),
    "dim_product_ai": _from("dim_product_ai"),
    "count_by_classification_method": q_count_by_classification_method,
    "union_prior_train": q_union_prior_train,
    "join_inner_orders": q_join_inner_orders,
    "dedup_order_product": q_dedup_order_product,
    "fact_order_products": _from("fact"),
    "quarantine_order_lines": q_quarantine_order_lines,
    "count_fact_by_classification_method": q_count_fact_by_classification_method,
    "filter_not_null": q_filter_not_null,
    "agg_count_by_department": q_agg_count_by_department,
    "agg_sum_reordered": q_agg_sum_reordered,
    "agg_distinct_customers": q_agg_distinct_customers,
    "agg_avg_cart_position": q_agg_avg_cart_position,
    "distinct_order_numbers": q_distinct_order_numbers,
    # gold
    "daily_product_demand": _from("demand"),
    "window_sum_7": _from("demand", "order_number", "product_id", "units_sold", "units_sold_7_orders"),
    "window_sum_30": _from("demand", "order_number", "product_id", "units_sold", "units_sold_30_orders",
                           "avg_units_per_order_window_30"),
    "reorder_metrics": _from("reorder"),
    "reorder_rate": _from("reorder", "product_id", "total_units_ordered", "total_reordered_units", "reorder_rate"),
    "fact_inventory_snapshots": _from("inventory"),
    "join_cross_grid": _from("inventory", "inventory_snapshot_number", "product_id"),
    "join_composite_left": _from("inventory", "inventory_snapshot_number", "product_id", "units_sold",
                                 "reordered_units"),
    "window_cumulative_stock": _from("inventory", "inventory_snapshot_number", "product_id", "cumulative_units_sold",
                                     "cumulative_restock_qty", "ending_inventory_qty"),
    "latest_snapshot": q_latest_snapshot,
    "latest_demand": q_latest_demand,
    "join_stock_demand": q_join_stock_demand,
    "stockout_risk": _from("stockout"),
    "overstock_alerts": _from("overstock"),
    "project_basket_sides": q_project_basket_sides,
    "join_self_pairs": q_join_self_pairs,
    "basket_affinity": _from("pairs"),
    # 2.12 dashboard
    **{name: _dash(name) for name in dashboard.DASHBOARDS},
}

# Rows-only check: catalog contents have no SQL counterpart.
ROWS_ONLY = {"catalog_listing"}
