"""The layered run: landed CSV → bronze → silver → gold catalog tables.

Each dataset is written once as a table (full overwrite) and every later
step reads the written table, never the upstream plan: the lineage is cut at
each layer, a lost executor recomputes from the last table, and each plan
stays small.  Steps run in true dependency order (fact after labelling;
demand and reorder after the fact; inventory and risk after demand, pairs after
reorder), side by side where they do not depend on one another, and a ledger
lets a rerun skip those that are done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder import constants as C
from larder.functions import expressions, sizing
from larder.operators import classify, gold, sequence, silver
from larder.operators.maintenance import maintain_tables
from larder.plans import lineage
from larder.plans.layers import create_layer_databases, table_location, write_layer, write_version
from larder.plans.ledger import StepLedger, code_version, digest, run_steps
from larder.sources import bronze, landing, rejected
from larder.sources.fixture import RawTables

# lineage dataset -> (layer, table name)
LAYER_TABLES = {
    "dim_aisle": ("silver", "dim_aisle"),
    "dim_department": ("silver", "dim_department"),
    "quarantine": ("silver", "quarantine_malformed_products"),
    "dim_product": ("silver", "dim_product"),
    "dim_product_ai": ("silver", "dim_product_ai"),
    "fact": ("silver", "fact_order_products"),
    "inventory": ("silver", "fact_inventory_snapshots"),
    "demand": ("gold", "daily_product_demand"),
    "reorder": ("gold", "reorder_metrics"),
    "stockout": ("gold", "stockout_risk"),
    "overstock": ("gold", "overstock_alerts"),
    "pairs": ("gold", "basket_affinity"),
}
# The fact is bucketed on order_id: the basket self-join then reads bucket i
# on both sides in one task, with no shuffle of the order lines.
BUCKETED = {"fact": "order_id"}
REJECTED = "rejected_csv_rows"
RAW_OF = {e: f"bronze_{e}" for e in C.RAW_ENTITIES}
# What each step reads: bronze steps read landed files.
STEP_INPUTS = {
    **{step: () for step in RAW_OF.values()},
    REJECTED: (),
    "dim_aisle": (RAW_OF["aisles"],),
    "dim_department": (RAW_OF["departments"],),
    "quarantine": (RAW_OF["products"],),
    "dim_product": (RAW_OF["products"], "dim_aisle", "dim_department"),
    "sample": ("dim_product",),
    "model_labels": ("sample",),
    "dim_product_ai": ("dim_product", "model_labels"),
    "fact_orders": (RAW_OF["orders"],),
    "fact": (RAW_OF["order_products_prior"], RAW_OF["order_products_train"], "fact_orders", "dim_product_ai"),
    "demand": ("fact", "dim_product_ai"),
    "reorder": ("fact", "dim_product_ai"),
    "inventory": ("fact", "dim_product_ai", "demand"),
    "pairs": ("fact", "dim_product_ai", "reorder"),
    "stockout": ("fact", "dim_product_ai", "demand"),
    "overstock": ("fact", "dim_product_ai", "demand"),
}
# Modules whose code decides the rows of a step: a change of one rebuilds all.
DECIDING = (C, expressions, sizing, classify, gold, sequence, silver, lineage, bronze, landing, rejected)


def run_layers(
    spark: SparkSession,
    landing_root: str,
    out_root: str,
    fmt: str = "parquet",
    ingestion_date: str | None = None,
    escape: str | None = None,
    sample_size: int = C.MODEL_SAMPLE_SIZE,
    maintain: bool = False,
    reject_malformed: bool = False,
    resume: bool = True,
    workers: int = 4,
) -> dict[str, int]:
    """Build every table; returns {qualified table: rows it holds}.

    Malformed lines of the landed files are written to a bronze quarantine
    table; with ``reject_malformed`` the bronze tables leave them out, else
    they hold what the CSV reader makes of them.

    Steps whose inputs are there run side by side, ``workers`` at a time.  Each
    finished step is recorded under ``out_root``/_ledger; with ``resume`` a step
    that is recorded for the same inputs, settings and code, and whose files
    are in place, is not run again.  One run at a time for each ``out_root``.

    ``maintain`` compacts the gold tables and clusters two of them afterwards,
    unless no gold table was written.
    Only Parquet tables can be bucketed, so with another ``fmt`` the fact is
    written without buckets and the pair join shuffles it."""
    create_layer_databases(spark, out_root)
    db = C.LAYER_DATABASES
    ledger = StepLedger(spark, f"{out_root}/_ledger")
    settings = [fmt, ingestion_date, escape, sample_size, reject_malformed, code_version(DECIDING)]
    published = {step: ("bronze", step) for step in RAW_OF.values()} | {REJECTED: ("bronze", f"bronze_{REJECTED}")} | LAYER_TABLES
    table_of = {step: f"{db[layer]}.{name}" for step, (layer, name) in published.items()}
    written: set[str] = set()

    def key(step: str) -> str:
        entities = C.RAW_ENTITIES if step == REJECTED else [e for e, s in RAW_OF.items() if s == step]
        files = [landing.landed_files(spark, landing_root, e) for e in entities]
        return digest([settings, files, [ledger.newest(i).version for i in STEP_INPUTS[step]]])

    def read(step: str, location: str) -> DataFrame:
        return spark.table(table_of[step]) if step in table_of else spark.read.format(fmt).load(location)

    def sink(step: str, build: Callable[[], DataFrame]) -> DataFrame:
        made_from = key(step)
        if resume:
            done = ledger.finished(step, made_from, lambda: table_location(spark, table_of[step]) if step in table_of
                                   else ledger.newest(step).location)
            if done:
                return read(step, done.location)
        if step in table_of:
            layer, name = published[step]
            bucket = BUCKETED.get(step) if fmt == "parquet" else None
            buckets = made.fact_buckets if bucket else None  # from the bronze line tables feeding the fact
            rows = write_layer(build(), table_of[step], f"{out_root}/{layer}/{name}", fmt, bucket_by=bucket, buckets=buckets)
            location = table_location(spark, table_of[step])
        else:  # working data of a step, not a published table
            location, rows = write_version(build(), f"{out_root}/work/{step}", fmt)
        ledger.record(step, made_from, location, rows)
        written.add(step)
        return read(step, location)

    def bronze_step(step: str) -> None:
        if step == REJECTED:
            sink(step, lambda: rejected.quarantine_csv(spark, landing_root, escape=escape))
        else:
            entity = step.removeprefix("bronze_")
            sink(step, lambda: bronze.read_bronze(spark, landing_root, entity, ingestion_date, escape, reject_malformed=reject_malformed))

    run_steps(spark, {s: () for s, needs in STEP_INPUTS.items() if not needs}, bronze_step, workers)
    raw = RawTables(**{e: spark.table(table_of[s]) for e, s in RAW_OF.items()})
    made = lineage.Lineage(spark, raw=raw, sink=sink, sample_size=sample_size)
    run_steps(spark, {s: needs for s, needs in STEP_INPUTS.items() if needs}, lambda step: getattr(made, step), workers)
    if maintain and written.intersection(s for s, (layer, _) in LAYER_TABLES.items() if layer == "gold"):
        maintain_tables(spark, C.COMPACTED_TABLES, C.CLUSTERED_TABLES)
        for step, table in table_of.items():  # the same rows in other files
            e, location = ledger.newest(step), table_location(spark, table)
            if location != e.location:
                ledger.record(step, e.key, location, e.rows, e.version)
    return {table: ledger.newest(step).rows for step, table in table_of.items()}
