"""A task's rows do not grow with the tables: steps over the order lines are dealt over as many tasks as their rows need."""

import glob
import math

import pytest
from helpers import ATTR_SCHEMA, FACT_SCHEMA, SF_SMALL, attrs, fact
from pyspark.sql import functions as F

from larder.functions import dealt, task_count
from larder.operators import gold, silver
from larder.operators.sequence import sequence_within
from larder.plans import lineage as lineage_module
from larder.plans.lineage import Lineage, comparable
from larder.sources import fixture

ROWS = 150  # of a task


@pytest.fixture(scope="module")
def many(spark):
    """A lineage whose tasks hold few rows."""
    def few(spark, rows):
        return task_count(spark, rows, ROWS)

    patch = pytest.MonkeyPatch()
    patch.setattr(lineage_module, "task_count", few)
    patch.setattr(fixture, "task_count", few)
    made = Lineage(spark, SF_SMALL)
    made.fact, made.demand, made.reorder, made.pairs
    yield made
    patch.undo()


def _rows(df):
    df = comparable(df)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_number_of_tasks(spark):
    assert task_count(spark, 0) is None and task_count(spark, 600_000) is None
    assert task_count(spark, 36_000_000) == 120 and task_count(spark, 216_000_000) == 720
    assert task_count(spark, 5, 1) == 8  # not fewer than the session's shuffle partitions
    df = spark.range(100)
    assert dealt(df, None, "id") is df and dealt(df, 30, "id").rdd.getNumPartitions() == 30


@pytest.mark.parametrize("name", ["raw.orders", "raw.order_products_prior", "raw.order_products_train", "fact", "demand", "reorder", "pairs"])
def test_same_rows_by_many_tasks(lineage, many, name):
    got, want = many, lineage
    for part in name.split("."):
        got, want = getattr(got, part), getattr(want, part)
    assert _rows(got) == _rows(want)


def test_buckets_follow_the_rows(spark, many):
    """As many buckets as tasks, one file each (an empty bucket has none), of about ``ROWS`` rows."""
    lines = many.fact.count()
    assert many.line_tasks == many.fact_buckets == math.ceil(many._line_files.count() / ROWS) > 8
    per_file = [r["count"] for r in many.fact.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == len(glob.glob(f"{many.root.removeprefix('file:')}/fact/part-*")) <= many.fact_buckets
    assert sum(per_file) == lines and max(per_file) < 3 * ROWS


def test_pairs_dealt_before_counting(spark, lineage):
    """More pairs than fit the planner's partitions are dealt by both ids, and only once counted."""
    lines = gold.basket_lines(lineage.fact)
    want = _rows(gold.co_purchase_counts(lines, 1))
    got = gold.co_purchase_counts(lines, 1, pairs_per_task=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partial_count" in plan.split("REPARTITION_BY_NUM")[0]
    assert _rows(got) == want
    few_products = lines.where("product_id < 5")  # few possible pairs: counted per task as before
    plan = gold.co_purchase_counts(few_products, 1, pairs_per_task=100)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_pairs_of_no_lines_and_null_orders(spark):
    none = spark.createDataFrame([], FACT_SCHEMA)
    assert gold.co_purchase_counts(gold.basket_lines(none), 1).count() == 0
    some = fact(spark, [(None, 1, p, 1) for p in range(5)] + [(1, 1, 1, 1), (1, 1, 2, 1)])
    got = gold.co_purchase_counts(gold.basket_lines(some), 1, giant_basket=3)
    assert _rows(got) == [(1, 1, 2)]


def test_nulls_and_repeats_by_many_tasks(spark):
    rows = [(i % 7 or None, i % 5 or None, i % 3 or None, i % 4 or None, i % 2, i) for i in range(200)] * 2
    f = spark.createDataFrame(rows, FACT_SCHEMA)
    a = attrs(spark, [1, 2])
    assert a.schema == spark.createDataFrame([], ATTR_SCHEMA).schema
    for build in (gold.product_demand, gold.reorder_metrics):
        assert _rows(build(f, a, tasks=13)) == _rows(build(f, a))
    df = spark.createDataFrame([(i % 6 or None, i // 2, i) for i in range(300)], "g int, t int, k int")
    plain, many_tasks = (sequence_within(df, ["g"], ["t", "k"], lag=["t"], tasks=n) for n in (None, 11))
    assert many_tasks.rdd.getNumPartitions() == 11 and _rows(many_tasks) == _rows(plain)


def test_lines_without_user_or_product_are_left_out(spark, tmp_path):
    """As by the join on both: a null is no key.  The first order of (user, product) is of all its lines."""
    li = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate date, l_extendedprice double"
    at = [(o, p, 1, n, None, 1.0) for n, (o, p) in enumerate([(1, 449), (2, 449), (2, 449), (3, 449), (3, None), (4, 449)])]
    spark.createDataFrame(at, li).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(1, 7, 1, "prior"), (2, 7, 2, "train"), (3, None, 1, "train"), (4, 8, None, "train")],
                                   "order_id long, user_id long, order_number int, eval_set string")
    got = fixture.fixture_order_lines(spark, str(tmp_path), orders, modulus=450)
    assert sorted(((r.order_id, r.add_to_cart_order, r.reordered) for r in got.collect()), key=repr) == [
        (1, 1, 0), (2, 1, 1), (2, 2, 1), (4, 1, None)]


def test_a_hot_order_is_split_when_dealt(spark, tmp_path):
    """Half of all lines are one order: found by a sample, it is split although the lines are dealt."""
    lines = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("string").alias("order_id"),
        F.col("id").cast("string").alias("product_id"), F.lit(1).alias("add_to_cart_order"), F.lit(0).alias("reordered"))
    orders = spark.range(40_000).select(
        F.col("id").cast("string").alias("order_id"), F.col("id").alias("user_id"), F.lit("prior").alias("eval_set"),
        F.lit(1).alias("order_number"), F.lit(0).alias("order_dow"), F.lit(0).alias("order_hour_of_day"),
        F.lit(None).cast("double").alias("days_since_prior_order"))
    silver.first_orders(orders).write.parquet(str(tmp_path / "orders"))
    products = spark.createDataFrame([], "product_id long, product_name string, aisle_id int, aisle string, department_id int, "
                                     "department string, ai_product_theme string, ai_demand_type string, classification_method string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = silver.build_fact(lines, lines.limit(0), spark.read.parquet(str(tmp_path / "orders")), products, orders_typed=True, tasks=9, hot_rows=900)
        df = df.select("order_id", "product_id", "user_id")
        assert len(df.collect()) == 40_000
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in text


def test_tasks_of_the_orders_follow_their_rows(many):
    """The first of each order id is found in tasks of about ``ROWS`` orders."""
    orders = many.fact_orders.count()
    assert many.order_tasks == max(8, math.ceil(orders / ROWS))
    per_file = [r["count"] for r in many.fact_orders.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == orders and max(per_file) <= 2 * ROWS and len(per_file) >= many.order_tasks // 2
    plan = silver.first_orders(many.raw.orders, many.order_tasks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == plan.count("Exchange") == 1


def test_lines_are_shuffled_twice(spark, many):
    """By their order for the cart position and the join, then by user and product."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = fixture.fixture_order_lines(spark, SF_SMALL, many.raw.orders)
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(order_id") == 2  # lines and orders
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and plan.count("Exchange") == 3
