"""Map the supplied TPC-H-style tables to the six raw retail entities.

The output has the shape the raw CSV landing has after a header read:
orders and order lines carry numbers (what schema inference gives), the
three product-side entities carry strings (so malformed keys can exist).
See FIXTURES.md §2 for the mapping; every step is a Spark job whose work
grows with ``part``, ``orders`` and ``lineitem``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import dealt, task_count
from larder.operators.sequence import sequence_within


def product_of_part(partkey: str | Column, modulus: int) -> Column:
    """``floor(k^3 / modulus^2)`` with ``k = partkey % modulus`` (skews demand)."""
    divisor = modulus * modulus
    k = (F.col(partkey) if isinstance(partkey, str) else partkey) % F.lit(modulus)
    return ((k * k * k) - (k * k * k) % F.lit(divisor)) / F.lit(divisor)


@dataclass
class RawTables:
    """The six raw entities, as DataFrames in landing shape."""

    orders: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in C.RAW_ENTITIES}


def product_modulus(spark: SparkSession, sf_dir: str) -> int:
    """Grows with the number of parts, so that the catalogue does."""
    return max(C.FIXTURE_PRODUCT_MODULUS, _read(spark, sf_dir, "part").count() // C.FIXTURE_PARTS_PER_MODULUS)


def order_id_of(orderkey: str) -> Column:
    """The order key; every few orders get an id beyond 32 bits."""
    k = F.col(orderkey)
    return F.when(k % C.FIXTURE_LARGE_ID_MOD == 0, k + C.FIXTURE_LARGE_ID_ADD).otherwise(k)


def text_lines(lines: DataFrame) -> DataFrame:
    """Order lines as text, as a CSV has them, some with keys that are no numbers."""
    bad = F.col("order_id") % C.FIXTURE_BAD_LINE_MOD
    order, product = F.col("order_id").cast("string"), F.col("product_id").cast("string")
    return lines.withColumns({
        "order_id": F.when(bad == 1, F.concat(F.lit("order "), order)).otherwise(order),
        "product_id": F.when(bad == 2, F.concat(product, F.lit(".5"))).when(bad != 3, product),
    })


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: per-user numbering, gap to the previous order, last = train.

    Numbering, previous date and last-order flag come from one pass of
    ``sequence_within`` (a plain window for ordinary customers; a customer
    with a huge history is split over several tasks).
    """
    tasks = task_count(spark, _read(spark, sf_dir, "orders").count())
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    seq = sequence_within(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], lag=["o_orderdate"], tasks=tasks)
    return seq.select(
        order_id_of("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("_is_last"), F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
        F.col("_seq").alias("order_number"),
        (F.col("o_orderkey") % 7).alias("order_dow"),
        (F.col("o_orderkey") % 24).alias("order_hour_of_day"),
        F.datediff(F.col("o_orderdate"), F.col("_prev_o_orderdate")).cast("double").alias("days_since_prior_order"),
    )


def fixture_order_lines(
    spark: SparkSession,
    sf_dir: str,
    orders: DataFrame,
    modulus: int | None = None,
) -> DataFrame:
    """All order lines with cart position, reorder flag and their order's eval_set.

    Cart positions come from ``sequence_within`` (hot orders are split), dealt by
    the order id that the join with the orders needs, so it shuffles no lines.
    ``reordered`` compares with the user's first order of the
    product, a window over (user, product): the lines are joined and shuffled
    once, where an aggregate joined back did both twice.  Lines without a user
    or product have no such order and are left out.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        order_id_of("l_orderkey").alias("order_id"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice",
    )
    tasks = task_count(spark, li.count())
    carted = sequence_within(
        li, ["order_id", "l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], tasks=tasks,
        deal_by=["order_id"],
    )
    lines = carted.select(
        "order_id",
        product_of_part("l_partkey", modulus or product_modulus(spark, sf_dir)).cast("long").alias("product_id"),
        F.col("_seq").alias("add_to_cart_order"),
    )
    o = orders.select("order_id", "user_id", "order_number", "eval_set").filter(F.col("user_id").isNotNull())
    with_orders = lines.filter(F.col("product_id").isNotNull()).join(dealt(o, tasks, "order_id"), "order_id")
    w = Window.partitionBy("user_id", "product_id")
    first_seen = dealt(with_orders, tasks, "user_id", "product_id").withColumn(
        "first_order_number", F.min("order_number").over(w)
    )
    return first_seen.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.col("first_order_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def fixture_product_ids(
    spark: SparkSession,
    sf_dir: str,
    modulus: int | None = None,
) -> DataFrame:
    return (
        _read(spark, sf_dir, "part")
        .select(product_of_part("p_partkey", modulus or product_modulus(spark, sf_dir)).cast("long").alias("pid"))
        .distinct()
    )


def fixture_products(pids: DataFrame) -> DataFrame:
    """products: one row per product id, all columns as strings."""
    names = F.array(*[F.lit(n) for n in C.FIXTURE_PRODUCT_NAMES])
    pid = F.col("pid")
    return pids.select(
        pid.cast("string").alias("product_id"),
        F.concat(F.element_at(names, (pid % len(C.FIXTURE_PRODUCT_NAMES) + 1).cast("int")), F.lit(" "), pid.cast("string")).alias(
            "product_name"
        ),
        F.when(pid % C.FIXTURE_BAD_AISLE_MOD == C.FIXTURE_BAD_AISLE_REM, F.lit(C.FIXTURE_BAD_AISLE))
        .otherwise((pid % C.FIXTURE_AISLE_COUNT + 1).cast("string"))
        .alias("aisle_id"),
        (pid % len(C.FIXTURE_DEPARTMENTS) + 1).cast("string").alias("department_id"),
    )


def fixture_aisles(pids: DataFrame) -> DataFrame:
    """aisles in use by the products: ``Aisle <id>``."""
    aid = (F.col("pid") % C.FIXTURE_AISLE_COUNT + 1).cast("string")
    return pids.select(aid.alias("aisle_id")).distinct().select(
        "aisle_id", F.concat(F.lit("Aisle "), F.col("aisle_id")).alias("aisle")
    )


def fixture_departments(pids: DataFrame) -> DataFrame:
    """departments in use: upper-case name with one leading space (raw noise)."""
    names = F.array(*[F.lit(n) for n in C.FIXTURE_DEPARTMENTS])
    did = (F.col("pid") % len(C.FIXTURE_DEPARTMENTS) + 1).cast("int")
    return pids.select(did.alias("d")).distinct().select(
        F.col("d").cast("string").alias("department_id"),
        F.concat(F.lit(" "), F.upper(F.element_at(names, F.col("d")))).alias("department"),
    )


def fixture_frames(
    spark: SparkSession,
    sf_dir: str,
    modulus: int | None = None,
) -> dict[str, DataFrame]:
    """orders, all order lines (with ``eval_set``), products, aisles, departments."""
    orders = fixture_orders(spark, sf_dir)
    pids = fixture_product_ids(spark, sf_dir, modulus)
    return {
        "orders": orders,
        "order_lines": fixture_order_lines(spark, sf_dir, orders, modulus),
        "products": fixture_products(pids),
        "aisles": fixture_aisles(pids),
        "departments": fixture_departments(pids),
    }


LINE_COLUMNS = ["order_id", "product_id", "add_to_cart_order", "reordered"]


def split_lines(frames: dict[str, DataFrame]) -> RawTables:
    """RawTables from ``fixture_frames`` output: lines split by their order's eval_set."""
    lines = frames["order_lines"]
    return RawTables(
        orders=frames["orders"],
        order_products_prior=lines.filter(F.col("eval_set") == "prior").select(*LINE_COLUMNS),
        order_products_train=lines.filter(F.col("eval_set") == "train").select(*LINE_COLUMNS),
        products=frames["products"],
        aisles=frames["aisles"],
        departments=frames["departments"],
    )


def raw_tables(
    spark: SparkSession,
    sf_dir: str,
    modulus: int | None = None,
) -> RawTables:
    """All six raw entities derived from the test tables at ``sf_dir``."""
    return split_lines(fixture_frames(spark, sf_dir, modulus))
