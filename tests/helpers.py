"""Small literal fact tables for edge-case tests."""

from pyspark.sql import DataFrame, SparkSession

SF_SMALL = "/root/testdata/sf0.001"

FACT_SCHEMA = (
    "order_id int, user_id int, product_id int, order_number int, reordered int, add_to_cart_order int"
)
ATTR_SCHEMA = "product_id int, product_name string, aisle string, department string, " \
              "ai_product_theme string, ai_demand_type string"


def fact(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows of (order_id, user_id, product_id, order_number[, reordered, cart])."""
    full = [tuple(r) + (0, 1)[len(r) - 4:] if len(r) < 6 else tuple(r) for r in rows]
    return spark.createDataFrame(full, FACT_SCHEMA)


def attrs(spark: SparkSession, product_ids, missing=()) -> DataFrame:
    rows = [(p, f"name {p}", "aisle", "dept", "theme", "type") for p in product_ids if p not in missing]
    return spark.createDataFrame(rows, ATTR_SCHEMA)
