"""The label scorer labels the whole catalogue; only the overlay scores a sample."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from larder import constants as C
from larder.functions import task_count
from larder.operators import classify
from larder.session import scratch_dir

PRODUCTS = "product_id long, product_name string, aisle string, department string"


@pytest.fixture(scope="module")
def tables(spark):
    """Tables of more products than the queries' sample, some parts twice or without a key."""
    root, day = scratch_dir(spark, "labels-test-tables"), dt.datetime(2024, 1, 1)
    keys = [*range(1000), *range(40), None]
    parts = [(k, "p", "b", "t", 1, 1.0) for k in keys]
    orders = [(k, k % 3, "O", 1.0, day, "1-URGENT") for k in range(9)]
    lines = [(k % 9, 30 * k, 1, k, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for k in range(30)]
    for name, rows, schema in (
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                           "o_orderdate timestamp, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                            "l_linestatus string, l_shipdate timestamp"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def _by_sql(root, key):
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root.removeprefix('file:')}/{t}.parquet/*.parquet')")
    return con.sql(E.oracle_sql()[key]).to_arrow_table()


def _rows(table):
    return sorted(zip(*(table.column(c).to_pylist() for c in sorted(table.column_names))))


def test_every_named_product_is_labelled(spark, tables):
    got = E.queries()["classify_labels"](spark, tables)
    named = E.queries()["dim_product"](spark, tables).where("product_name IS NOT NULL")
    ids = sorted(r[0] for r in named.select("product_id").collect())
    assert len(ids) > C.QUERY_SAMPLE_SIZE
    assert sorted(r[0] for r in got.select("product_id").collect()) == ids
    assert {r[0] for r in got.select("classification_method").distinct().collect()} == {C.METHOD_MODEL}
    assert _rows(got.toArrow()) == _rows(_by_sql(tables, "classify_labels"))


@pytest.mark.parametrize("key", ["topk_sample_products", "dim_product_ai"])
def test_the_overlay_keeps_its_sample(spark, tables, key):
    got = E.queries()[key](spark, tables)
    assert _rows(got.toArrow()) == _rows(_by_sql(tables, key))
    scored = got if key == "topk_sample_products" else got.where(f"classification_method = '{C.METHOD_MODEL}'")
    assert scored.count() == C.QUERY_SAMPLE_SIZE


def test_idf_is_of_all_names(spark):
    """Alone, the sample's one name ties at the earlier label; over all names its commoner keyword weighs less."""
    rows = [(1, "milk chips", "a", "d"), *((i, "milk", "a", "d") for i in range(2, 30)), (30, None, "a", "d")]
    dim = spark.createDataFrame(rows, PRODUCTS)
    labels = {r.product_id: r.ai_demand_type for r in classify.model_labels(spark, classify.named_products(dim)).collect()}
    assert labels == {1: "impulse", **dict.fromkeys(range(2, 30), "essential")}
    alone = classify.model_labels(spark, classify.sample_products(dim, 1)).collect()
    assert [(r.product_id, r.ai_demand_type) for r in alone] == [(1, "essential")]


def test_same_labels_by_many_tasks(spark, monkeypatch):
    names = [" ".join(C.FIXTURE_PRODUCT_NAMES[(i * k) % 13] for k in range(1, i % 4 + 2)) for i in range(300)]
    rows = [(i, n, "a", "d") for i, n in enumerate([*names, "", "12 34", None])]
    products = classify.named_products(spark.createDataFrame(rows, PRODUCTS))
    columns = ("product_id", "ai_product_theme", "ai_demand_type")
    want = sorted(map(tuple, classify.model_labels(spark, products).select(*columns).collect()))
    assert len(want) == len(rows) - 1
    monkeypatch.setattr(classify, "task_count", lambda spark, rows: task_count(spark, rows, 20))
    dealt = classify.model_labels(spark, products).select(*columns)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == want
