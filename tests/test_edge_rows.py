"""Literal edge rows (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from helpers import attrs, fact
from larder import constants as C
from larder.functions import lenient_int
from larder.operators import classify, gold, silver
from larder.session import scratch_dir
from larder.sources import landing


def test_lenient_key_cast(spark):
    vals = ["12", " 12 ", "+7", "12.5", "1e2", "abc", "", "99999999999", None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x string")
           .select(lenient_int("x")).collect()]
    assert got == [12, 12, 7, None, None, None, None, None, None]


def _write_products_csv(spark, text):
    root = scratch_dir(spark, "csv-test")
    folder = f"{root}/products/ingestion_date=2024-01-01"
    spark.sparkContext.parallelize([text], 1).saveAsTextFile(folder)
    return root


def test_shifted_csv_row_default_escape_quarantines(spark):
    root = _write_products_csv(spark, 'product_id,product_name,aisle_id,department_id\n3,"Bag ""Zip"" 30, large",5,6')
    raw = landing.read_landing(spark, root, "products")
    row = raw.collect()[0]
    assert row.aisle_id == ' large"'
    valid, quarantined = silver.split_quarantine(raw)
    assert valid.count() == 0 and quarantined.count() == 1


def test_shifted_csv_row_with_quote_escape_is_valid(spark):
    root = _write_products_csv(spark, 'product_id,product_name,aisle_id,department_id\n3,"Bag ""Zip"" 30, large",5,6')
    raw = landing.read_landing(spark, root, "products", escape='"')
    valid, quarantined = silver.split_quarantine(raw)
    rows = valid.collect()
    assert quarantined.count() == 0 and rows[0].aisle_id == 5 and rows[0].product_name == 'Bag "Zip" 30, large'


def test_two_landings(spark):
    root = scratch_dir(spark, "landing-test")
    df = spark.createDataFrame([("1", "Milk", "2", "3")], "product_id string, product_name string, "
                               "aisle_id string, department_id string")
    for d in ("2024-01-01", "2024-01-02"):
        landing.land_entity(df, root, "products", d)
    assert landing.read_landing(spark, root, "products", every_version=True).count() == 2
    latest = landing.read_landing(spark, root, "products")
    assert latest.count() == 1
    one = landing.read_landing(spark, root, "products", "2024-01-02")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(ingestion_date" in one._jdf.queryExecution().executedPlan().toString()


def test_substring_rules_first_match(spark):
    df = spark.createDataFrame(
        [(1, "Eggplant", "produce"), (2, "Strawberry Preserves", "pantry"), (3, "Organic Potato Chips", "snacks")],
        "product_id int, product_name string, department string")
    got = {r.product_id: r.fallback_demand_type for r in classify.classify_rules(df).collect()}
    assert got == {1: "health_focused", 2: "premium", 3: "health_focused"}


def test_null_text_defaults(spark):
    df = spark.createDataFrame([(1, None, None)], "product_id int, product_name string, department string")
    r = classify.classify_rules(df).collect()[0]
    assert (r.fallback_product_theme, r.fallback_demand_type) == ("other", "essential")


def _demand_at(spark, numbers, product=1):
    f = fact(spark, [(1000 + n, n, product, n) for n in numbers])
    return {r.order_number: r for r in gold.product_demand(f, attrs(spark, [product])).collect()}


def test_eight_row_window(spark):
    d = _demand_at(spark, range(1, 11))
    assert d[10].units_sold_7_orders == 8


def test_thirty_one_row_window(spark):
    d = _demand_at(spark, range(1, 41))
    assert d[40].units_sold_30_orders == 31
    assert d[40].avg_units_per_order_window_30 == pytest.approx(31 / 30)


def test_sparse_window_uses_rows_that_exist(spark):
    d = _demand_at(spark, [1, 50])
    assert d[50].units_sold_7_orders == 2


def test_deficit_carries_forward(spark):
    # product 1: 600 units at order number 1; product 2 creates numbers 2..10
    rows = [(i, i, 1, 1) for i in range(600)] + [(10_000 + n, 9, 2, n) for n in range(2, 11)]
    inv = silver.inventory_snapshots(fact(spark, rows), attrs(spark, [1, 2]))
    stock = {r.inventory_snapshot_number: r.ending_inventory_qty for r in inv.filter("product_id = 1").collect()}
    assert all(stock[n] == 0 for n in range(1, 10))
    assert stock[10] == 500 + 250 - 600


def test_product_without_dimension(spark):
    rows = [(1, 1, 7, 1), (2, 1, 8, 1)]
    f = fact(spark, rows)
    a = attrs(spark, [7, 8], missing=[8])
    default = {r.product_id: r.units_sold for r in silver.inventory_snapshots(f, a).collect()}
    null_safe = {r.product_id: r.units_sold for r in silver.inventory_snapshots(f, a, null_safe=True).collect()}
    assert default == {7: 1, 8: 0}
    assert null_safe == {7: 1, 8: 1}


def _latest(spark, stock_rows):
    return spark.createDataFrame(
        [(10, p, "n", "a", "d", "t", "y", s, 50) for p, s in stock_rows],
        "inventory_snapshot_number int, product_id int, product_name string, aisle string, department string, "
        "ai_product_theme string, ai_demand_type string, ending_inventory_qty long, reorder_point int")


def _summary(spark, avgs):
    return spark.createDataFrame(
        [(p, "n", "a", "d", "t", "y", a, 0.5) for p, a in avgs],
        "product_id int, product_name string, aisle string, department string, ai_product_theme string, "
        "ai_demand_type string, avg_units_per_order_window_30 double, avg_reorder_rate double")


def test_no_demand_row(spark):
    latest, summary = _latest(spark, [(1, 100)]), _summary(spark, [])
    s = gold.stockout_risk(latest, summary).collect()[0]
    assert (s.stockout_risk_tier, s.priority_score, s.days_of_stock_proxy) == ("OK", 10, None)
    o = gold.overstock_alerts(latest, summary).collect()[0]
    assert (o.overstock_tier, o.days_of_stock_proxy) == ("SEVERE_OVERSTOCK", 999.0)


def test_tier_limits(spark):
    stocks = [(1, 3), (2, 7), (3, 14), (4, 60), (5, 90), (6, 120), (7, 0)]
    latest, summary = _latest(spark, stocks), _summary(spark, [(p, 1.0) for p, _ in stocks])
    so = {r.product_id: r.stockout_risk_tier for r in gold.stockout_risk(latest, summary).collect()}
    assert [so[p] for p in (1, 2, 3, 7)] == ["CRITICAL", "HIGH", "MEDIUM", "STOCKOUT"]
    ov = {r.product_id: r.overstock_tier for r in gold.overstock_alerts(latest, summary).collect()}
    assert [ov[p] for p in (4, 5, 6)] == ["MODERATE_OVERSTOCK", "HIGH_OVERSTOCK", "SEVERE_OVERSTOCK"]
    assert 1 not in ov


def test_duplicate_line_keeps_prior(spark):
    lines = "order_id long, product_id long, add_to_cart_order int, reordered int"
    prior = spark.createDataFrame([(1, 5, 3, 0)], lines)
    train = spark.createDataFrame([(1, 5, 1, 1)], lines)
    orders = spark.createDataFrame([(1, 9, "prior", 1, 0, 0, None)],
                                   "order_id long, user_id long, eval_set string, order_number int, "
                                   "order_dow long, order_hour_of_day long, days_since_prior_order double")
    products = spark.createDataFrame([], "product_id int, product_name string, aisle_id int, aisle string, "
                                     "department_id int, department string, ai_product_theme string, "
                                     "ai_demand_type string, classification_method string")
    rows = silver.build_fact(prior, train, orders, products).collect()
    assert len(rows) == 1 and rows[0].eval_set_source == "prior" and rows[0].add_to_cart_order == 3


def test_pair_order(spark):
    f = fact(spark, [(1, 1, 5, 1), (1, 1, 2, 1), (1, 1, 9, 1)])
    got = sorted((r.product_id_a, r.product_id_b) for r in gold.co_purchase_counts(gold.basket_lines(f), 1).collect())
    assert got == [(2, 5), (2, 9), (5, 9)]


def test_pair_limit(spark):
    rows = [(o, 1, p, 1) for o in range(10) for p in (1, 2)] + [(o, 1, p, 1) for o in range(100, 109) for p in (3, 4)]
    got = {(r.product_id_a, r.product_id_b): r.co_purchase_count
           for r in gold.co_purchase_counts(gold.basket_lines(fact(spark, rows)), 10).collect()}
    assert got == {(1, 2): 10}


def test_rounding_half_up(spark):
    r = spark.sql("SELECT round(1.005D, 2) AS a, round(4.975D, 2) AS b").collect()[0]
    assert (r.a, r.b) == (1.01, 4.98)


def test_score_constants():
    assert [t for t, _, _ in C.STOCKOUT_TIERS] == ["CRITICAL", "HIGH", "MEDIUM"]


def test_duplicate_orders_keep_first_combination(spark):
    lines = "order_id long, product_id long, add_to_cart_order int, reordered int"
    prior = spark.createDataFrame([(1, 5, 2, 0), (1, 5, 1, 1), (1, 6, 3, 0)], lines)
    train = spark.createDataFrame([], lines)
    orders = spark.createDataFrame([(1, 9, "prior", 4, 0, 0, None), (1, 3, "prior", 7, 0, 0, 2.0)],
                                   "order_id long, user_id long, eval_set string, order_number int, "
                                   "order_dow long, order_hour_of_day long, days_since_prior_order double")
    products = spark.createDataFrame([], "product_id int, product_name string, aisle_id int, aisle string, "
                                     "department_id int, department string, ai_product_theme string, "
                                     "ai_demand_type string, classification_method string")
    rows = {r.product_id: r for r in silver.build_fact(prior, train, orders, products).collect()}
    assert len(rows) == 2
    assert (rows[5].add_to_cart_order, rows[5].user_id, rows[5].order_number) == (1, 3, 7)
    assert rows[6].user_id == 3


LINES = "order_id string, product_id string, add_to_cart_order int, reordered int"
ORDERS = ("order_id string, user_id long, eval_set string, order_number int, order_dow long, "
          "order_hour_of_day long, days_since_prior_order double")
PRODUCTS = ("product_id long, product_name string, aisle_id int, aisle string, department_id int, department string, "
            "ai_product_theme string, ai_demand_type string, classification_method string")


def _fact_of(spark, lines, orders):
    prior, none = spark.createDataFrame(lines, LINES), spark.createDataFrame([], LINES)
    products = spark.createDataFrame([], PRODUCTS)
    fact_rows = silver.build_fact(prior, none, spark.createDataFrame(orders, ORDERS), products).collect()
    return fact_rows, silver.quarantine_order_lines(prior, none).collect()


def test_keys_beyond_32_bits_and_rejected_lines(spark):
    big = 3_000_000_000
    lines = [("1", "5", 1, 0), (str(big), str(big + 1), 1, 0), (str(big), str(big + 2), 2, 0), ("x", "5", 1, 0),
             ("1", "5.5", 2, 0), (None, "5", 1, 0), ("1", None, 3, 0)]
    rows, bad = _fact_of(spark, lines, [("1", 9, "prior", 1, 0, 0, None), (str(big), big * 3, "prior", 1, 0, 0, None),
                                        ("y", 1, "prior", 1, 0, 0, None)])
    assert sorted((r.order_id, r.product_id or 0, r.user_id) for r in rows) == [
        (1, 0, 9), (1, 5, 9), (big, big + 1, big * 3), (big, big + 2, big * 3)]
    assert sorted((r.raw_order_id or "", r.raw_product_id) for r in bad) == [("", "5"), ("1", "5.5"), ("x", "5")]
    assert len(rows) + len(bad) == len(lines)


def test_a_value_beats_null_among_duplicates(spark):
    rows, _ = _fact_of(spark, [("1", "5", None, None), ("1", "5", 4, 1)],
                       [("1", None, "prior", None, 0, 0, None), ("1", 7, "prior", 2, 0, 0, None)])
    assert [(r.add_to_cart_order, r.user_id, r.order_number) for r in rows] == [(4, 7, 2)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_lines_without_an_order_number_match_no_snapshot(spark, null_safe):
    f = fact(spark, [(1, 1, 7, 1), (2, 1, 7, 2), (3, 2, 7, None), (4, 2, 8, None)])
    a = attrs(spark, [7, 8])
    grid = silver.inventory_snapshots(f, a, null_safe=null_safe)
    stock = {(r.inventory_snapshot_number, r.product_id): (r.cumulative_units_sold, r.ending_inventory_qty) for r in grid.collect()}
    assert stock == {(1, 7): (1, 499), (2, 7): (2, 498), (1, 8): (0, 500), (2, 8): (0, 500)}
    demand = gold.product_demand(f, a)
    for got in (silver.latest_inventory_direct(f, a, null_safe=null_safe),
                silver.latest_inventory_direct(f, a, null_safe=null_safe, demand=demand)):
        assert {r.product_id: (r.cumulative_units_sold, r.ending_inventory_qty) for r in got.collect()} == {7: (2, 498), 8: (0, 500)}
    risk = gold.stockout_risk(silver.latest_inventory_direct(f, a, demand=demand), gold.latest_demand(demand))
    assert {r.product_id: r.ending_inventory_qty for r in risk.collect()} == {7: 498, 8: 500}
