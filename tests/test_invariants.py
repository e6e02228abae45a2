"""Invariants of the layers on sf0.001."""

import pytest
from pyspark.sql import functions as F


def test_valid_plus_quarantined_is_products(lineage):
    n_raw = lineage.raw.products.count()
    assert lineage.valid_products.count() + lineage.quarantine.count() == n_raw


def test_fact_unique_per_order_product(lineage):
    f = lineage.fact
    assert f.count() == f.select("order_id", "product_id").distinct().count()


def test_inventory_grid_size(lineage):
    f = lineage.fact
    n_products = f.filter("product_id IS NOT NULL").select("product_id").distinct().count()
    n_numbers = f.filter("order_number IS NOT NULL").select("order_number").distinct().count()
    assert lineage.inventory.count() == n_products * n_numbers


def test_demand_units_sum_to_fact_rows(lineage):
    total = lineage.demand.agg(F.sum("units_sold")).collect()[0][0]
    assert total == lineage.fact.filter("product_id IS NOT NULL").count()


def test_pairs_ordered_and_above_limit(lineage):
    p = lineage.pairs
    assert p.filter("product_id_a >= product_id_b OR co_purchase_count < 10").count() == 0


def test_overstock_has_no_normal_and_stock_non_negative(lineage):
    assert lineage.overstock.filter("overstock_tier = 'NORMAL'").count() == 0
    assert lineage.inventory.filter("ending_inventory_qty < 0").count() == 0


def test_rates_in_unit_interval(lineage):
    assert lineage.demand.filter("reorder_rate < 0 OR reorder_rate > 1").count() == 0
    assert lineage.reorder.filter("reorder_rate < 0 OR reorder_rate > 1").count() == 0


def test_overlay_precedence(lineage):
    ai = lineage.dim_product_ai
    n_model = ai.filter(F.col("classification_method") == "keyword_tfidf_model").count()
    assert n_model == min(lineage.sample_size, lineage.dim_product.filter("product_name IS NOT NULL").count())


def test_latest_inventory_direct_equals_grid_filter(lineage):
    from larder.operators import gold, silver
    from larder.plans.lineage import comparable
    for null_safe in (False, True):
        grid = silver.inventory_snapshots(lineage.fact, lineage.attributes, null_safe=null_safe)
        a = sorted(map(tuple, comparable(gold.latest_stock(grid)).collect()), key=repr)
        b = sorted(map(tuple, comparable(silver.latest_inventory_direct(
            lineage.fact, lineage.attributes, null_safe=null_safe)).collect()), key=repr)
        c = sorted(map(tuple, comparable(silver.latest_inventory_direct(
            lineage.fact, lineage.attributes, null_safe=null_safe, demand=lineage.demand)).collect()), key=repr)
        grid2 = silver.inventory_snapshots(lineage.fact, lineage.attributes, null_safe=null_safe,
                                           demand=lineage.demand)
        assert sorted(map(tuple, comparable(grid2).collect()), key=repr) == \
            sorted(map(tuple, comparable(grid).collect()), key=repr)
        assert a == b == c


@pytest.mark.parametrize("per_block", [1, 7, 2_000])
def test_grid_cells_hold_every_product_and_number_once(spark, lineage, monkeypatch, per_block):
    from larder.operators import silver

    want = {tuple(r) for r in lineage.inventory.select("product_id", "inventory_snapshot_number", "ending_inventory_qty").collect()}
    monkeypatch.setattr(silver, "GRID_BLOCK_PRODUCTS", per_block)
    grid = silver.inventory_snapshots(lineage.fact, lineage.attributes)
    got = [tuple(r) for r in grid.select("product_id", "inventory_snapshot_number", "ending_inventory_qty").collect()]
    assert len(got) == len(want) and set(got) == want
