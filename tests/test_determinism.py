"""Same result for different shuffle widths and for the unpruned pair count."""

import itertools
from collections import Counter

from larder.operators import gold
from larder.plans.lineage import Lineage, comparable
from helpers import SF_SMALL


def _rows(df):
    return sorted(map(tuple, comparable(df).collect()), key=repr)


def test_same_result_for_1_and_16_partitions(spark):
    results = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            L = Lineage(spark, SF_SMALL)
            results.append((_rows(L.fact), _rows(L.stockout), _rows(L.pairs), _rows(L.dim_product_ai)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_pruned_pairs_equal_brute_force(lineage):
    lines = lineage.fact.filter("product_id IS NOT NULL").select("order_id", "product_id").collect()
    baskets = {}
    for r in lines:
        baskets.setdefault(r.order_id, set()).add(r.product_id)
    brute = Counter()
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            brute[(a, b)] += 1
    for k, giant in ((1, 5000), (3, 5000), (10, 5000), (1, 2), (3, 3), (10, 1)):
        want = {p: c for p, c in brute.items() if c >= k}
        got = {(r.product_id_a, r.product_id_b): r.co_purchase_count
               for r in gold.co_purchase_counts(gold.basket_lines(lineage.fact), k, giant_basket=giant).collect()}
        assert got == want, (k, giant)
