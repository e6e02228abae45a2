"""Reruns of a layered run: what is done is not done again."""

import threading

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from larder.operators import gold
from larder.plans import medallion
from larder.plans.ledger import StepLedger, run_steps
from larder.plans.lineage import Lineage
from larder.sources import landing


def entries(spark, out):
    rows = StepLedger(spark, f"{out}/_ledger").entries().orderBy("finished_ns").collect()
    return [r.step for r in rows], {r.step: r.location for r in rows}


def record_reads(monkeypatch, read):
    """Note under each step's folder the files that its plan scans."""
    def noted(write, place):
        def f(df, *a, **k):
            read[a[place]] = df.inputFiles()
            return write(df, *a, **k)
        return f

    monkeypatch.setattr(medallion, "write_layer", noted(medallion.write_layer, 1))
    monkeypatch.setattr(medallion, "write_version", noted(medallion.write_version, 0))


def test_a_stopped_run_goes_on_and_a_landing_rebuilds_what_depends_on_it(spark, tmp_path, monkeypatch):
    root, out, read = str(tmp_path / "landing"), str(tmp_path / "layers"), {}
    landing.land_all(Lineage(spark, SF_SMALL).raw.as_dict(), root, "2024-01-01")
    record_reads(monkeypatch, read)

    def lost(*_, **__):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(gold, "reorder_metrics", lost)
        with pytest.raises(RuntimeError, match="lost"):
            medallion.run_layers(spark, root, out, sample_size=20, workers=1)
    steps, at = entries(spark, out)
    assert "fact" in steps and "reorder" not in steps and "pairs" not in steps

    counts = medallion.run_layers(spark, root, out, sample_size=20, maintain=True)
    # the inputs that a step states are all the steps that it reads
    assert len(read) == len(medallion.STEP_INPUTS)
    step_of = {path.rsplit("/", 1)[-1]: s for s in medallion.STEP_INPUTS
               for path in read if path.endswith("/" + medallion.LAYER_TABLES.get(s, (0, s))[1].replace("rejected", "bronze_rejected"))}
    for path, files in read.items():
        sources = {step_of[f.split(out)[1].split("/")[2]] for f in files if out in f}
        assert sources <= set(medallion.STEP_INPUTS[step_of[path.rsplit("/", 1)[-1]]]), path
    again, now = entries(spark, out)
    assert sorted(set(again)) == sorted(medallion.STEP_INPUTS)
    assert all(now[s] == at[s] for s in steps if medallion.LAYER_TABLES.get(s, ("",))[0] != "gold")
    assert all(again.count(s) == 1 for s in steps if medallion.LAYER_TABLES.get(s, ("",))[0] != "gold")
    assert counts["grocery_silver.fact_order_products"] == spark.table("grocery_silver.fact_order_products").count()

    # nothing changed: nothing is written, though maintenance moved the gold tables
    assert medallion.run_layers(spark, root, out, sample_size=20, maintain=True) == counts
    assert entries(spark, out) == (again, now)

    aisle = spark.createDataFrame([("900", "new aisle")], "aisle_id string, aisle string")
    landing.land_entity(aisle, root, "aisles", "2024-01-02")
    more = medallion.run_layers(spark, root, out, sample_size=20)
    third, _ = entries(spark, out)
    rebuilt = set(third[len(again):])
    assert {"bronze_aisles", "dim_aisle", "dim_product", "fact", "pairs"} <= rebuilt
    assert not rebuilt & {"bronze_orders", "fact_orders", "dim_department", "bronze_products", "quarantine"}
    assert more["grocery_silver.dim_aisle"] == counts["grocery_silver.dim_aisle"] + 1

    # files that are gone are made again
    spark.sql("DROP TABLE grocery_silver.dim_department")
    medallion.run_layers(spark, root, out, sample_size=20)
    assert "dim_department" in entries(spark, out)[0][len(third):]


def test_steps_run_side_by_side_and_stop_at_a_failure(spark):
    both = threading.Barrier(2, timeout=60)
    pools = {}

    def run(step):
        pools[step] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if step in ("b", "c"):
            both.wait()  # passes only if the two are there at the same time
        assert spark.range(3).agg(F.sum("id")).first()[0] == 3

    order = run_steps(spark, {"d": ["b", "c"], "b": ["a"], "c": ["a", "outside"], "a": []}, run, workers=2)
    assert order[0] == "a" and order[-1] == "d" and set(order) == set("abcd")
    assert pools == {s: s for s in "abcd"}

    seen = []

    def broken(step):
        seen.append(step)
        if step == "a":
            raise KeyError("a")

    with pytest.raises(KeyError):
        run_steps(spark, {"a": [], "b": ["a"]}, broken)
    assert seen == ["a"]
    with pytest.raises(ValueError, match="wait for one another"):
        run_steps(spark, {"a": ["b"], "b": ["a"]}, broken)
    assert run_steps(spark, {}, broken) == []
