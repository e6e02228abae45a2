"""Landings folded one at a time, against the same rule over all of them in Python."""

import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larder.sources import landing, landing_merge

COLUMNS = landing.RAW_SCHEMAS["order_products_prior"]
ENTITY = "order_products_prior"


def land(spark, root, date, rows):
    landing.land_entity(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS)), root, ENTITY, date)


def rows_of(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS, F.col("ingestion_date").cast("string")).collect()], key=str)


def expected(landings):
    newest = {}
    for date, rows in landings.items():
        for r in rows:
            key = r[:2] if None not in r[:2] else r
            newest[key] = max(date, newest.get(key, ""))
    return sorted([(*r, d) for d, rows in landings.items() for r in rows if newest[r[:2] if None not in r[:2] else r] == d], key=str)


def some_rows(seed):
    rng = random.Random(seed)
    value = [None, "1", "2", "3"]
    rows = [tuple(rng.choice(value) for _ in COLUMNS) for _ in range(60)]
    return rows + rows[:5] + [(None,) * 4, ("1", "1", "9", str(seed))]


LANDINGS = {f"2024-01-0{d}": some_rows(d) for d in (1, 2, 3)}


@pytest.mark.parametrize("order", [[["2024-01-01"], ["2024-01-02"], ["2024-01-03"]], [["2024-01-03"], ["2024-01-01", "2024-01-02"]],
                                   [["2024-01-01", "2024-01-02", "2024-01-03"]]])
def test_the_rows_do_not_depend_on_the_calls(spark, tmp_path, order):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    assert rows_of(landing_merge.fold_landings(spark, root, ENTITY, state)) == []
    for dates in order:
        for d in dates:
            land(spark, root, d, LANDINGS[d])
        got = landing_merge.fold_landings(spark, root, ENTITY, state)
    assert rows_of(got) == expected(LANDINGS)
    assert landing_merge.folded_landings(spark, state) == sorted(itertools.chain(*order))


def test_only_new_landings_are_read_and_a_lost_fold_leaves_the_rows(spark, tmp_path, monkeypatch):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    land(spark, root, "2024-01-01", LANDINGS["2024-01-01"])
    before = rows_of(landing_merge.fold_landings(spark, root, ENTITY, state))
    land(spark, root, "2024-01-02", LANDINGS["2024-01-02"])

    plans, real = [], landing_merge.merged

    def lost(current, landed, *a):
        plans.append(landed.inputFiles())
        return real(current, landed, *a).withColumn("reordered", F.raise_error(F.lit("lost")).cast("string"))

    with monkeypatch.context() as m:
        m.setattr(landing_merge, "merged", lost)
        with pytest.raises(PySparkException, match="lost"):
            landing_merge.fold_landings(spark, root, ENTITY, state)
    assert plans[0] and all("ingestion_date=2024-01-02" in f for f in plans[0])
    assert rows_of(landing_merge.current_rows(spark, state, ENTITY)) == before
    assert landing_merge.folded_landings(spark, state) == ["2024-01-01"]

    two = {d: LANDINGS[d] for d in ("2024-01-01", "2024-01-02")}
    after = landing_merge.fold_landings(spark, root, ENTITY, state)
    assert rows_of(after) == expected(two)
    # nothing new: the same files
    assert landing_merge.fold_landings(spark, root, ENTITY, state).inputFiles() == after.inputFiles()


def test_a_landing_that_is_not_late_takes_one_join(spark, tmp_path):
    root = str(tmp_path / "in")
    land(spark, root, "2024-01-01", LANDINGS["2024-01-01"])
    land(spark, root, "2024-01-02", LANDINGS["2024-01-02"])
    current, landed = (landing_merge.read_dates(spark, root, ENTITY, [d]) for d in ("2024-01-01", "2024-01-02"))
    plan = landing_merge.merged(current, landed, ENTITY, late=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
