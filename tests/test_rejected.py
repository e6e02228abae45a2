"""Malformed CSV lines: captured with their text, never cut to fit."""

import pytest

from larder.sources import bronze, landing, rejected

HEADER = "product_id,product_name,aisle_id,department_id"


def land(spark, root, lines, header=None, date="2024-01-01"):
    rejected.land_lines(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), root, "products", date, header)


def found(spark, root, **options):
    rows = rejected.quarantine_csv(spark, root, ["products"], **options).collect()
    return sorted((r.ingestion_date, r.reason, r.raw_line) for r in rows)


def test_lines_with_other_numbers_of_fields(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, ["1,apple,2,3", "2,pear,2", "3,fig,2,3,9", "4", '5,"a, b",2,3', "6,,,", "7,plum,2,3,"])
    assert [x[2] for x in found(spark, root)] == ["2,pear,2", "3,fig,2,3,9", "4", "7,plum,2,3,"]
    valid = bronze.read_bronze(spark, root, "products", reject_malformed=True)
    assert sorted((r.product_id, r.product_name) for r in valid.collect()) == [("1", "apple"), ("5", "a, b"), ("6", None)]
    # a query for one column cuts no line to that column
    assert valid.select("product_id").count() == valid.count() == 3
    account = rejected.line_accounting(spark, root, ["products"]).collect()
    assert [tuple(r) for r in account] == [("products", "2024-01-01", 7, 3, 4)]
    # as the reader alone takes them
    assert bronze.read_bronze(spark, root, "products").count() == 7


def test_files_under_another_header(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, ["1,apple,2,3"])
    land(spark, root, ["2,pear,2,3", "3,x"], header="name,id,aisle,department", date="2024-01-02")
    land(spark, root, ["4,kiwi,2,3"], header="id,name", date="2024-01-03")
    assert found(spark, root) == [
        ("2024-01-02", "header", "2,pear,2,3"), ("2024-01-02", "header", "3,x"),
        ("2024-01-02", "header", "name,id,aisle,department"),
        ("2024-01-03", "header", "4,kiwi,2,3"), ("2024-01-03", "header", "id,name")]
    assert [r.product_id for r in bronze.read_bronze(spark, root, "products", reject_malformed=True).collect()] == ["1"]


def test_quotes(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, ['1,"a ""b"", c",2,3'])
    assert [x[1:] for x in found(spark, root)] == [("field_count", '1,"a ""b"", c",2,3')]  # a backslash escapes by default
    assert found(spark, root, escape='"') == []
    assert landing.read_landing(spark, root, "products", escape='"', reject_malformed=True).first().product_name == 'a "b", c'


def test_nothing_landed(spark, tmp_path):
    root = str(tmp_path)
    assert found(spark, root) == []
    assert bronze.read_bronze(spark, root, "products", reject_malformed=True).collect() == []
    assert rejected.line_accounting(spark, root, ["products"]).collect() == []


def test_newest_rows_of_each_key_without_the_malformed(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, ["1,old,2,3", "2,pear,2,3"])
    land(spark, root, ["1,new,2,3", "2,broken"], date="2024-01-02")
    rows = landing.read_landing(spark, root, "products", reject_malformed=True).collect()
    assert sorted((r.product_id, r.product_name) for r in rows) == [("1", "new"), ("2", "pear")]


@pytest.mark.parametrize("reject", [False, True])
def test_layered_run_keeps_the_rejected_lines(spark, tmp_path, reject):
    from larder.plans import medallion
    from larder.plans.lineage import Lineage

    root, out = str(tmp_path / "landing"), str(tmp_path / "layers")
    landing.land_all(Lineage(spark, "/root/testdata/sf0.001").raw.as_dict(), root, "2024-01-01")
    land(spark, root, ["900001,long,1,1,9", "900002,short"], date="2024-01-02")
    counts = medallion.run_layers(spark, root, out, sample_size=20, reject_malformed=reject)
    assert counts["grocery_bronze.bronze_rejected_csv_rows"] == 2
    ids = {r.product_id for r in spark.table("grocery_bronze.bronze_products").select("product_id").collect()}
    assert ("900001" in ids) is not reject
