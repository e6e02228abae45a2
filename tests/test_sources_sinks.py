"""Landing, streaming ingestion, layer writes and validation."""

import pytest
from pyspark.sql import functions as F

from larder.operators import maintenance, validate
from larder.plans import layers
from larder.session import scratch_dir
from larder.sources import landing
from larder.streaming import ingest_new_files


def _products(spark, ids):
    return spark.createDataFrame([(str(i), f"P {i}", "1", "2") for i in ids],
                                 "product_id string, product_name string, aisle_id string, department_id string")


def test_stream_ingests_each_file_once(spark):
    root = scratch_dir(spark, "stream-test-landing")
    out, ckpt = scratch_dir(spark, "stream-test-out"), scratch_dir(spark, "stream-test-ckpt")
    landing.land_entity(_products(spark, range(5)), root, "products", "2024-01-01")
    paths = ingest_new_files(spark, root, out, ckpt, entities=["products"])
    assert spark.read.parquet(paths["products"]).count() == 5
    ingest_new_files(spark, root, out, ckpt, entities=["products"])  # nothing new
    assert spark.read.parquet(paths["products"]).count() == 5
    landing.land_entity(_products(spark, range(5, 8)), root, "products", "2024-01-02")
    ingest_new_files(spark, root, out, ckpt, entities=["products"])  # only the new landing
    assert spark.read.parquet(paths["products"]).count() == 8


def test_landing_report_marks_skipped(spark):
    root = scratch_dir(spark, "report-test")
    landing.land_entity(_products(spark, range(3)), root, "products", "2024-01-01")
    rep = {r.entity: (r.status, r.row_count) for r in landing.landing_report(spark, root).collect()}
    assert rep["products"] == ("uploaded", 3)
    assert rep["orders"] == ("skipped", None)


def test_validation_reports_missing_and_strict_raises(spark):
    root = scratch_dir(spark, "validate-test")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vt_db LOCATION '{root}/vt_db.db'")
    n = layers.write_layer(spark.range(7).withColumn("x", F.lit(1)), "vt_db.present", f"{root}/present")
    assert n == 7
    rows = {r.table_name: (r.row_count, r.status)
            for r in validate.validate_tables(spark, ["vt_db.present", "vt_db.absent"]).collect()}
    assert rows == {"vt_db.present": (7, "OK"), "vt_db.absent": (None, "ERROR: missing")}
    with pytest.raises(validate.ValidationError):
        validate.validate_tables(spark, ["vt_db.absent"], strict=True)


def test_compaction_and_clustering_keep_rows(spark):
    src = scratch_dir(spark, "maint-test") + "/t"
    df = spark.range(5000).select((F.col("id") % 97).alias("product_id"),
                                  (F.col("id") % 7).cast("string").alias("department"), "id")
    df.repartition(20).write.parquet(src)
    want = sorted(map(tuple, df.collect()))
    compacted = maintenance.compact_table(spark, src, src + "_c")
    assert len(compacted.inputFiles()) == 1
    assert sorted(map(tuple, compacted.collect())) == want
    clustered = maintenance.cluster_table(spark, src, src + "_z", ["product_id", "department"])
    assert sorted(map(tuple, clustered.select(*df.columns).collect())) == want


def test_validate_raw(spark):
    root = scratch_dir(spark, "validate-raw-test")
    landing.land_entity(_products(spark, range(9)), root, "products", "2024-01-01")
    out = landing.validate_raw(spark, root)
    assert {r.entity: r.row_count for r in out["counts"].collect()} == {"products": 9}
    assert out["preview_products"].count() == 5
    assert out["files"].agg(F.sum("row_count")).first()[0] == 9


def test_an_empty_landing_root(spark):
    root = scratch_dir(spark, "empty-root")
    rep = landing.landing_report(spark, root)
    assert {r.status for r in rep.collect()} == {"skipped"} and rep.count() == 6
    assert landing.landing_totals(rep).first().asDict() == {"uploaded": 0, "skipped": 6}
    assert landing.file_inventory(spark, root).collect() == [] and landing.row_counts(spark, root).collect() == []


def test_inventory_lists_empty_files(spark):
    root = scratch_dir(spark, "empty-file")
    landing.land_entity(_products(spark, range(3)), root, "products", "2024-01-01")
    landing.land_entity(_products(spark, []).coalesce(1), root, "products", "2024-01-02")
    got = {r.ingestion_date: r for r in landing.file_inventory(spark, root).groupBy("ingestion_date").agg(
        F.sum("row_count").alias("rows"), F.min("file_size").alias("size"), F.first("file_path").alias("path")).collect()}
    assert got["2024-01-01"].rows == 3 and got["2024-01-01"].size > 0
    assert got["2024-01-02"].rows == 0 and got["2024-01-02"].path.endswith(".csv")


def test_increments_and_copies_of_landings(spark):
    root = scratch_dir(spark, "increments")
    landing.land_entity(_products(spark, range(5)), root, "products", "2024-01-01")
    newer = _products(spark, [4, 5]).withColumn("product_name", F.lit("new")).unionByName(
        spark.createDataFrame([(None, "x", "1", "2")], _products(spark, [0]).schema))
    landing.land_entity(newer, root, "products", "2024-01-02")
    rows = landing.read_landing(spark, root, "products").collect()
    assert sorted((r.product_id or "-", r.product_name) for r in rows) == [
        ("-", "x"), ("0", "P 0"), ("1", "P 1"), ("2", "P 2"), ("3", "P 3"), ("4", "new"), ("5", "new")]
    assert landing.read_landing(spark, root, "products", "2024-01-01").count() == 5
    assert landing.read_landing(spark, root, "products", every_version=True).count() == 8


def test_validation_of_an_unreadable_table(spark):
    root = scratch_dir(spark, "unreadable")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vu_db LOCATION '{root}/vu_db.db'")
    layers.write_layer(spark.range(3), "vu_db.good", f"{root}/good")
    spark.range(3).selectExpr("cast(id as string) value").write.text(f"{root}/text")
    spark.sql(f"CREATE TABLE vu_db.bad (x INT) USING parquet LOCATION '{root}/text'")
    rows = {r.table_name: r for r in validate.validate_tables(spark, ["vu_db.bad", "vu_db.good"]).collect()}
    assert rows["vu_db.good"].status == "OK" and rows["vu_db.good"].row_count == 3
    assert rows["vu_db.bad"].status == "ERROR: unreadable" and rows["vu_db.bad"].reason
    assert validate.validate_tables(spark, []).collect() == []


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from larder import session

    class Conf(dict):
        pass

    class Cluster:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        session.scratch_dir(Cluster(), "x")


def _gold_like(spark):
    return spark.range(60_000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 2000).alias("product_id"),
        F.element_at(F.array(*[F.lit(d) for d in ("bakery", "dairy", "frozen", "household", "pets", "produce", "snacks", "zero")]),
                     ((F.col("id") * 31) % 8 + 1).cast("int")).alias("department"), F.col("id"))


def test_clustering_lets_scans_skip_files(spark):
    src = scratch_dir(spark, "prune") + "/t"
    _gold_like(spark).repartition(8).write.parquet(src)
    size = maintenance.table_bytes(spark, src)
    clustered = maintenance.cluster_table(spark, src, src + "_z", ["product_id", "department"], target_file_bytes=size // 16)
    assert clustered.count() == 60_000 and clustered.filter("product_id is null").count() == 1200
    for department in ("bakery", "household", "zero"):
        files, admitted, holding = maintenance.admitted_files(spark, src + "_z", "department", department)
        assert files >= 12 and holding <= files // 2 and admitted <= holding + 2
    files, admitted, holding = maintenance.admitted_files(spark, src + "_z", "product_id", 777)
    assert admitted <= files // 2 + 1


def test_compaction_does_not_shuffle_and_keeps_partitions(spark):
    src = scratch_dir(spark, "compact") + "/t"
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("p"))
    df.repartition(12).write.partitionBy("p").parquet(src)
    out = maintenance.compact_table(spark, src, src + "_c", partition_by=["p"])
    assert sorted(map(tuple, out.select("id", "p").collect())) == sorted(map(tuple, df.collect()))
    assert len(out.inputFiles()) == 3 and all("/p=" in f for f in out.inputFiles())


def test_maintained_tables_point_to_their_new_files(spark):
    root = scratch_dir(spark, "maintain")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mt_db LOCATION '{root}/mt_db.db'")
    layers.write_layer(_gold_like(spark).repartition(9), "mt_db.a", f"{root}/a")
    layers.write_layer(_gold_like(spark).repartition(9), "mt_db.b", f"{root}/b")
    moved = maintenance.maintain_tables(spark, ["mt_db.a", "mt_db.b"], {"mt_db.b": ["product_id", "department"]})
    for t in ("mt_db.a", "mt_db.b"):
        got = spark.table(t)
        assert got.count() == 60_000 and len(got.inputFiles()) == 1 and moved[t].split(":")[-1] in got.inputFiles()[0]
