"""Overwrites that can be lost at any time."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larder.plans import layers

TABLE = "versions_test.t"


@pytest.fixture
def path(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS versions_test LOCATION '{tmp_path}/db'")
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")
    yield str(tmp_path / "t")
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")


def ids(spark):
    return sorted(r.id for r in spark.table(TABLE).select("id").collect())


def folders(path):
    return sorted(f for f in os.listdir(path) if f.startswith("v-"))


def test_a_write_killed_half_way_leaves_the_old_rows(spark, path):
    assert layers.write_layer(spark.range(10), TABLE, path) == 10
    held = spark.table(TABLE)
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException, match="lost"):
        layers.write_layer(broken, TABLE, path)
    assert ids(spark) == list(range(10)) and held.count() == 10
    assert spark.sql("SHOW TABLES IN versions_test").count() == 1
    # the next write removes what was left
    layers.write_layer(spark.range(5), TABLE, path)
    assert ids(spark) == list(range(5))
    assert [done for _, done in layers.layer_versions(spark, path)] == [True, True]


def test_files_that_lack_rows_do_not_become_the_table(spark, path, monkeypatch):
    layers.write_layer(spark.range(10), TABLE, path)
    real = layers.Observation

    class Wrong(real):
        @property
        def get(self):
            return {"rows": super().get["rows"] + 1}

    monkeypatch.setattr(layers, "Observation", Wrong)
    with pytest.raises(layers.IncompleteWrite):
        layers.write_layer(spark.range(7), TABLE, path)
    assert ids(spark) == list(range(10))
    assert spark.sql("SHOW TABLES IN versions_test").count() == 1


def test_readers_keep_their_version_until_it_is_old(spark, path):
    layers.write_layer(spark.range(3), TABLE, path, keep=2)
    old = spark.read.parquet(layers.layer_versions(spark, path)[-1][0])
    layers.write_layer(spark.range(4), TABLE, path, keep=2)
    assert old.count() == 3 and len(folders(path)) == 2
    layers.write_layer(spark.range(5), TABLE, path, keep=2)
    assert len(folders(path)) == 2 and ids(spark) == list(range(5))
    layers.write_layer(spark.range(6), TABLE, path, keep=1)
    assert len(folders(path)) == 1


def test_a_table_can_be_overwritten_from_itself(spark, path):
    layers.write_layer(spark.range(6), TABLE, path)
    layers.write_layer(spark.table(TABLE).where("id > 2"), TABLE, path)
    assert ids(spark) == [3, 4, 5]


def test_changes_of_schema_partitioning_and_buckets(spark, path):
    layers.write_layer(spark.range(6), TABLE, path)
    layers.write_layer(spark.range(6).withColumn("x", F.col("id") % 2), TABLE, path)
    assert spark.table(TABLE).columns == ["id", "x"] and ids(spark) == list(range(6))
    layers.write_layer(spark.range(8).withColumn("x", F.col("id") % 2), TABLE, path, partition_by=["x"])
    layers.write_layer(spark.range(9).withColumn("x", F.col("id") % 3), TABLE, path, partition_by=["x"])
    assert ids(spark) == list(range(9)) and spark.table(TABLE).where("x = 2").count() == 3
    for n in (7, 11):
        layers.write_layer(spark.range(n), TABLE, path, bucket_by="id", buckets=4)
        assert ids(spark) == list(range(n))
        assert "Bucketed: true" in spark.table(TABLE).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_a_missing_entry_is_restored_from_the_newest_whole_version(spark, path):
    assert layers.restore_layer(spark, TABLE, path) is None
    layers.write_layer(spark.range(3), TABLE, path)
    layers.write_layer(spark.range(4), TABLE, path)
    spark.sql(f"DROP TABLE {TABLE}")
    os.makedirs(f"{path}/v-99999999999999999999-half")  # never committed
    assert layers.restore_layer(spark, TABLE, path)
    assert ids(spark) == list(range(4))
    assert layers.restore_layer(spark, TABLE, path) is None


def test_an_empty_table(spark, path):
    assert layers.write_layer(spark.range(0), TABLE, path) == 0
    assert ids(spark) == []
