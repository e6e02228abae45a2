"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for local runs (tests, bench).  On a cluster the platform's own
# configuration applies; the job code does not depend on these values.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.scheduler.mode": "FAIR",  # steps of a layered run share the cores
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "larder", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` names storage every executor can reach; it is
    read from the session.  Only in local mode is one made here where it is
    unset; a cluster without one is an error, as its executors do not share
    local folders.  Each call returns a new sub-folder, so runs never collide.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="larder-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, "larder", purpose, uuid.uuid4().hex)
