"""Session and scratch-space helpers.

Operators never create sessions; tests, the bench and the CLI do.
Scratch output (landed slices, gold round trips, stream checkpoints) goes
under the cluster's shared ``spark.checkpoint.dir``; a local directory is
chosen only for a local master without that setting (tests), and a cluster
without it gets an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "stationflow", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(SESSION_DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint root. Without one, a local folder serves a local master; a cluster must name its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stationflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "stationflow", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "materialized"):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it back.

    For an intermediate read by several operators (the hub aggregate, the
    station dimension): consumers scan the written table instead of
    recomputing from the raw source, with column pruning and filter pushdown,
    and a lost executor recomputes nothing upstream of it. A written table
    computes the data once (an RDD ``checkpoint`` without a cache computes it
    twice); ``localCheckpoint`` is never used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
