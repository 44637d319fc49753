"""Session helpers: a tuned local/cluster session and the shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoints (materialized intermediates) once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "pricelens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE, UTC and Arrow on, UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used
    as is.  Only when it is unset and the master is local is a scratch folder
    created and registered; elsewhere executors could not see it, so that is
    an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="pricelens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Compute ``df`` once into a Parquet folder under the shared checkpoint
    folder and return it read back: lost executors cost no recomputation,
    and the planner sizes (and, if small, broadcasts) it from its files.
    The folder goes when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"materialized-{uuid.uuid4().hex}")
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
