"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the existing session."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # window stages are CPU-bound: keep them spread over the cores on small inputs
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Only a single-process local session
    may do without: it gets a scratch folder. On a cluster an unset folder is an error,
    because executors would write to their own disks.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf)
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


# Fixed value: the setting by which Spark removes a query's shuffle files when the query ends.
CLEAN_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Within it, a write leaves its table alone on the disks: the shuffle files behind it go when it ends."""
    before = spark.conf.get(CLEAN_SHUFFLE)
    spark.conf.set(CLEAN_SHUFFLE, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLE, before)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished fits now: it does so when the driver collects its garbage,
    by itself every half hour (``spark.cleaner.periodicGC.interval``)."""
    spark.sparkContext._jvm.System.gc()


def written(df, name: str):
    """``df`` written to the shared folder and read back: computed once, pruned on every later read,
    and a lost executor restarts from the table."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
