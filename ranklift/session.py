"""Session helpers.

Library functions never create a session; they take DataFrames. These helpers
are for tests, the bench and the entry point only.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants; the cluster's own values win when already set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Bounded Arrow batches into the block scorer (its rows carry whole blocks).
    "spark.sql.execution.arrow.maxBytesPerBatch": str(256 << 20),
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "ranklift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. A session on one machine without that setting
    (tests) gets a folder of its own; on a cluster its lack is an error, since executors do
    not see each other's disks."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="ranklift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle and checkpoint files of frames nobody holds any more.

    Spark deletes them when the driver's JVM collects the owning objects; a long job of many
    steps would otherwise keep the files of every finished step on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables, beside the checkpoints that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once: what reads them several times plans one scan each, not all steps behind
    them, and the shuffle files of those steps can go."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
