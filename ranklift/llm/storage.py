"""Cutting lineage and naming the number of reduce groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ranklift.session import ensure_checkpoint_dir, release  # noqa: F401 (release: for the operators)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it from there on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def groups(spark: SparkSession) -> int:
    """Reduce groups of a blob exchange: the session's shuffle partitions, which the cluster
    sizes to its input. More groups mean smaller ones; results do not depend on the number."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
