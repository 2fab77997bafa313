"""Sources (S1, S2): typed scans of the two event tables, day-partitioned or plain.

Production tables are read with an explicit schema; Catalyst pushes the date and
token filters of the cleaning step into the scan (``PushedFilters``) and prunes
unused columns (``ReadSchema``). ``write_partitioned`` lays a table out by day (or month); the
scans of such a table take the window and turn it into a predicate on the partition
column, so the files of other days are not even listed as input (``PartitionFilters``); with
``days`` (a frame, say the holidays of a calendar) the partitions are picked at run time by dynamic
partition pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Window

#: Partition column and the width of its YYYYMMDD prefix, by grain.
GRAINS = {"day": ("part_day", 8), "month": ("part_month", 6)}


def read_table(spark: SparkSession, path_or_name: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """Read a path (with an explicit schema) or a catalog table name (``db.table``)."""
    is_path = "/" in path_or_name or ":" in path_or_name or path_or_name.endswith((".parquet", ".orc", ".csv", ".json"))
    if not is_path:
        return spark.table(path_or_name)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path_or_name)


def _day_key(df: DataFrame, day_col: str) -> Column:
    """``YYYYMMDD`` of a string or date column."""
    return F.col(day_col) if dict(df.dtypes)[day_col] == "string" else F.date_format(day_col, "yyyyMMdd")


def write_partitioned(df: DataFrame, path: str, day_col: str, grain: str = "day", files_per_part: int = 1) -> str:
    """Write ``df`` as Parquet partitioned by the day (or month) of ``day_col``.

    The rows of a partition are dealt over ``files_per_part`` files, so that one heavy day is not
    written by one task.
    """
    column, width = GRAINS[grain]
    out = df.withColumn(column, F.substring(_day_key(df, day_col), 1, width))
    keys = [F.col(column)]
    if files_per_part > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(int(files_per_part))))
    out.repartition(*keys).write.mode("overwrite").partitionBy(column).parquet(path)
    return path


def _grain_of(df: DataFrame) -> str | None:
    return next((g for g, (c, _) in GRAINS.items() if c in df.columns), None)


def _scan(spark: SparkSession, source: str | DataFrame, schema, day_col: str, window: Window | None, days: DataFrame | None) -> DataFrame:
    df = source if isinstance(source, DataFrame) else read_table(spark, source, _with_part(spark, source, schema))
    grain = _grain_of(df)
    if window is not None:
        if grain:
            column, width = GRAINS[grain]
            df = df.where(F.col(column).between(window.start[:width], window.end[:width]))
        if dict(df.dtypes)[day_col] == "string":
            df = df.where(F.col(day_col).between(window.start, window.end))
        else:
            df = df.where(F.col(day_col).between(F.to_date(F.lit(window.start_iso)), F.to_date(F.lit(window.end_iso))))
    if days is not None:
        # A calendar has at most 366 days a year, so it is broadcast; the check of the days' form is
        # also the filter without which Spark does not prune by it.
        named = F.broadcast(days.select(F.col(days.columns[0]).alias("_day")).where(F.length("_day") == 8).distinct())
        if grain:
            column, width = GRAINS[grain]
            parts = named.select(F.substring("_day", 1, width).alias(column)).distinct()
            df = df.join(F.broadcast(parts), column, "left_semi")
        df = df.withColumn("_day", _day_key(df, day_col)).join(named, "_day", "left_semi")
    return schemas.conform(df, schema)


def _with_part(spark: SparkSession, source: str, schema):
    """``schema`` plus the partition column, if the table at ``source`` is partitioned."""
    from pyspark.sql import types as T

    if "/" not in source:
        return schema
    hadoop_path = source.rstrip("/")
    found = spark.read.parquet(hadoop_path).schema.fieldNames()
    part = [c for c, _ in GRAINS.values() if c in found]
    return T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in part)])


def scan_cart_events(spark: SparkSession, source: str | DataFrame, window: Window | None = None, days: DataFrame | None = None) -> DataFrame:
    """Cart events of a path, table or frame; of the days of ``window``, or of the first
    column (``YYYYMMDD``) of ``days``, if given."""
    return _scan(spark, source, schemas.CART_EVENTS, "event_dt", window, days)


def scan_impressions(spark: SparkSession, source: str | DataFrame, window: Window | None = None, days: DataFrame | None = None) -> DataFrame:
    """Search results likewise."""
    return _scan(spark, source, schemas.SEARCH_RESULTS, "SCL_CREATED_DATE", window, days)
