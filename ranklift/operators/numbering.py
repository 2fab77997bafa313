"""Exact row numbering without funnelling a group (or the table) into one task.

``dense_index``: 0-based index of each distinct value in sorted order. A range
repartition gives each task a contiguous sorted slice; the per-task counts (one
row per task) are turned into offsets. No single-partition window.

``number_within``: 1-based row number inside each group under the total order
``(h, order...)`` where ``h`` is a 60-bit md5 prefix of the row. Groups are split into contiguous
``h`` ranges of about ``rows_per_bucket`` rows (most groups: one range) that are numbered in
parallel and stitched with per-bucket offsets, so a
group holding a third of all rows still spreads over many tasks. The numbering
does not depend on the bucket size.

``rank_by_range``: 1-based row number inside each group under any order, for groups too large for
a task: the rows are dealt in (group, order) ranges, sorted and counted there, and the counts of
earlier ranges are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def dense_index(values: DataFrame, columns, index_col: str = "idx", partitions: int | None = None) -> DataFrame:
    """``(*columns, index_col)``: 0-based rank of each distinct key in sorted order."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    spark = values.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    not_null = None
    for c in cols:
        cond = F.col(c).isNotNull()
        not_null = cond if not_null is None else (not_null & cond)
    distinct = values.select(*cols).where(not_null).distinct()
    # Explicit partition count: AQE leaves REPARTITION_BY_NUM alone, so each task
    # holds one contiguous, sorted key range.
    ranged = distinct.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_local", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    # Materialise once (reliable checkpoint in the shared checkpoint dir) so the
    # counts and the rows see the same partitioning, and lineage is cut.
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1))).alias("_off")
    ).fillna(0, ["_off"])
    # One row per task: a proven bound, so broadcast.
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.select(*cols, (F.col("_off") + F.col("_local")).alias(index_col))


def rank_by_range(df: DataFrame, group: list[str], order: list[Column], rank_col: str, partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` (1-based, by ``order`` within ``group``) without a task per group.

    Meant for few, large groups: the running counts have a row for each range and each group
    that begins in it, and are broadcast. Rows equal in ``order`` are told apart by their place, so that
    copies of a row are dealt over ranges too.
    """
    from ..session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(c) for c in group), *order, F.col("_copy")]
    ranged = df.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_copy")
    # Written once, so that the counts and the rows see the same ranges.
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33))
    runs = ranged.groupBy(*group, "_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1))
    starts = runs.select(*group, "_pid", (F.coalesce(before, F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    out = ranged.join(F.broadcast(starts), [*group, "_pid"])
    return out.withColumn(rank_col, F.col("_mid") + F.col("_shift")).drop("_mid", "_pid", "_shift")


def row_hash(*cols: Column) -> Column:
    """60-bit md5 prefix of ``concat_ws('|', cols)`` (same value in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("bigint")


def number_within(
    df: DataFrame,
    group: list[str],
    order: list[str],
    hash_col: str = "_h",
    rows_per_bucket: int = 1_000_000,
    rn_col: str = "rn",
    size_col: str = "group_rows",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add ``rn_col`` (1-based, order ``(hash_col, *order)``) and ``size_col`` per group.

    ``df`` must already carry ``hash_col`` (see ``row_hash``). ``sizes`` may pass
    in the per-group row counts ``(*group, size_col)`` when the caller has them.
    """
    if sizes is None:
        sizes = group_sizes(df, group, size_col)
    sized = df.join(sizes, group)  # many-to-one; partial aggregation kept sizes small
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col(size_col) / F.lit(float(rows_per_bucket)))).cast("bigint")
    bucketed = sized.withColumn("_bucket", F.least(F.floor(F.col(hash_col) / F.lit(float(1 << 60)) * n_buckets).cast("bigint"), n_buckets - 1))
    w = W.partitionBy(*group, "_bucket").orderBy(hash_col, *order)
    local = bucketed.withColumn("_local", F.row_number().over(w))
    bucket_sizes = bucketed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_bn"))
    offsets = bucket_sizes.select(
        *group,
        "_bucket",
        F.coalesce(
            F.sum("_bn").over(W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    out = local.join(offsets, [*group, "_bucket"])
    return out.withColumn(rn_col, (F.col("_off") + F.col("_local")).cast("bigint")).drop("_bucket", "_local", "_off")


def group_sizes(df: DataFrame, group: list[str], size_col: str = "group_rows") -> DataFrame:
    """Rows per group (map-side partial counts, so hot groups are combined early)."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(size_col))
