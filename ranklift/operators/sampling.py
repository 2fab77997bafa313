"""W8 + T2 + J4: exact-n sampling with replacement per search query, top queries.

Per query with ``len`` adds, ``n = floor(len * size)`` draws (queries with
``len * size < 1`` vanish, as in the reference). Draw ``d`` takes row
``1 + md5_u60(seed|query|d) mod len`` of the query's rows numbered by
``(h, fecha, userid, correlation_id, a2c_itemid, a2c_position)`` where ``h`` is
the md5 prefix of the row: deterministic, reproducible in plain SQL, and
distributed (see ``numbering.number_within``).

Draw ids are generated in chunks spread over the cluster, so a query holding a
third of all adds does not expand its draws inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import md5_u60
from .numbering import group_sizes, number_within, row_hash

ORDER = ["fecha", "userid", "correlation_id", "a2c_itemid", "a2c_position"]


def add_row_hash(adds: DataFrame) -> DataFrame:
    return adds.withColumn(
        "_h",
        row_hash(
            F.col("fecha").cast("string"),
            F.col("userid"),
            F.col("correlation_id"),
            F.col("a2c_itemid"),
            F.floor("a2c_position").cast("bigint").cast("string"),
        ),
    )


def sample_per_query(
    adds: DataFrame,
    size: float,
    seed: int = 1,
    rows_per_bucket: int = 1_000_000,
    draws_per_chunk: int = 100_000,
    partitions: int | None = None,
) -> DataFrame:
    """Sampled adds with their draw number ``draw`` (1..n per query)."""
    if not size > 0:
        raise ValueError("size must be > 0")
    spark = adds.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = add_row_hash(adds)
    sizes = group_sizes(hashed, ["search_query"], "_len")
    numbered = number_within(hashed, ["search_query"], ORDER, rows_per_bucket=rows_per_bucket, size_col="_len", sizes=sizes)
    queries = sizes.withColumn("_n", F.floor(F.col("_len").cast("double") * F.lit(float(size))).cast("bigint")).where(
        F.col("_n") > 0
    )
    chunk = F.lit(int(draws_per_chunk))
    chunks = queries.select(
        "search_query",
        "_len",
        "_n",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("_n") / chunk).cast("bigint") - 1)).alias("_c"),
    ).repartition(parts, "search_query", "_c")  # explicit count: AQE will not fold it back to one task
    draws = chunks.select(
        "search_query",
        "_len",
        F.explode(F.sequence(F.col("_c") * chunk + 1, F.least((F.col("_c") + 1) * chunk, F.col("_n")))).alias("draw"),
    ).withColumn(
        "rn",
        F.lit(1)
        + F.pmod(
            md5_u60(F.concat_ws("|", F.lit(str(seed)), F.col("search_query"), F.col("draw").cast("string"))),
            F.col("_len"),
        ),
    )
    picked = draws.select("search_query", "rn", "draw").join(numbered, ["search_query", "rn"])
    return picked.select("fecha", "search_query", "userid", "correlation_id", "a2c_itemid", "a2c_position", "draw")


def top_queries(sampled: DataFrame, n: int) -> DataFrame:
    """The ``n`` queries with most sampled adds (ties by query text)."""
    counts = sampled.groupBy("search_query").agg(F.count("userid").alias("n_adds"))
    top = counts.orderBy(F.col("n_adds").desc(), F.col("search_query")).limit(int(n))
    # At most n rows: a single ordered window over them is bounded.
    return top.withColumn("query_rank", F.row_number().over(W.orderBy(F.col("n_adds").desc(), F.col("search_query"))))


def adds_of_top_queries(sampled: DataFrame, top: DataFrame) -> DataFrame:
    """Semi-join on a list of at most ``n`` queries (broadcast is size-bounded)."""
    return sampled.join(F.broadcast(top.select("search_query")), "search_query", "left_semi")
