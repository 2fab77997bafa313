"""Fixture sources derived from the bundled TPC-H-style tables.

The reference reads two warehouse tables (cart events, search results) and
trains its own factors. The test data has neither, so these functions derive
them, at full size, from ``lineitem``/``orders``/``part``/``customer``/
``embeddings`` (mapping documented in FIXTURES.md). Every derived row grows with
the input tables; nothing here is sampled or capped.

The ``key % 97`` cases inject the dirty rows the cleaning step must remove (one
case per filter); the ``% 10`` / ``% 20`` rules make some users and items cold
(no factor vector) so the cold-start paths are exercised. Neither is a filter
that shrinks the workload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from . import templates

# Fixed values of the fixture mapping (FIXTURES.md §2).
DIRT_MODULUS = 97
QUERY_BUCKETS = 40
DISTRACTORS = 6
DISTRACTOR_MULT = 31
DISTRACTOR_STEP = 17
DISTRACTOR_SORT_BASE = 10
COLD_USER_EVERY = 10
COLD_ITEM_EVERY = 20


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dirt(orderkey) -> F.Column:
    return F.pmod(orderkey, F.lit(DIRT_MODULUS))


def _query_text(priority, orderkey) -> F.Column:
    return F.concat(F.lower(F.trim(priority)), F.lit(" "), F.pmod(orderkey, F.lit(QUERY_BUCKETS)).cast("string"))


def _dirty_user(d, custkey) -> F.Column:
    return (
        F.when(d == 0, F.lit(None).cast("string"))
        .when(d == 1, F.lit("null"))
        .when(d == 2, F.lit(""))
        .when(d == 3, F.lit("undefined"))
        .otherwise(F.concat(F.lit("U"), custkey.cast("string")))
    )


def _dirty_query(d, q) -> F.Column:
    return F.when(d == 5, F.lit(" a ")).when(d == 8, F.concat(F.lit("  "), F.upper(q), F.lit("  "))).otherwise(q)


def _copies(d) -> F.Column:
    """Row multiplicity: case 9 rows appear twice."""
    return F.explode(F.array_repeat(F.lit(0), F.when(d == 9, F.lit(2)).otherwise(F.lit(1))))


def cart_events(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """Raw cart-event table (schema ``schemas.CART_EVENTS``), dirty rows included. ``names``: False
    leaves the item names null and their lookup out."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # orders, one row a key, are hashed by partition; the lines stream past them unsorted
    rows = _named(li.join(orders.hint("shuffle_hash"), li.l_orderkey == orders.o_orderkey), spark, sf_dir, "l_partkey", names)
    d = _dirt(F.col("o_orderkey"))
    q = _query_text(F.col("o_orderpriority"), F.col("o_orderkey"))
    out = rows.select(
        F.date_format(F.to_date("o_orderdate"), "yyyyMMdd").alias("event_dt"),
        _dirty_user(d, F.col("o_custkey")).alias("userid"),
        F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("correlation_id"),
        _dirty_query(d, q).alias("search_query"),
        F.when(d == 4, F.lit("(not set)")).otherwise(F.concat(F.lit("I"), F.col("l_partkey").cast("string"))).alias("item_id"),
        F.when(d == 6, F.lit(-1.0)).otherwise((F.col("l_linenumber") - 1).cast("double")).alias("item_list_index"),
        F.when(d == 7, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("price"),
        F.col("p_name").alias("item_name"),
        _copies(d).alias("_copy"),
    ).drop("_copy")
    return schemas.conform(out, schemas.CART_EVENTS)


def _named(rows: DataFrame, spark: SparkSession, sf_dir: str, partkey: str, names: bool) -> DataFrame:
    if not names:
        return rows.withColumn("p_name", F.lit(None).cast("string"))
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rows.join(part, F.col(partkey) == part.p_partkey, "left")


def _shown_parts(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """``(orderkey, partkey, sort_key)`` and the other columns of ``orders``: an order's lines, then six
    distractor parts."""
    n_parts = _read(spark, sf_dir, "part").count()  # scalar; the distractor rule needs the catalogue size
    own = [c for c in orders.columns if c != "o_orderkey"]
    lines = _read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == orders.o_orderkey).select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_linenumber").cast("long").alias("sort_key"),
        *own,
    )
    i = F.explode(F.sequence(F.lit(1), F.lit(DISTRACTORS))).alias("i")
    extra = (
        orders.select(F.col("o_orderkey").alias("orderkey"), i, *own)
        .select(
            "orderkey",
            F.pmod(F.col("orderkey") * DISTRACTOR_MULT + F.col("i") * DISTRACTOR_STEP, F.lit(n_parts)).alias("partkey"),
            (F.col("i") + DISTRACTOR_SORT_BASE).cast("long").alias("sort_key"),
            *own,
        )
    )
    return lines.unionByName(extra)


def _result_rows(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """One row per shown result: an order's lines, then six distractor parts."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # an order has one row: its columns beside the key let a filter on them pass the window
    w = W.partitionBy("orderkey", "o_custkey", "o_orderdate", "o_orderpriority").orderBy("sort_key", "partkey")
    shown = _shown_parts(spark, sf_dir, orders).withColumn("position", F.row_number().over(w))
    return _named(shown, spark, sf_dir, "partkey", names)


def search_results(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """Raw search-result (impression) table (schema ``schemas.SEARCH_RESULTS``); ``names`` as in ``cart_events``."""
    rows = _result_rows(spark, sf_dir, names)
    d = _dirt(F.col("orderkey"))
    q = _query_text(F.col("o_orderpriority"), F.col("orderkey"))
    out = rows.select(
        F.to_date("o_orderdate").alias("SCL_CREATED_DATE"),
        _dirty_user(d, F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("C"), F.col("orderkey").cast("string")).alias("correlation_id"),
        _dirty_query(d, q).alias("request_term"),
        F.col("partkey").cast("string").alias("response_item_number"),
        F.when(d == 4, F.lit("(not set)")).otherwise(F.concat(F.lit("I"), F.col("partkey").cast("string"))).alias("response_sku"),
        F.col("position").cast("double").alias("response_position"),
        F.col("p_name").alias("response_name"),
        _copies(d).alias("_copy"),
    ).drop("_copy")
    return schemas.conform(out, schemas.SEARCH_RESULTS)


def _embeddings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    emb = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    return emb, emb.count()


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed user factor table ``(id, features)``; every tenth customer is cold."""
    emb, n_vec = _embeddings(spark, sf_dir)
    cust = _read(spark, sf_dir, "customer").select("c_custkey")
    known = cust.where(F.pmod("c_custkey", F.lit(COLD_USER_EVERY)) != 0).select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("id"),
        F.pmod("c_custkey", F.lit(n_vec)).alias("vec_id"),
    )
    return schemas.conform(known.join(emb, "vec_id"), schemas.FACTORS)


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed item factor table ``(id, features)``; every twentieth part is cold."""
    emb, n_vec = _embeddings(spark, sf_dir)
    part = _read(spark, sf_dir, "part").select("p_partkey")
    known = part.where(F.pmod("p_partkey", F.lit(COLD_ITEM_EVERY)) != 0).select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("id"),
        F.pmod(F.col("p_partkey") * 3 + 1, F.lit(n_vec)).alias("vec_id"),
    )
    return schemas.conform(known.join(emb, "vec_id"), schemas.FACTORS)


def rerank_requests(spark: SparkSession, sf_dir: str, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """One request per order: its user and its distinct shown items, in shown order.

    Given factor tables, only ids present in them are kept (an unknown id fails
    a rerank); without, every request is whole.
    """
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("userid"))
    if users is not None:  # orders, not each of their results
        orders = orders.join(users.select(F.col("id").alias("userid")), "userid", "left_semi")
    shown = _shown_parts(spark, sf_dir, orders).withColumn("item", F.concat(F.lit("I"), F.col("partkey").cast("string")))
    if items is not None:
        shown = shown.join(items.select(F.col("id").alias("item")), "item", "left_semi")
    rows = shown.select(F.col("orderkey").alias("request_id"), "userid", "sort_key", "partkey", "item")
    # shown order is that of (sort_key, partkey); an item stays where it is shown first
    in_order = F.array_sort(F.collect_list(F.struct("sort_key", "partkey", "item")))
    out = rows.groupBy("request_id", "userid").agg(F.array_distinct(F.transform(in_order, lambda s: s["item"])).alias("products"))
    return schemas.conform(out, schemas.RERANK_REQUESTS)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register the views of the SQL templates over the fixture sources."""
    templates.register_views(cart_events(spark, sf_dir), search_results(spark, sf_dir))
