"""Invariants, partition independence, block/bucket independence, sources and sinks."""

import os
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklift.config import RunConfig, Window
from ranklift.operators import affinity, cleaning, factors, numbering, rank_metrics, replay, sampling
from ranklift.plans.context import Inputs
from ranklift.sources import fixtures, sinks, templates


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rating_sum_is_two_per_active_day(spark, inputs):
    ev = inputs.cart_events.where(F.col("price").isNotNull())
    w = Window("19950101", "20011231")
    m = affinity.affinity_matrix(ev, w)
    per_user = m.groupBy("userid").agg(F.sum(F.col("rating") - 1).alias("s"))
    days = (
        affinity.filter_events(ev, w).groupBy("userid").agg(F.count_distinct("event_dt").alias("d"))
    )
    bad = per_user.join(days, "userid").where(F.abs(F.col("s") - 2 * F.col("d")) > 1e-9).count()
    assert bad == 0
    assert m.where(F.col("rating") <= 1).count() == 0


@pytest.mark.parametrize("parts", [1, 64])
def test_partition_independence(spark, inputs, parts):
    base_aff = _rows(inputs.train_matrix.select("userid", "itemid", F.round("rating", 9)))
    base_sample = _rows(inputs.sampled)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        fresh = Inputs(spark, SF_SMALL)
        assert _rows(fresh.train_matrix.select("userid", "itemid", F.round("rating", 9))) == base_aff
        assert _rows(fresh.sampled) == base_sample
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_day_totals_join_equals_window(spark, inputs):
    a = affinity.affinity_matrix(inputs.cart_events, inputs.cfg.train, day_totals="join")
    b = affinity.affinity_matrix(inputs.cart_events, inputs.cfg.train, day_totals="window")
    assert _rows(a.select("userid", "itemid", F.round("rating", 9))) == _rows(b.select("userid", "itemid", F.round("rating", 9)))


def test_numbering_independent_of_bucket_size(spark, inputs):
    adds = sampling.add_row_hash(inputs.cart_adds)
    a = numbering.number_within(adds, ["search_query"], sampling.ORDER, rows_per_bucket=3)
    b = numbering.number_within(adds, ["search_query"], sampling.ORDER, rows_per_bucket=10**9)
    cols = ["search_query", "fecha", "userid", "correlation_id", "a2c_itemid", "a2c_position", "rn", "group_rows"]
    assert _rows(a.select(cols)) == _rows(b.select(cols))
    # rn is a permutation of 1..n in every group
    chk = a.groupBy("search_query").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count("*").alias("n"), F.count_distinct("rn").alias("d"))
    assert chk.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0


def test_sample_size_per_query(spark, inputs):
    per_q = inputs.cart_adds.groupBy("search_query").agg(F.count("*").alias("n"))
    got = inputs.sampled.groupBy("search_query").agg(F.count("*").alias("m"))
    j = per_q.join(got, "search_query", "left").fillna(0, ["m"])
    assert j.where(F.col("m") != F.floor(F.col("n") * 0.2)).count() == 0


def test_dense_index_matches_dense_rank(spark, inputs):
    got = numbering.dense_index(inputs.train_matrix, "itemid", "idx", partitions=5)
    ref = inputs.train_matrix.select("itemid").distinct().withColumn(
        "idx", (F.dense_rank().over(W.orderBy("itemid")) - 1).cast("long")
    )
    assert _rows(got) == _rows(ref)


def test_scorer_independent_of_block_sizes(spark, inputs):
    known = rank_metrics.known_pairs(inputs.test_matrix, inputs.user_factors, inputs.item_factors)
    a = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 5, "dot_product")
    b = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 5, "dot_product", user_block=7, item_block=13)
    # the oversize path (block pairs instead of a broadcast) gives the same rows
    c = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 5, "dot_product", item_block=50, first_bytes=0)
    assert _rows(a.top_items().select("userid", "rank", "itemid")) == _rows(c.top_items().select("userid", "rank", "itemid"))
    assert _rows(a.top_items().select("userid", "rank", "itemid")) == _rows(b.top_items().select("userid", "rank", "itemid"))
    lv = ["userid", "level_start", "level_key", "n_items", F.round("gain_sum", 9)]
    assert _rows(a.levels().select(lv)) == _rows(b.levels().select(lv))
    assert _rows(a.summary().select(F.round("ndcg_at_k", 9))) == _rows(b.summary().select(F.round("ndcg_at_k", 9)))


def test_metrics_in_unit_interval(spark, inputs):
    known = rank_metrics.known_pairs(inputs.test_matrix, inputs.user_factors, inputs.item_factors)
    r = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 20, "euclidean_distance").summary().collect()[0]
    for c in ("ndcg_at_k", "map_at_k", "mar_at_k"):
        assert 0.0 <= r[c] <= 1.0


def test_identity_model_keeps_positions(spark, inputs):
    # Items scored by minus their shown position: the model reproduces the shown order.
    merged = inputs.merged
    from ranklift.operators import replay

    pred = merged.withColumn("prediction", -F.col("imp_position"))
    shift = replay.position_shift(merged, replay.slot_assignment(pred, "dot_product"))
    # An item shown once keeps its slot; an item shown at several slots pairs
    # every shown slot with every predicted slot, which cancels out.
    once = shift.groupBy("fecha", "userid", "correlation_id", "search_query", "a2c_itemid").agg(
        F.count("*").alias("n"), F.max(F.abs("diff_pos")).alias("m"), F.sum(F.col("diff_pos") * F.col("n_pairs")).alias("s")
    )
    assert once.where((F.col("n") == 1) & (F.col("m") != 0)).count() == 0
    assert once.where(F.col("s") != 0).count() == 0


def test_templates_match_dataframe_operators(spark, inputs):
    fixtures.register_views(spark, SF_SMALL)
    cfg = RunConfig()
    m_sql = templates.user_item_matrix(spark, cfg.train.start, cfg.train.end)
    assert _rows(m_sql.select("userid", "itemid", F.round("rating", 9))) == _rows(inputs.train_matrix.select("userid", "itemid", F.round("rating", 9)))
    a_sql = templates.add2cart(spark, cfg.replay.start, cfg.replay.end)
    assert _rows(a_sql.select(inputs.cart_adds.columns)) == _rows(inputs.cart_adds)
    i_sql = templates.impressions(spark, cfg.replay.start, cfg.replay.end)
    assert _rows(i_sql) == _rows(inputs.impressions)
    with pytest.raises(ValueError):
        templates.run_template(spark, "affinity_matrix", "2020-01-01", "20200101")


def test_factor_sink_round_trip(spark, inputs):
    out = tempfile.mkdtemp(prefix="ranklift-sink-", dir="/tmp")
    path = sinks.write_factors(inputs.user_factors, inputs.item_factors, inputs.rank, out, "2024-01-01")
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/kind=users")
    assert back.count() == inputs.user_factors.count()
    assert back.columns[:2] == ["id", "c1"]
    assert os.path.isdir(f"{path}/kind=items")


def test_als_deterministic_and_rank(spark, inputs):
    params = factors.ALSParams(rank=4, iterations=2, seed=3)
    m = inputs.train_matrix
    u1, _ = factors.fit_als(m, params)
    u2, _ = factors.fit_als(m, params)
    a = _rows(u1.select("id", F.transform("features", lambda x: F.round(x, 6)).alias("f")))
    b = _rows(u2.select("id", F.transform("features", lambda x: F.round(x, 6)).alias("f")))
    assert a == b
    assert {len(r[1]) for r in a} == {4}
    assert len(a) == m.select("userid").distinct().count()


def test_kfold_sizes_like_ntile(spark, inputs):
    f = factors.kfold_assign(inputs.train_matrix, 3)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    n = inputs.train_matrix.count()
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_clean_single_day_equality(spark, inputs):
    adds = cleaning.clean_cart_adds(inputs.cart_events, Window("19980101", "19980101"))
    assert adds.where(F.col("fecha") != F.to_date(F.lit("1998-01-01"))).count() == 0


def test_sample_independent_of_chunks_and_buckets(spark, inputs):
    base = _rows(inputs.sampled)
    tiny = sampling.sample_per_query(inputs.cart_adds, 0.2, 1, rows_per_bucket=5, draws_per_chunk=3)
    assert _rows(tiny) == base


def test_typed_scans_from_parquet_and_catalog(spark, inputs):
    from ranklift.sources import tables

    path = tempfile.mkdtemp(prefix="ranklift-src-", dir="/tmp") + "/cart_events"
    inputs.cart_events.write.mode("overwrite").partitionBy("event_dt").parquet(path)
    back = tables.scan_cart_events(spark, path)
    assert back.columns == inputs.cart_events.columns
    assert back.count() == inputs.cart_events.count()
    # the day window prunes partitions of a day-partitioned table
    adds = cleaning.clean_cart_adds(back, Window("19980101", "19980131"))
    plan = adds._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_dt" in plan
    inputs.cart_events.createOrReplaceTempView("cart_events_view")
    assert tables.scan_cart_events(spark, "cart_events_view").count() == back.count()


def test_prediction_paths_agree(spark, inputs):
    from ranklift.operators import replay

    small = replay.predict_pairs_all(inputs.merged, inputs.user_factors, inputs.item_factors, rank=inputs.rank)
    large = replay.predict_pairs_all(inputs.merged, inputs.user_factors, inputs.item_factors, rank=inputs.rank, broadcast_bytes=0)
    cols = [*inputs.merged.columns, "metric", F.round("prediction", 9)]
    assert _rows(small.select(cols)) == _rows(large.select(cols))
    one = replay.predict_pairs(inputs.merged, inputs.user_factors, inputs.item_factors, "dot_product", broadcast_bytes=0)
    assert one.count() == inputs.merged.count()


def test_scorer_rows_do_not_grow_with_item_blocks(spark, inputs):
    known = rank_metrics.known_pairs(inputs.test_matrix, inputs.user_factors, inputs.item_factors)
    for metric in ("dot_product", "euclidean_distance"):
        a = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 5, metric)
        b = rank_metrics.Scored(known, inputs.user_factors, inputs.item_factors, 5, metric, item_block=20, user_block=50)
        assert a.raw.where("itemid is not null").count() == b.raw.where("itemid is not null").count()
        assert sorted(a.top_items().select("userid", "rank", "itemid").collect()) == sorted(b.top_items().select("userid", "rank", "itemid").collect())


def test_affinity_by_user_takes_one_exchange(spark, inputs):
    from ranklift.operators import affinity

    rows = lambda df: _rows(df.select("userid", "itemid", F.round("rating", 9)))
    one = affinity.affinity_matrix(inputs.cart_events, RunConfig().train, "by_user")
    assert rows(one) == rows(inputs.train_matrix)
    some = affinity.affinity_matrix(inputs.cart_events, RunConfig().train, "by_user", heavy_rows=40)
    assert affinity.heavy_users(inputs.cart_events, RunConfig().train, 40) is not None
    assert rows(some) == rows(inputs.train_matrix)
    path = tempfile.mkdtemp(prefix="ranklift-src-", dir="/tmp") + "/c"
    inputs.cart_events.write.parquet(path)
    plan = affinity.affinity_matrix(spark.read.parquet(path), RunConfig().train, "by_user")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_sample_is_planned_once(spark):
    """The replay reads the stored sample; the tables behind it are scanned for the impressions only."""
    i = Inputs(spark, SF_SMALL)
    joined = replay.session_join(i.impressions, sampling.adds_of_top_queries(i.sampled, i.top))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 6, plan
    assert "SortMergeJoin [fecha" in plan  # whatever the size of the files
    want = sampling.sample_per_query(i.cart_adds, i.cfg.sample_size, i.cfg.sample_seed)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(i.sampled) == rows(want) and i.sampled.schema.names == want.schema.names
