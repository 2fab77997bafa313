"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, and, where SQL can express it, the DuckDB query it is
checked against (``oracle.py``). Every query reads the full fixture tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Window
from ..functions import vectors as V
from ..operators import affinity, cleaning, replay, sampling
from ..operators import factors as FA
from ..operators import rank_metrics as RM
from ..operators import rerank as RR
from ..sources import fixtures, sinks, tables, templates
from . import oracle as O
from .context import Inputs, round_doubles
from .pipeline import replay_prefix, report, run_pipeline
from .search import ReplayScorer, search
from .tuning import ImplicitRankerModel, ReplayEvaluator

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(Inputs(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _cols(names: str) -> str:
    return ", ".join(names.split())


# ------------------------------------------------------------------ sources


@register("scan_cart_events", O.build("SELECT * FROM cart_events", "cart_events"))
def q_scan_cart_events(i: Inputs) -> DataFrame:
    """The typed scan of the whole partitioned cart-event table."""
    return tables.scan_cart_events(i.spark, i.cart_table)


@register("scan_impressions", O.build("SELECT * FROM search_results", "search_results"))
def q_scan_impressions(i: Inputs) -> DataFrame:
    """The typed scan of the whole partitioned search-result table."""
    return tables.scan_impressions(i.spark, i.search_table)


# ------------------------------------------------------------------ cleaning


@register("clean_cart_adds", O.build("SELECT * FROM cart_adds", "cart_adds"))
def q_clean_cart_adds(i: Inputs) -> DataFrame:
    """Cleaned cart adds of the replay window."""
    return i.cart_adds


@register("clean_impressions", O.build("SELECT * FROM impressions", "impressions"))
def q_clean_impressions(i: Inputs) -> DataFrame:
    """Cleaned impressions of the replay window."""
    return i.impressions


_ONE_DAY = Window(O.ONE_DAY, O.ONE_DAY)


@register("clean_cart_adds_day", O.build("SELECT * FROM day_cart_adds", "day_cart_adds"))
def q_clean_cart_adds_day(i: Inputs) -> DataFrame:
    """cleaned cart adds of a single day, read from its partition."""
    return cleaning.clean_cart_adds(tables.scan_cart_events(i.spark, i.cart_table, _ONE_DAY), _ONE_DAY)


@register("clean_impressions_day", O.build("SELECT * FROM day_impressions", "day_impressions"))
def q_clean_impressions_day(i: Inputs) -> DataFrame:
    """cleaned impressions of a single day, read from its partition."""
    return cleaning.clean_impressions(tables.scan_impressions(i.spark, i.search_table, _ONE_DAY), _ONE_DAY)


@register(
    "scan_busy_days",
    O.build(
        "SELECT e.* FROM cart_events e WHERE e.event_dt IN ("
        "SELECT strftime(o_orderdate, '%Y%m%d') FROM orders GROUP BY 1 HAVING count(*) > (SELECT count(*) / count(DISTINCT o_orderdate) FROM orders))",
        "cart_events",
    ),
)
def q_scan_busy_days(i: Inputs) -> DataFrame:
    """The cart events of the days with more orders than the mean day; the partitions are
    picked at run time."""
    orders = i.spark.read.parquet(f"{i.sf_dir}/orders.parquet")
    per_day = orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    mean = F.avg("n").over(W.partitionBy())  # over one row per day
    busy = per_day.withColumn("mean", mean).where("n > mean").select("day")
    return tables.scan_cart_events(i.spark, i.cart_table, days=busy)


# ------------------------------------------------------------------ SQL templates


@register("sql_add2cart", O.build("SELECT * FROM cart_adds", "cart_adds"))
def q_sql_add2cart(i: Inputs) -> DataFrame:
    """S3 + S4: the cart-add template over the replay window."""
    fixtures.register_views(i.spark, i.sf_dir)
    return templates.add2cart(i.spark, i.cfg.replay.start, i.cfg.replay.end)


@register("sql_add2cart_day", O.build("SELECT * FROM day_cart_adds", "day_cart_adds"))
def q_sql_add2cart_day(i: Inputs) -> DataFrame:
    """S3 + S4: the cart-add template for a single day."""
    fixtures.register_views(i.spark, i.sf_dir)
    return templates.add2cart(i.spark, _ONE_DAY.start)


@register("sql_impressions", O.build("SELECT * FROM impressions", "impressions"))
def q_sql_impressions(i: Inputs) -> DataFrame:
    """S3 + S4: the impression template over the replay window."""
    fixtures.register_views(i.spark, i.sf_dir)
    return templates.impressions(i.spark, i.cfg.replay.start, i.cfg.replay.end)


@register("sql_affinity_matrix", O.build(f"SELECT userid, itemid, {O.r6('rating')} AS rating FROM train_matrix", "train_matrix"))
def q_sql_affinity_matrix(i: Inputs) -> DataFrame:
    """S3 + S4: the affinity template over the training window."""
    fixtures.register_views(i.spark, i.sf_dir)
    return templates.user_item_matrix(i.spark, i.cfg.train.start, i.cfg.train.end)


# ------------------------------------------------------------------ affinity


@register(
    "user_item_day",
    O.build(f"SELECT userid, itemid, event_day, interaccion, n_items, {O.r6('total_price')} AS total_price FROM train_uid", "train_uid"),
)
def q_user_item_day(i: Inputs) -> DataFrame:
    """A1: per user, item and day: count and price sum."""
    return affinity.user_item_day(i.cart_events, i.cfg.train)


@register(
    "user_day_totals",
    O.build(
        f"SELECT userid, event_day, n_total_items_per_day, {O.r6('n_total_price_per_day')} AS n_total_price_per_day FROM train_totals",
        "train_totals",
    ),
)
def q_user_day_totals(i: Inputs) -> DataFrame:
    """A2: per user and day totals."""
    return affinity.user_day_totals(affinity.user_item_day(i.cart_events, i.cfg.train))


@register(
    "day_weights",
    O.build(
        "SELECT userid, itemid, interaccion, n_items, "
        + ", ".join(
            f"{O.r6(c)} AS {c}"
            for c in ["total_price", "n_total_price_per_day", "weight_items", "weight_price"]
        )
        + ", n_total_items_per_day, event_day FROM train_weights",
        "train_weights",
    ),
)
def q_day_weights(i: Inputs) -> DataFrame:
    """A3 + J1: item-day rows with their day weights."""
    return affinity.day_weights(affinity.user_item_day(i.cart_events, i.cfg.train))


@register(
    "test_matrix_stats",
    O.build(O.matrix_stats_select("test_matrix", O.CFG.test), "test_matrix"),
)
def q_test_matrix_stats(i: Inputs) -> DataFrame:
    """A5 on the test matrix."""
    return affinity.matrix_stats(i.test_matrix, i.cfg.test)


@register("affinity_matrix", O.build(f"SELECT userid, itemid, {O.r6('rating')} AS rating FROM train_matrix", "train_matrix"))
def q_affinity_matrix(i: Inputs) -> DataFrame:
    """A4 (flagship): the training user-item affinity matrix."""
    return i.train_matrix


@register(
    "matrix_stats",
    O.build(O.matrix_stats_select("train_matrix", O.CFG.train), "train_matrix"),
)
def q_matrix_stats(i: Inputs) -> DataFrame:
    """A5: matrix report."""
    return affinity.matrix_stats(i.train_matrix, i.cfg.train)


# ------------------------------------------------------------------ sampling


@register("sample_per_query", O.build(f"SELECT {_cols('fecha search_query userid correlation_id a2c_itemid a2c_position draw')} FROM sampled", "sampled"))
def q_sample_per_query(i: Inputs) -> DataFrame:
    """Exact-n sample with replacement per search query."""
    return i.sampled


@register("top_queries", O.build("SELECT search_query, n_adds, query_rank FROM top_q", "top_q"))
def q_top_queries(i: Inputs) -> DataFrame:
    """Top-n queries by sampled adds."""
    return i.top


@register(
    "session_join",
    O.build(f"SELECT {_cols('fecha userid correlation_id imp_itemid imp_position search_query a2c_itemid a2c_position')} FROM merged", "merged"),
)
def q_session_join(i: Inputs) -> DataFrame:
    """J2 (+J4): impressions joined to sampled adds of the top queries."""
    return i.merged


def _predicted(i: Inputs, metric: str) -> DataFrame:
    return replay.predict_pairs(i.merged, i.user_factors, i.item_factors, metric, i.cfg.cold_start, i.rank)


@register(
    "predict_pairs",
    O.build(
        f"SELECT {_cols('fecha userid correlation_id imp_itemid imp_position search_query a2c_itemid a2c_position')}, "
        f"{O.r6('prediction')} AS prediction FROM predicted_dot",
        "predicted_dot",
    ),
)
def q_predict_pairs(i: Inputs) -> DataFrame:
    """J6 + row-wise dot product of every merged row (cold ids -> -1 vector)."""
    return _predicted(i, "dot_product")


@register(
    "slot_assignment",
    O.build(
        f"SELECT {_cols('fecha userid correlation_id search_query a2c_itemid slot predict_itemid')}, "
        f"{O.r6('prediction')} AS prediction, imp_position FROM slots_dot",
        "slots_dot",
    ),
)
def q_slot_assignment(i: Inputs) -> DataFrame:
    """W4 + W5: predicted order mapped onto the shown slots."""
    return replay.slot_assignment(_predicted(i, "dot_product"), "dot_product", sizes_from=i.merged)


def _shift(i: Inputs, metric: str) -> DataFrame:
    slots = replay.slot_assignment(_predicted(i, metric), metric, sizes_from=i.merged)
    return replay.position_shift(i.merged, slots)


@register(
    "position_shift",
    O.build(
        f"SELECT {_cols('fecha userid correlation_id search_query a2c_itemid current_pos predict_pos diff_pos')}, "
        "count(*) AS n_pairs FROM shift_rows_dot GROUP BY ALL",
        "shift_rows_dot",
    ),
)
def q_position_shift(i: Inputs) -> DataFrame:
    """Current vs predicted position of each added item (pair-weighted)."""
    return _shift(i, "dot_product")


@register("improvement_overall", O.build(O.improvement_select("shift_rows_dot", 3), "shift_rows_dot"))
def q_improvement_overall(i: Inputs) -> DataFrame:
    """Mean average improvement, quantiles (dot product)."""
    return replay.improvement_overall(_shift(i, "dot_product"))


@register("improvement_by_query", O.build(O.improvement_select("shift_rows_dot", 2, "search_query"), "shift_rows_dot"))
def q_improvement_by_query(i: Inputs) -> DataFrame:
    """The same statistics per search query."""
    return replay.improvement_by_query(_shift(i, "dot_product"))


@register(
    "replay_improvement",
    O.build(
        "SELECT 'dot_product' AS metric, * FROM (" + O.improvement_select("shift_rows_dot", 3) + ")"
        " UNION ALL SELECT 'euclidean_distance' AS metric, * FROM (" + O.improvement_select("shift_rows_euc", 3) + ")",
        "shift_rows_dot",
        "shift_rows_euc",
    ),
)
def q_replay_improvement(i: Inputs) -> DataFrame:
    """Replay end to end (``ModelPerformance.compute_metric``) under both metrics, one pass."""
    pred = replay.predict_pairs_all(i.merged, i.user_factors, i.item_factors, cold_start=i.cfg.cold_start, rank=i.rank)
    slots = replay.slot_assignment(pred, None, keys=("metric",), sizes_from=i.merged)
    shift = replay.position_shift(i.merged, slots, keys=("metric",))
    return replay.improvement_overall(shift, keys=("metric",))


# ------------------------------------------------------------------ vectors and lookups

_RANK = 64  # vector length of the bundled embeddings (oracle SQL columns c1..c64)


def _flat_sql(vec: str, n: int = _RANK) -> str:
    return ", ".join(f"{O.r6(f'({vec})[{j}]')} AS c{j}" for j in range(1, n + 1))


def _known(i: Inputs) -> DataFrame:
    return RM.known_pairs(i.test_matrix, i.user_factors, i.item_factors)


@register("known_pairs", O.build(f"SELECT userid, itemid, {O.r6('rating')} AS rating FROM test_known", "test_known"))
def q_known_pairs(i: Inputs) -> DataFrame:
    """Test-matrix rows whose user and item have factor vectors."""
    return _known(i)


@register(
    "known_pairs_report",
    O.build(
        """SELECT *, round(n_users_removed * 100.0 / n_users, 2) AS pct_users_removed,
       round(n_items_removed * 100.0 / n_items, 2) AS pct_items_removed
FROM (
  SELECT count(DISTINCT userid) AS n_users,
         count(DISTINCT CASE WHEN userid NOT IN (SELECT id FROM user_factors) THEN userid END) AS n_users_removed,
         count(DISTINCT itemid) AS n_items,
         count(DISTINCT CASE WHEN itemid NOT IN (SELECT id FROM item_factors) THEN itemid END) AS n_items_removed,
         count(*) AS n_rows,
         CAST(sum(CASE WHEN userid IN (SELECT id FROM user_factors) AND itemid IN (SELECT id FROM item_factors)
                       THEN 1 ELSE 0 END) AS BIGINT) AS n_rows_kept
  FROM test_matrix
)""",
        "test_matrix",
        "user_factors",
        "item_factors",
    ),
)
def q_known_pairs_report(i: Inputs) -> DataFrame:
    """J5 report: share of users and items without vectors."""
    return RM.known_pairs_report(i.test_matrix, i.user_factors, i.item_factors)


@register(
    "lookup_vectors",
    O.build(
        f"""SELECT kind, k.id, f.id IS NOT NULL AS known, {_flat_sql(f"coalesce(f.features, {O._COLD})")}
FROM (SELECT DISTINCT 'user' AS kind, userid AS id FROM impressions) k LEFT JOIN user_factors f ON k.id = f.id
UNION ALL
SELECT kind, k.id, f.id IS NOT NULL AS known, {_flat_sql(f"coalesce(f.features, {O._COLD})")}
FROM (SELECT DISTINCT 'item' AS kind, imp_itemid AS id FROM impressions) k LEFT JOIN item_factors f ON k.id = f.id""",
        "impressions",
        "user_factors",
        "item_factors",
    ),
)
def q_lookup_vectors(i: Inputs) -> DataFrame:
    """Vector lookup with the -1 default for every user and item shown."""
    out = []
    for kind, col, factors in (("user", "userid", i.user_factors), ("item", "imp_itemid", i.item_factors)):
        keys = i.impressions.select(F.col(col).alias("id")).distinct()
        got = replay.lookup_vectors(keys, "id", factors, "features", i.rank, "minus_one", known_col="known")
        out.append(got.select(F.lit(kind).alias("kind"), "id", "known", *sinks.vector_columns(i.rank)))
    return out[0].unionByName(out[1])


def _pair_scores(i: Inputs, expr) -> DataFrame:
    j = _known(i).join(i.user_factors.select(F.col("id").alias("userid"), F.col("features").alias("_u")), "userid").join(
        i.item_factors.select(F.col("id").alias("itemid"), F.col("features").alias("_v")), "itemid"
    )
    return j.select("userid", "itemid", expr("_u", "_v").alias("score"))


@register("dot_score", O.build(f"SELECT userid, itemid, {O.r6('list_inner_product(uf, vf)')} AS score FROM known_vectors", "known_vectors"))
def q_dot_score(i: Inputs) -> DataFrame:
    """Dot product of user and item vectors for every known test pair."""
    return _pair_scores(i, V.dot)


@register(
    "euclidean_score",
    O.build(
        f"SELECT userid, itemid, {O.r6(O._pair_score('euclidean_distance', 'uf', 'vf'))} AS score FROM known_vectors",
        "known_vectors",
    ),
)
def q_euclidean_score(i: Inputs) -> DataFrame:
    """Euclidean distance of user and item vectors for every known test pair."""
    return _pair_scores(i, V.euclidean)


@register("cosine_score", O.build(f"SELECT userid, itemid, {O.r6('list_cosine_similarity(uf, vf)')} AS score FROM known_vectors", "known_vectors"))
def q_cosine_score(i: Inputs) -> DataFrame:
    """Cosine similarity for every known test pair."""
    return _pair_scores(i, V.cosine)


@register(
    "vector_norms",
    O.build(
        f"""SELECT 'user' AS kind, id, {O.r6('sqrt(list_sum(list_transform(features, lambda x: x * x)))')} AS norm FROM user_factors
UNION ALL
SELECT 'item' AS kind, id, {O.r6('sqrt(list_sum(list_transform(features, lambda x: x * x)))')} AS norm FROM item_factors""",
        "user_factors",
        "item_factors",
    ),
)
def q_vector_norms(i: Inputs) -> DataFrame:
    """L2 norm of every factor vector."""
    u = i.user_factors.select(F.lit("user").alias("kind"), "id", V.norm("features").alias("norm"))
    it = i.item_factors.select(F.lit("item").alias("kind"), "id", V.norm("features").alias("norm"))
    return u.unionByName(it)


@register(
    "factor_export",
    O.build(
        f"""SELECT 'users' AS kind, id, {_flat_sql('features')} FROM user_factors
UNION ALL SELECT 'items' AS kind, id, {_flat_sql('features')} FROM item_factors""",
        "user_factors",
        "item_factors",
    ),
)
def q_factor_export(i: Inputs) -> DataFrame:
    """The flat ``kind, id, c1..cn`` frame the factor sink writes."""
    return sinks.export_frame(i.user_factors, i.item_factors, i.rank)


@register(
    "sorted_factors",
    O.build(
        """SELECT kind, id, CAST(row_number() OVER (ORDER BY kind, id) - 1 AS BIGINT) AS place, n AS rank FROM (
  SELECT 'users' AS kind, id, CAST(len(features) AS BIGINT) AS n FROM user_factors
  UNION ALL SELECT 'items' AS kind, id, CAST(len(features) AS BIGINT) AS n FROM item_factors)""",
        "user_factors",
        "item_factors",
    ),
)
def q_sorted_factors(i: Inputs) -> DataFrame:
    """T1 + S5: the factor tables written in one global order and read back with their places."""
    path = sinks.write_sorted(sinks.export_frame(i.user_factors, i.item_factors, i.rank), ["kind", "id"], i.folder("factors"))
    entries = F.array(*(F.col(f"c{j}") for j in range(1, i.rank + 1)))
    return sinks.read_sorted(i.spark, path).select("kind", "id", "place", F.size(F.array_compact(entries)).cast("bigint").alias("rank"))


@register(
    "sorted_affinity",
    O.build(
        f"SELECT userid, itemid, {O.r6('rating')} AS rating, CAST(row_number() OVER (ORDER BY userid, itemid) - 1 AS BIGINT) AS place FROM train_matrix",
        "train_matrix",
    ),
)
def q_sorted_affinity(i: Inputs) -> DataFrame:
    """The training matrix written in (user, item) order and read back with its places."""
    return sinks.read_sorted(i.spark, sinks.write_sorted(i.train_matrix, ["userid", "itemid"], i.folder("affinity")))


# ------------------------------------------------------------------ rank metrics


def _scored(i: Inputs, metric: str = "dot_product") -> RM.Scored:
    return RM.Scored(_known(i), i.user_factors, i.item_factors, i.cfg.k, metric)


@register("topk_relevant", O.build(f"SELECT userid, rank, itemid, {O.r6('rating')} AS rating FROM rel_topk", "rel_topk"))
def q_topk_relevant(i: Inputs) -> DataFrame:
    """Each user's top-k items by rating."""
    return RM.topk_relevant(_known(i), i.cfg.k)


@register(
    "topk_relevant_lists",
    O.build("SELECT userid, count(*) AS n_items, string_agg(itemid, ',' ORDER BY rank) AS items FROM rel_topk GROUP BY userid", "rel_topk"),
)
def q_topk_relevant_lists(i: Inputs) -> DataFrame:
    """The same as one ordered list per user."""
    return RM.topk_lists(RM.topk_relevant(_known(i), i.cfg.k))


@register("topk_predicted", O.build(f"SELECT userid, rank, itemid, {O.r6('score')} AS score FROM pred_items", "pred_items"))
def q_topk_predicted(i: Inputs) -> DataFrame:
    """W3 + J8: each user's top-k candidate items by predicted score."""
    return _scored(i).top_items()


@register(
    "score_candidates",
    O.build(f"SELECT userid, level_start, {O.r6('level_key')} AS level_key, n_items, {O.r6('gain_sum')} AS gain_sum FROM levels", "levels"),
)
def q_score_candidates(i: Inputs) -> DataFrame:
    """All candidates scored; per user the score levels starting within the top k."""
    return _scored(i).levels()


@register("ndcg_at_k", O.build(f"SELECT userid, {O.r6('dcg')} AS dcg, {O.r6('idcg')} AS idcg, {O.r6('ndcg')} AS ndcg FROM ndcg_users", "ndcg_users"))
def q_ndcg_at_k(i: Inputs) -> DataFrame:
    """Per-user tie-averaged NDCG@k."""
    return _scored(i).ndcg()


@register("map_at_k", O.build(f"SELECT userid, n_hits, {O.r6('ap')} AS ap FROM ap_users", "ap_users"))
def q_map_at_k(i: Inputs) -> DataFrame:
    """Per-user average precision@k."""
    return _scored(i).average_precision()


@register("mar_at_k", O.build(f"SELECT userid, n_relevant, n_hits, {O.r6('recall')} AS recall FROM recall_users", "recall_users"))
def q_mar_at_k(i: Inputs) -> DataFrame:
    """Per-user recall@k against the top-k relevant items."""
    return _scored(i).recall()


@register(
    "rank_metrics",
    O.build(
        f"""SELECT CAST({O.K} AS BIGINT) AS k, count(*) AS n_users,
       {O.r6('avg(coalesce(n.ndcg, 0.0))')} AS ndcg_at_k, {O.r6('avg(coalesce(a.ap, 0.0))')} AS map_at_k,
       {O.r6('avg(coalesce(r.recall, 0.0))')} AS mar_at_k
FROM ndcg_users n FULL JOIN ap_users a ON n.userid = a.userid
FULL JOIN recall_users r ON coalesce(n.userid, a.userid) = r.userid""",
        "ndcg_users",
        "ap_users",
        "recall_users",
    ),
)
def q_rank_metrics(i: Inputs) -> DataFrame:
    """EvaluationMetrics.compute_metric: mean NDCG@k, MAP@k, MAR@k."""
    return _scored(i).summary()


@register("topk_predicted_euclidean", O.build(f"SELECT userid, rank, itemid, {O.r6('score')} AS score FROM pred_items_euc", "pred_items_euc"))
def q_topk_predicted_euclidean(i: Inputs) -> DataFrame:
    """W3 + J8: each user's k nearest candidate items."""
    return _scored(i, "euclidean_distance").top_items()


@register(
    "rank_metrics_euclidean",
    O.build(
        f"""SELECT CAST({O.K} AS BIGINT) AS k, count(*) AS n_users,
       {O.r6('avg(coalesce(n.ndcg, 0.0))')} AS ndcg_at_k, {O.r6('avg(coalesce(a.ap, 0.0))')} AS map_at_k,
       {O.r6('avg(coalesce(r.recall, 0.0))')} AS mar_at_k
FROM ndcg_users_euc n FULL JOIN ap_users_euc a ON n.userid = a.userid
FULL JOIN recall_users_euc r ON coalesce(n.userid, a.userid) = r.userid""",
        "ndcg_users_euc",
        "ap_users_euc",
        "recall_users_euc",
    ),
)
def q_rank_metrics_euclidean(i: Inputs) -> DataFrame:
    """Mean NDCG@k, MAP@k, MAR@k with items ordered by distance, nearest first."""
    return _scored(i, "euclidean_distance").summary()


# ------------------------------------------------------------------ rerank


def _rerank(i: Inputs, metric: str) -> DataFrame:
    return RR.rerank(i.rerank_requests, i.user_factors, i.item_factors, metric)


@register("rerank_dot", O.rerank_sql("dot_product"))
def q_rerank_dot(i: Inputs) -> DataFrame:
    """Every request's products ordered by dot product."""
    return _rerank(i, "dot_product")


@register("rerank_cosine", O.rerank_sql("cosine"))
def q_rerank_cosine(i: Inputs) -> DataFrame:
    """Ordered by (per-item) cosine similarity."""
    return _rerank(i, "cosine")


@register("rerank_euclidean", O.rerank_sql("euclidean_distance"))
def q_rerank_euclidean(i: Inputs) -> DataFrame:
    """Ordered by euclidean distance, nearest first."""
    return _rerank(i, "euclidean_distance")


@register("rerank_cosine_list_norm", O.rerank_sql("list_norm"))
def q_rerank_cosine_list_norm(i: Inputs) -> DataFrame:
    """R4 with the norm taken over the whole product list."""
    return RR.rerank(i.rerank_requests, i.user_factors, i.item_factors, "cosine", cosine_norm="frobenius")


@register("rerank_by_function", O.rerank_sql("per_item_length"))
def q_rerank_by_function(i: Inputs) -> DataFrame:
    """R2: ordered by a function of the two vectors (dot product over the item's length)."""
    return RR.rerank(i.rerank_requests, i.user_factors, i.item_factors, lambda u, v: F.try_divide(V.dot(u, v), V.norm(v)))


@register("rerank_whole_requests", O.rerank_sql("dot_product", whole=True))
def q_rerank_whole_requests(i: Inputs) -> DataFrame:
    """R1 + R3 on every request: products or users without a vector stay, unscored and last."""
    return RR.rerank(i.whole_requests, i.user_factors, i.item_factors, on_missing="keep")


@register(
    "rerank_missing",
    O.build(
        """SELECT request_id, 'user' AS kind, userid AS id FROM whole_requests WHERE userid NOT IN (SELECT id FROM user_factors)
UNION ALL
SELECT request_id, 'item' AS kind, itemid AS id FROM whole_exploded WHERE itemid NOT IN (SELECT id FROM item_factors)""",
        "whole_exploded",
        "user_factors",
        "item_factors",
    ),
)
def q_rerank_missing(i: Inputs) -> DataFrame:
    """Every requested id without a factor vector."""
    return RR.missing_ids(i.whole_requests, i.user_factors, i.item_factors)


# ------------------------------------------------------------------ model

LOSS_ALPHA, LOSS_REG = 40.0, 1.0
ALS_RANK = 10


@register(
    "id_dictionary",
    O.build(
        """SELECT 'user' AS kind, userid AS id, CAST(dense_rank() OVER (ORDER BY userid) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT userid FROM train_matrix)
UNION ALL
SELECT 'item' AS kind, itemid AS id, CAST(dense_rank() OVER (ORDER BY itemid) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT itemid FROM train_matrix)""",
        "train_matrix",
    ),
)
def q_id_dictionary(i: Inputs) -> DataFrame:
    """M1: dense int ids for users and items of the training matrix."""
    users, items = FA.id_dictionary(i.train_matrix)
    return users.select(F.lit("user").alias("kind"), F.col("userid").alias("id"), F.col("u").alias("idx")).unionByName(
        items.select(F.lit("item").alias("kind"), F.col("itemid").alias("id"), F.col("i").alias("idx"))
    )


@register(
    "summed_ratings",
    O.build(f"SELECT userid, itemid, {O.r6('sum(weight_items)')} AS rating FROM train_weights GROUP BY userid, itemid", "train_weights"),
)
def q_summed_ratings(i: Inputs) -> DataFrame:
    """One row per user, item and day in, duplicates summed as before a fit."""
    daily = affinity.day_weights(affinity.user_item_day(i.cart_events, i.cfg.train), "window")
    return FA.summed_ratings(daily.select("userid", "itemid", F.col("weight_items").alias("rating")))


@register(
    "als_factors",
    O.build(
        f"""SELECT DISTINCT 'user' AS kind, userid AS id, CAST({ALS_RANK} AS BIGINT) AS rank FROM train_matrix
UNION ALL SELECT DISTINCT 'item' AS kind, itemid AS id, CAST({ALS_RANK} AS BIGINT) AS rank FROM train_matrix""",
        "train_matrix",
    ),
)
def q_als_factors(i: Inputs) -> DataFrame:
    """M2 + M3: implicit ALS on the training matrix; one row per user and item vector."""
    users, items = FA.fit_als(i.train_matrix, FA.ALSParams(rank=ALS_RANK, regularization=1.0, alpha=40.0, iterations=10, seed=42))
    u = users.select(F.lit("user").alias("kind"), "id", F.size("features").cast("bigint").alias("rank"))
    it = items.select(F.lit("item").alias("kind"), "id", F.size("features").cast("bigint").alias("rank"))
    return u.unionByName(it)


@register(
    "implicit_loss",
    O.build(
        f"""SELECT n_users, n_items, nnz, n_ratings_without_vectors, {O.r6('total_confidence')} AS total_confidence,
       {O.r6('observed_loss / w')} AS observed_share, {O.r6('unobserved_loss / w')} AS unobserved_share,
       {O.r6('reg_loss / w')} AS reg_share, {O.r6('(observed_loss + unobserved_loss + reg_loss) / w')} AS loss_normalized
FROM (
  SELECT *, total_confidence + n_users * n_items - nnz AS w FROM (
    SELECT (SELECT count(*) FROM user_factors) AS n_users, (SELECT count(*) FROM item_factors) AS n_items,
           count(*) AS nnz, (SELECT count(*) FROM train_matrix) - count(*) AS n_ratings_without_vectors, sum({LOSS_ALPHA} * t.rating) AS total_confidence,
           sum({LOSS_ALPHA} * t.rating * power(1 - list_inner_product(u.features, i.features), 2)) AS observed_loss,
           (SELECT sum(power(list_inner_product(a.features, b.features), 2)) FROM user_factors a CROSS JOIN item_factors b)
             - sum(power(list_inner_product(u.features, i.features), 2)) AS unobserved_loss,
           {LOSS_REG} * ((SELECT sum(list_sum(list_transform(features, lambda x: x * x))) FROM user_factors)
                       + (SELECT sum(list_sum(list_transform(features, lambda x: x * x))) FROM item_factors)) AS reg_loss
    FROM train_matrix t JOIN user_factors u ON t.userid = u.id JOIN item_factors i ON t.itemid = i.id
  )
)""",
        "train_matrix",
        "user_factors",
        "item_factors",
    ),
)
def q_implicit_loss(i: Inputs) -> DataFrame:
    """M4: implicit objective of the fixed factors on the training matrix (terms per unit weight)."""
    loss = FA.implicit_loss(i.train_matrix, i.user_factors, i.item_factors, LOSS_ALPHA, LOSS_REG)
    w = F.col("total_confidence") + F.col("n_users") * F.col("n_items") - F.col("nnz")
    return loss.select(
        "n_users",
        "n_items",
        "nnz",
        "n_ratings_without_vectors",
        "total_confidence",
        (F.col("observed_loss") / w).alias("observed_share"),
        (F.col("unobserved_loss") / w).alias("unobserved_share"),
        (F.col("reg_loss") / w).alias("reg_share"),
        "loss_normalized",
    )


@register(
    "kfold_assign",
    O.build(
        f"SELECT userid, itemid, {O.r6('rating')} AS rating, CAST(ntile(3) OVER (ORDER BY userid, itemid) AS BIGINT) AS fold FROM train_matrix",
        "train_matrix",
    ),
)
def q_kfold_assign(i: Inputs) -> DataFrame:
    """M6: three contiguous folds over the training matrix ordered by (user, item)."""
    return FA.kfold_assign(i.train_matrix, 3)


@register(
    "kfold_by_user",
    O.build(
        f"SELECT userid, itemid, {O.r6('rating')} AS rating, {O._h60('userid')} % 3 + 1 AS fold FROM train_matrix",
        "train_matrix",
    ),
)
def q_kfold_by_user(i: Inputs) -> DataFrame:
    """M6 by user: three folds by the user's hash."""
    return FA.kfold_assign(i.train_matrix, 3, fold_by="user")


@register("replay_evaluator", O.build("SELECT mai FROM (" + O.improvement_select("shift_rows_dot", 3) + ")", "shift_rows_dot"))
def q_replay_evaluator(i: Inputs) -> DataFrame:
    """M7: the ``pyspark.ml`` evaluator's value for the fixed factors."""
    model = ImplicitRankerModel(i.user_factors, i.item_factors, ReplayScorer(i.merged, "dot_product", i.cfg.cold_start))
    return ReplayEvaluator(model.scorer).statistics(model.transform(i.train_matrix)).select("mai")


@register("run_report")
def q_run_report(i: Inputs) -> DataFrame:
    """M9: the whole run, trained with given parameters (``hyper_search`` has the search): matrices,
    model, rank metrics, replay; every figure as a row."""
    params = FA.ALSParams(rank=30, regularization=5.0, alpha=65.0, iterations=i.cfg.search.iterations, seed=i.cfg.search.seed)
    return report(run_pipeline(i.nameless_events, i.nameless_results, i.cfg, params=params))


@register("hyper_search")
def q_hyper_search(i: Inputs) -> DataFrame:
    """M5 + M7 + S6: the configured search space, every fold scored by replay MAI; the trial log as
    its sink wrote it."""
    merged = replay_prefix(i.nameless_events, i.nameless_results, i.cfg).persist()
    # the reference ran 8 search jobs at once; each fit keeps one core busy
    space = replace(i.cfg.search, parallelism=max(8, i.spark.sparkContext.defaultParallelism))
    trials, _best = search(i.train_matrix, ReplayScorer(merged, "dot_product"), space)
    return i.spark.read.parquet(sinks.write_trials(trials, i.folder("trials"), "parquet"))
