"""Hand-worked cases (FIXTURES.md §3) on inline rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ranklift import schemas
from ranklift.config import Window
from ranklift.operators import affinity, rank_metrics, replay, sampling


def _events(spark, rows):
    return spark.createDataFrame(rows, schemas.CART_EVENTS)


def _factors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], schemas.FACTORS)


def test_affinity_two_items_one_day(spark):
    ev = _events(
        spark,
        [
            ("20200101", "u1", "c1", "abc", "A", 0.0, 30.0, "a"),
            ("20200101", "u1", "c1", "abc", "B", 1.0, 10.0, "b"),
        ],
    )
    got = {r["itemid"]: r["rating"] for r in affinity.affinity_matrix(ev, Window("20200101", "20200101")).collect()}
    assert got == pytest.approx({"A": 2.25, "B": 1.75})


def test_affinity_null_or_zero_prices_dropped(spark):
    ev = _events(
        spark,
        [
            ("20200101", "u2", "c2", "abc", "C", 0.0, None, "c"),
            ("20200101", "u3", "c3", "abc", "D", 0.0, 0.0, "d"),
            ("20200101", "u4", "c4", "abc", "E", 0.0, 5.0, "e"),
        ],
    )
    got = affinity.affinity_matrix(ev, Window("20200101", "20200101")).collect()
    assert [(r["userid"], r["itemid"]) for r in got] == [("u4", "E")]


def test_affinity_window_and_tokens(spark):
    ev = _events(
        spark,
        [
            ("20200101", "null", "c", "abc", "A", 0.0, 1.0, "a"),
            ("20200101", "u1", "c", "abc", "(not set)", 0.0, 1.0, "a"),
            ("20200101", None, "c", "abc", "A", 0.0, 1.0, "a"),
            ("20191231", "u1", "c", "abc", "A", 0.0, 1.0, "a"),
            ("20200101", "undefined", "c", "abc", "A", 0.0, 1.0, "a"),  # kept by the affinity query
        ],
    )
    got = affinity.affinity_matrix(ev, Window("20200101", "20200105")).collect()
    assert [(r["userid"], r["itemid"], r["rating"]) for r in got] == [("undefined", "A", 3.0)]


def _scored(spark, known_rows, users, items, k):
    known = spark.createDataFrame(known_rows, schemas.USER_ITEM)
    return rank_metrics.Scored(known, _factors(spark, users), _factors(spark, items), k, "dot_product")


def test_average_precision_hits_at_1_and_3(spark):
    s = _scored(
        spark,
        [("u", "A", 2.0), ("u", "C", 1.5), ("u2", "B", 1.2)],
        [("u", [1, 0]), ("u2", [0, 1])],
        [("A", [3, 0]), ("B", [2, 0]), ("C", [1, 0])],
        3,
    )
    ap = {r["userid"]: r["ap"] for r in s.average_precision().collect()}
    assert ap["u"] == pytest.approx((1 + 2 / 3) / 2)


def test_recall_half(spark):
    s = _scored(
        spark,
        [("u", "A", 2.0), ("u", "B", 1.5), ("u2", "C", 1.2)],
        [("u", [1, 0]), ("u2", [0, 1])],
        [("A", [3, 0]), ("C", [2, 0]), ("B", [1, 0])],
        2,
    )
    rec = {r["userid"]: r["recall"] for r in s.recall().collect()}
    assert rec["u"] == pytest.approx(0.5)


def test_ndcg_perfect_order_is_one(spark):
    s = _scored(
        spark,
        [("u", "A", 3.0), ("u", "B", 2.0), ("u", "C", 1.0)],
        [("u", [1, 0])],
        [("A", [3, 0]), ("B", [2, 0]), ("C", [1, 0])],
        3,
    )
    assert s.ndcg().collect()[0]["ndcg"] == pytest.approx(1.0)


@pytest.mark.parametrize("item_block", [1, 2, 4096])
def test_ndcg_all_tied_is_tie_averaged(spark, item_block):
    known = spark.createDataFrame([("u", "A", 3.0), ("u", "C", 1.0), ("v", "B", 2.0)], schemas.USER_ITEM)
    users = _factors(spark, [("u", [1, 1]), ("v", [1, 1])])
    items = _factors(spark, [("A", [1, 0]), ("B", [1, 0]), ("C", [1, 0])])
    s = rank_metrics.Scored(known, users, items, 2, "dot_product", item_block=item_block)
    got = {r["userid"]: r["ndcg"] for r in s.ndcg().collect()}
    d1, d2 = 1.0, 1 / math.log2(3)
    assert got["u"] == pytest.approx((4 / 3) * (d1 + d2) / (3 * d1 + 1 * d2))


def _merged(spark, rows):
    schema = (
        "fecha date, userid string, correlation_id string, imp_itemid string, imp_position double, "
        "search_query string, a2c_itemid string, a2c_position double"
    )
    return spark.createDataFrame(rows, schema)


DAY = dt.date(2020, 1, 1)


def test_slots_best_item_last(spark):
    merged = _merged(
        spark,
        [
            (DAY, "u", "c", "X", 0.0, "q", "Z", 5.0),
            (DAY, "u", "c", "Y", 1.0, "q", "Z", 5.0),
            (DAY, "u", "c", "Z", 5.0, "q", "Z", 5.0),
        ],
    )
    users = _factors(spark, [("u", [1.0])])
    items = _factors(spark, [("Z", [3.0]), ("X", [2.0]), ("Y", [1.0])])
    pred = replay.predict_pairs(merged, users, items, "dot_product")
    slots = {r["predict_itemid"]: r["imp_position"] for r in replay.slot_assignment(pred, "dot_product").collect()}
    assert slots == {"Z": 0.0, "X": 1.0, "Y": 5.0}
    shift = replay.position_shift(merged, replay.slot_assignment(pred, "dot_product")).collect()
    assert [(r["current_pos"], r["predict_pos"], r["diff_pos"], r["n_pairs"]) for r in shift] == [(5.0, 0.0, 5.0, 1)]


def test_same_add_drawn_twice_weights_four(spark):
    base = [
        (DAY, "u", "c", "X", 0.0, "q", "Y", 1.0),
        (DAY, "u", "c", "Y", 1.0, "q", "Y", 1.0),
    ]
    merged = _merged(spark, base + base)
    users = _factors(spark, [("u", [1.0])])
    items = _factors(spark, [("X", [1.0]), ("Y", [2.0])])
    pred = replay.predict_pairs(merged, users, items, "dot_product")
    shift = replay.position_shift(merged, replay.slot_assignment(pred, "dot_product"))
    stats = replay.improvement_overall(shift).collect()[0]
    assert stats["n"] == 4
    assert stats["mean_diff"] == pytest.approx(1.0)


def test_small_query_has_no_draws(spark):
    adds = spark.createDataFrame(
        [(DAY, "q", f"u{i}", f"c{i}", "A", 0.0) for i in range(4)],
        "fecha date, search_query string, userid string, correlation_id string, a2c_itemid string, a2c_position double",
    )
    assert sampling.sample_per_query(adds, 0.2).count() == 0
    assert sampling.sample_per_query(adds, 0.5).count() == 2


def test_cold_start_minus_one(spark):
    merged = _merged(spark, [(DAY, "nobody", "c", "nothing", 0.0, "q", "nothing", 0.0)])
    users = _factors(spark, [("u", [0.5] * 8)])
    items = _factors(spark, [("i", [0.5] * 8)])
    dot = replay.predict_pairs(merged, users, items, "dot_product").collect()[0]["prediction"]
    euc = replay.predict_pairs(merged, users, items, "euclidean_distance").collect()[0]["prediction"]
    assert dot == pytest.approx(8.0)
    assert euc == pytest.approx(0.0)


def test_two_queries_in_one_search(spark):
    shown = [("X", 0.0), ("Y", 1.0), ("Z", 2.0)]
    rows_a = [(DAY, "u", "c", it, p, "qa", "Y", 1.0) for it, p in shown]
    rows_b = [(DAY, "u", "c", it, p, "qb", "Z", 2.0) for it, p in shown]
    users = _factors(spark, [("u", [1.0])])
    items = _factors(spark, [("X", [1.0]), ("Y", [3.0]), ("Z", [2.0])])

    def shift(rows):
        m = _merged(spark, rows)
        pred = replay.predict_pairs(m, users, items, "dot_product")
        out = replay.position_shift(m, replay.slot_assignment(pred, "dot_product")).collect()
        return sorted((r["search_query"], r["current_pos"], r["predict_pos"]) for r in out)

    assert shift(rows_a + rows_b) == sorted(shift(rows_a) + shift(rows_b))
    assert shift(rows_a) == [("qa", 1.0, 0.0)]


def test_quantiles_linear_interpolation(spark):
    rows = [(DAY, "u", "c", "q", "A", float(x), 0.0, float(x), 1) for x in (1, 2, 4, 7, 11)]
    shift = spark.createDataFrame(
        rows,
        "fecha date, userid string, correlation_id string, search_query string, a2c_itemid string, "
        "current_pos double, predict_pos double, diff_pos double, n_pairs bigint",
    )
    r = replay.improvement_overall(shift).collect()[0]
    assert [r["q10"], r["q25"], r["q50"], r["q75"], r["q90"]] == pytest.approx([1.4, 2, 4, 7, 9.4])


def test_weighted_quantiles_equal_expanded(spark):
    schema = (
        "fecha date, userid string, correlation_id string, search_query string, a2c_itemid string, "
        "current_pos double, predict_pos double, diff_pos double, n_pairs bigint"
    )
    weighted = spark.createDataFrame(
        [(DAY, "u", "c", "q", "A", 1.0, 0.0, 1.0, 1), (DAY, "u", "c", "q", "B", 2.0, 0.0, 2.0, 3)], schema
    )
    expanded = spark.createDataFrame(
        [(DAY, "u", "c", "q", "A", 1.0, 0.0, 1.0, 1)] + [(DAY, "u", "c", "q", "B", 2.0, 0.0, 2.0, 1)] * 3, schema
    )
    a = replay.improvement_overall(weighted).collect()[0].asDict()
    b = replay.improvement_overall(expanded).collect()[0].asDict()
    assert a == pytest.approx(b)


def test_rerank_orders(spark):
    from ranklift.operators import rerank

    req = spark.createDataFrame([(1, "u", ["A", "B", "C"])], schemas.RERANK_REQUESTS)
    users = _factors(spark, [("u", [1.0, 0.0])])
    items = _factors(spark, [("A", [1.0, 0.0]), ("B", [3.0, 0.0]), ("C", [0.0, 1.0])])

    def order(metric):
        rows = rerank.rerank(req, users, items, metric).orderBy("rank").collect()
        return [r["itemid"] for r in rows]

    assert order("dot_product") == ["B", "A", "C"]
    assert order("cosine") == ["A", "B", "C"]  # A and B both cosine 1: list order
    assert order("euclidean_distance") == ["A", "C", "B"]
    with pytest.raises(ValueError):
        rerank.rerank(req, users, items, "manhattan")


def test_rerank_with_score_function(spark):
    from ranklift.functions import dot
    from ranklift.operators import rerank

    req = spark.createDataFrame([(1, "u", ["A", "B", "C"])], schemas.RERANK_REQUESTS)
    users = _factors(spark, [("u", [1.0, 0.0])])
    items = _factors(spark, [("A", [1.0, 0.0]), ("B", [3.0, 0.0]), ("C", [0.0, 1.0])])
    by_fn = rerank.rerank(req, users, items, lambda u, v: dot(u, v)).orderBy("rank").collect()
    assert [r["itemid"] for r in by_fn] == ["B", "A", "C"]


def test_rerank_unknown_ids_fail_or_stay(spark):
    from ranklift.operators import rerank as rr

    users = spark.createDataFrame([("u", [1.0, 0.0])], "id string, features array<double>")
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0])], "id string, features array<double>")
    asked = spark.createDataFrame([(1, "u", ["a", "x", "b"]), (2, "v", ["a"])], "request_id long, userid string, products array<string>")
    with pytest.raises(Exception, match="no factor vector for"):
        rr.rerank(asked, users, items).collect()
    kept = rr.rerank(asked, users, items, on_missing="keep").orderBy("request_id", "rank").collect()
    assert [(r["request_id"], r["itemid"], r["score"]) for r in kept] == [(1, "b", 2.0), (1, "a", 1.0), (1, "x", None), (2, "a", None)]
