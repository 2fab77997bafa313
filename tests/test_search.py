"""M5-M7: all models scored in one replay, folds by counting, the pyspark.ml surface."""

import math
import os
import sys

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window as W
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from ranklift.config import SearchSpace
from ranklift.operators import factors, replay
from ranklift.plans import search as S
from ranklift.plans import tuning
from ranklift.plans.context import Inputs


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


@pytest.mark.parametrize(("metric", "cold_start"), [("dot_product", "minus_one"), ("euclidean_distance", "drop")])
def test_one_replay_scores_like_a_loop_over_fits(inputs, metric, cold_start):
    """The same fold scores as fitting and scoring one model after the other."""
    space = SearchSpace(rank=(2, 5), n_trials=2, folds=2, iterations=2, seed=3, parallelism=3)
    scorer = S.ReplayScorer(inputs.merged, metric, cold_start)
    log, best = S.search(inputs.train_matrix, scorer, space)
    got = {r["trial"]: [float(x) if x else None for x in r["fold_mai"].split(",")] for r in log.collect()}
    ids = factors.joint_dictionary(inputs.train_matrix)
    folded = factors.kfold_assign(inputs.train_matrix, space.folds).persist()
    want = {}
    for t, params in enumerate(S.sample_trials(space)):
        want[t] = [scorer.score(*factors.fit_als(folded.where(F.col("fold") != f).drop("fold"), params, dictionary=ids), params.rank) for f in (1, 2)]
    folded.unpersist()
    assert got == want
    means = {t: sum(x) / len(x) for t, x in want.items()}
    assert best == S.sample_trials(space)[min(means, key=lambda t: (-means[t], t))]


def test_search_by_user_and_without_folds(inputs):
    scorer = S.ReplayScorer(inputs.merged)
    log, _ = S.search(inputs.train_matrix, scorer, SearchSpace(rank=(2, 3), n_trials=1, folds=2, iterations=1, fold_by="user"))
    assert len(log.first()["fold_mai"].split(",")) == 2
    log, best = S.search(inputs.train_matrix, scorer, SearchSpace(rank=(2, 3), n_trials=1, folds=1, iterations=1))
    users, items = factors.fit_als(inputs.train_matrix, best)
    assert log.first()["mean_mai"] == scorer.score(users, items)


@pytest.mark.parametrize("folds", [1, 3, 400])
def test_contiguous_folds_are_ntile(spark, folds):
    rows = [(u, i) for u in range(12) for i in range((u * 7) % 11 + 1)] + [(5, i) for i in range(20, 90)]
    df = spark.createDataFrame(rows, "u int, i int").repartition(5)
    want = {(r.u, r.i): r.f for r in df.withColumn("f", F.ntile(folds).over(W.orderBy("u", "i"))).collect()}
    for sizes in ({}, {"items_per_range": 4, "users_per_chunk": 3}):
        got = {(r.u, r.i): r.fold for r in factors.contiguous_folds(df, folds, **sizes).collect()}
        assert got == want


def test_folds_keep_null_ids_and_user_folds_keep_users_whole(spark, inputs):
    df = spark.createDataFrame([("a", "x", 1.0), (None, "x", 2.0), ("a", None, 3.0), ("b", "y", 4.0)], "userid string, itemid string, rating double")
    assert [r.fold for r in factors.kfold_assign(df, 2).orderBy("rating").collect()] == [2, 1, 1, 2]
    by_user = factors.kfold_assign(inputs.train_matrix, 4, "user")
    assert by_user.groupBy("userid").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert {r.fold for r in by_user.select("fold").distinct().collect()} == {1, 2, 3, 4}
    assert factors.kfold_assign(df, 2, "user").count() == 4
    with pytest.raises(ValueError):
        factors.kfold_assign(df, 2, "day")


def test_training_sizes(inputs):
    ids = factors.joint_dictionary(inputs.train_matrix)
    folded = S.folded_ratings(inputs.train_matrix, ids, 3).persist()
    for f, size in S.training_sizes(folded, 3).items():
        part = folded.where(F.col("fold") != f)
        assert size == (part.count(), part.select("u").distinct().count())
    folded.unpersist()


def test_evaluator_is_the_improvement(inputs):
    scorer = S.ReplayScorer(inputs.merged)
    model = tuning.ImplicitRankerModel(inputs.user_factors, inputs.item_factors, scorer)
    evaluator = tuning.ReplayEvaluator(scorer)
    assert evaluator.isLargerBetter()
    assert evaluator.evaluate(model.transform(inputs.test_matrix)) == scorer.score(inputs.user_factors, inputs.item_factors)
    assert math.isnan(evaluator.evaluate(model.transform(inputs.test_matrix).where("false")))


def test_cross_validator_over_our_folds(inputs):
    scorer = S.ReplayScorer(inputs.merged)
    grid = [{"rank": 2, "regularization": 1.0}, {"rank": 3, "regularization": 5.0}]
    cv = tuning.cross_validate(inputs.train_matrix, scorer, grid, folds=2, fold_by="user", iterations=1, seed=5)
    folded = factors.kfold_assign(inputs.train_matrix, 2, "user").persist()
    want = []
    for point in grid:
        params = factors.ALSParams(iterations=1, seed=5, alpha=40.0, **point)
        own = [scorer.score(*factors.fit_als(folded.where(F.col("fold") != f).drop("fold"), params)) for f in (1, 2)]
        want.append(sum(own) / 2)
    folded.unpersist()
    assert cv.avgMetrics == pytest.approx(want, abs=1e-12)
    assert cv.bestModel.getOrDefault("rank") == grid[max(range(2), key=lambda j: want[j])]["rank"]
    assert set(cv.transform(inputs.test_matrix).columns) >= {"prediction", "imp_itemid"}


def test_large_groups_are_numbered_in_ranges(spark, inputs):
    """Every group dealt over ranges, and some of them: the rows of the numbering in a task."""
    predicted = replay.predict_pairs(inputs.merged, inputs.user_factors, inputs.item_factors, "dot_product")
    key = lambda df: sorted(map(tuple, df.select(*replay.GROUP, "slot", "predict_itemid", F.round("prediction", 9), "imp_position").collect()))
    plain = key(replay.slot_assignment(predicted, "dot_product"))
    assert key(replay.slot_assignment(predicted, "dot_product", hot_rows=0)) == plain
    assert key(replay.slot_assignment(predicted, "dot_product", hot_rows=12, sizes_from=inputs.merged)) == plain
    both = replay.predict_pairs_all(inputs.merged, inputs.user_factors, inputs.item_factors)
    assert key(replay.slot_assignment(both, None, keys=("metric",), hot_rows=12).where("metric = 'dot_product'")) == plain


def test_a_group_with_a_third_of_all_rows_spreads(spark):
    from ranklift.operators.numbering import rank_by_range

    rows = [("hot", i % 50, float(i % 7)) for i in range(3000)] + [(f"g{i % 600}", i % 5, 1.0) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, pos int, v double").repartition(8)
    got = rank_by_range(df, ["g"], [F.col("v").desc(), F.col("pos")], "rank", partitions=9)
    tasks = got.where("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 3
    ordered = got.where("g = 'hot'").orderBy("rank").collect()
    assert [r["rank"] for r in ordered] == list(range(1, 3001))
    assert [(-r.v, r.pos) for r in ordered] == sorted((-r.v, r.pos) for r in ordered)


def test_slots_with_and_without_rounding(spark):
    rows = [("d", "u", "c", "i1", 0.0, "q", "i2", 1.0), ("d", "u", "c", "i2", 0.0, "q", "i2", 1.0 + 1e-12)]
    df = spark.createDataFrame(rows, "fecha string, userid string, correlation_id string, imp_itemid string, imp_position double, search_query string, a2c_itemid string, prediction double")
    df = df.withColumn("imp_position", F.when(F.col("imp_itemid") == "i1", 0.0).otherwise(1.0))
    order = lambda metric, **o: [r.predict_itemid for r in replay.slot_assignment(df, metric, **o).orderBy("slot").collect()]
    assert order("dot_product") == ["i1", "i2"] and order("dot_product", digits=None) == ["i2", "i1"]
    assert order("euclidean_distance", digits=None) == ["i1", "i2"]


def test_fits_at_once_share_the_blocks(spark, monkeypatch):
    """Eight fits busy the cores together: each moves a vector once in an iteration."""
    asked = []

    def fit(part, params, n_ratings, n_users):
        asked.append(params.blocks)
        return spark.createDataFrame([("u", 0, [1.0])], "kind string, idx int, features array<float>")

    monkeypatch.setattr(S, "fit_encoded", fit)
    folded = spark.createDataFrame([(0, 0, 1.0, 1)], "u int, i int, rating double, fold int")
    fits = {m: (factors.ALSParams(), 2) for m in range(3)}
    assert S.fit_models(folded, fits, {2: (1_700_000, 90_000)}, 8).count() == 3 and asked == [1, 1, 1]
    asked.clear()
    S.fit_models(folded, fits, {2: (1_700_000, 90_000)}, 1)
    assert asked == [5, 5, 5]
