"""The whole run on sf0.001 with a two-trial search."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ranklift.config import RunConfig, SearchSpace, Window
from ranklift.operators import rerank
from ranklift.plans.pipeline import run_pipeline
from ranklift.sources import fixtures


def test_pipeline_end_to_end(spark, tmp_path):
    cfg = RunConfig(validation=Window("20000101", "20001231"), replay=Window("20010101", "20011231"), search=SearchSpace(rank=(3, 5), n_trials=2, folds=2, iterations=2, seed=1))
    out = run_pipeline(
        fixtures.cart_events(spark, SF_SMALL),
        fixtures.search_results(spark, SF_SMALL),
        cfg,
        output_path=str(tmp_path),
        run_date="2024-01-01",
    )
    trials = out["trials"].collect()
    assert len(trials) == 2 and sorted(t["place"] for t in trials) == [1, 2]
    for t in trials:
        scores = [float(x) for x in t["fold_mai"].split(",") if x]
        assert len(scores) == 2 and abs(sum(scores) / 2 - t["mean_mai"]) < 1e-12 and t["std_mai"] >= 0
    assert out["test_stats"].first()["n_rows"] == out["test_matrix"].count()
    m = out["rank_metrics"].collect()[0]
    for c in ("ndcg_at_k", "map_at_k", "mar_at_k"):
        assert 0.0 <= m[c] <= 1.0
    imp = out["improvement"].collect()[0]
    assert imp["n"] > 0
    assert out["user_factors"].count() == out["train_matrix"].select("userid").distinct().count()
    assert (tmp_path / "latent_vectors" / "run_date=2024-01-01" / "kind=users").is_dir()
    assert (tmp_path / "trials" / "run_date=2024-01-01").is_dir()


def test_rerank_missing_ids_and_frobenius(spark):
    users = fixtures.user_factors(spark, SF_SMALL)
    items = fixtures.item_factors(spark, SF_SMALL)
    req = fixtures.rerank_requests(spark, SF_SMALL, users, items)
    assert rerank.missing_ids(req, users, items).count() == 0
    bad = spark.createDataFrame([(1, "U0", ["I0", "I1"])], "request_id bigint, userid string, products array<string>")
    kinds = sorted((r["kind"], r["id"]) for r in rerank.missing_ids(bad, users, items).collect())
    assert kinds == [("item", "I0"), ("user", "U0")]
    # list-wide normalisation keeps the dot-product order
    dot = rerank.rerank(req, users, items, "dot_product").select("request_id", "rank", "itemid")
    frob = rerank.rerank(req, users, items, "cosine", cosine_norm="frobenius").select("request_id", "rank", "itemid")
    assert dot.exceptAll(frob).count() == 0
    # per-item cosine scores lie in [-1, 1]
    cos = rerank.rerank(req, users, items, "cosine")
    assert cos.where(F.abs("score") > 1 + 1e-9).count() == 0


def test_registered_search_is_the_configured_one(spark, monkeypatch):
    from dataclasses import replace

    from ranklift.plans import registry

    spaces = []
    monkeypatch.setattr(registry, "search", lambda train, scorer, space: (spaces.append(space) or train.limit(1), None))
    registry.QUERIES["hyper_search"](spark, SF_SMALL)
    assert [replace(s, parallelism=1) for s in spaces] == [SearchSpace()]


def test_report_of_a_run_with_given_parameters(spark):
    from ranklift.operators.factors import ALSParams
    from ranklift.plans.pipeline import report

    out = run_pipeline(fixtures.cart_events(spark, SF_SMALL), fixtures.search_results(spark, SF_SMALL), RunConfig(), params=ALSParams(rank=3, iterations=2))
    assert "trials" not in out
    rows = {(r.section, r.name): r.value for r in report(out).collect()}
    assert rows["rank_metrics", "ndcg_at_k"] == out["rank_metrics"].first()["ndcg_at_k"]
    assert rows["improvement", "mai"] == out["improvement"].first()["mai"]
    assert rows["train_stats", "n_rows"] == out["train_matrix"].count()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_asked_ids_are_not_sorted_for_the_missing_check(spark):
    from ranklift.operators import rerank

    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        req = spark.createDataFrame([(1, "u", ["a", "b", "b", None]), (2, None, ["a"])], "request_id bigint, userid string, products array<string>")
        ids = lambda *x: spark.createDataFrame([(i, [1.0]) for i in x], "id string, features array<double>")
        out = rerank.missing_ids(req, ids("v"), ids("a", "a"))
        assert "SortMergeJoin" not in _plan(out) and "ShuffledHashJoin" in _plan(out)
        got = sorted((r["request_id"], r["kind"], r["id"] or "") for r in out.collect())
        assert got == [(1, "item", ""), (1, "item", "b"), (1, "item", "b"), (1, "user", "u"), (2, "user", "")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_lines_are_not_sorted_to_meet_their_orders(spark):
    from ranklift.sources import fixtures

    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(fixtures.cart_events(spark, SF_SMALL, names=False))
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_a_run_holds_no_cache_and_no_shuffle(spark):
    from ranklift.operators.factors import ALSParams

    cached = spark._jsparkSession.sharedState().cacheManager()
    before = cached.numCachedEntries()
    out = run_pipeline(fixtures.cart_events(spark, SF_SMALL, names=False), fixtures.search_results(spark, SF_SMALL, names=False), RunConfig(), params=ALSParams(rank=3, iterations=2))
    assert cached.numCachedEntries() == before
    for name in set(out) - {"improvement_by_query"}:
        plan = _plan(out[name])
        assert "FileScan parquet" in plan and "Exchange" not in plan and "InMemoryTableScan" not in plan, name


def test_unpersisted_scores_leave_no_cached_frame(spark):
    from ranklift.operators.rank_metrics import Scored

    cached = spark._jsparkSession.sharedState().cacheManager()
    before = cached.numCachedEntries()
    vectors = lambda c, n: spark.range(n).selectExpr(f"concat('{c}', id) AS id", "array(cast(id AS double) / 7, 1.0D) AS features")
    known = spark.range(12).selectExpr("concat('u', id % 6) AS userid", "concat('i', id) AS itemid", "cast(id + 1 AS double) AS rating")
    scored = Scored(known, vectors("u", 6), vectors("i", 12), 2, "dot_product", first_bytes=64, item_block=2)
    assert scored.summary().first()["n_users"] == 6 and cached.numCachedEntries() == before + 4
    scored.unpersist()
    assert cached.numCachedEntries() == before
