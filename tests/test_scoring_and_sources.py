"""Pruned retrieval, partitioned and sorted tables, pushdown of the SQL templates."""

import tempfile

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ranklift import schemas
from ranklift.config import Window
from ranklift.operators import cleaning, factors, rank_metrics, scoring
from ranklift.plans.context import Inputs
from ranklift.sources import sinks, tables, templates


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def planted(spark, rng, users=40, items=400, spread=1.5):
    """Vectors of very different lengths, ties among items, users with equal vectors."""
    u = rng.normal(size=(users, 6)) * rng.lognormal(0, spread, (users, 1))
    v = rng.normal(size=(items, 6)) * rng.lognormal(0, spread, (items, 1))
    v[items // 2 : items // 2 + 20] = v[0]
    u[1], u[2] = u[0], 0.0
    table = lambda x, p: spark.createDataFrame([(f"{p}{i:04d}", list(map(float, r))) for i, r in enumerate(x)], schemas.FACTORS)
    pairs = {(int(a), int(b)) for a, b in zip(rng.integers(0, users, 1500), rng.integers(0, items, 1500))} | {(a, a) for a in range(users)} | {(0, b) for b in range(items)}
    known = spark.createDataFrame([(f"u{a:04d}", f"i{b:04d}", float(1 + (a * b) % 5)) for a, b in sorted(pairs)], schemas.USER_ITEM)
    return known, table(u, "u"), table(v, "i")


@pytest.mark.parametrize("metric", ["dot_product", "euclidean_distance"])
def test_pruned_scan_equals_the_full_one(spark, metric):
    known, users, items = planted(spark, np.random.default_rng(7))
    full = rank_metrics.Scored(known, users, items, 5, metric, item_block=10_000)
    rows = lambda s: sorted(map(tuple, s.top_items().select("userid", "rank", "itemid", F.round("score", 9)).collect()))
    levels = lambda s: sorted(map(tuple, s.levels().select("userid", "level_start", F.round("level_key", 8), "n_items", F.round("gain_sum", 9)).collect()))
    every = [{"item_block": 32, "user_block": 8, "first_bytes": 64 * 6 * 8}, {"item_block": 32}, {"item_block": 50, "user_block": 16, "first_bytes": 0}]
    for opts in every if metric == "dot_product" else every[:1]:
        cut = rank_metrics.Scored(known, users, items, 5, metric, **opts)
        assert rows(cut) == rows(full) and levels(cut) == levels(full)
        report = cut.scan_report().first()
        assert report["n_scored"] <= report["n_pairs"] and (report["share_skipped"] > 0.1 or opts.get("first_bytes") == 0), report
        assert "CartesianProduct" not in plan(cut.top_items())
    assert full.scan_report().first()["share_skipped"] == 0


@pytest.mark.parametrize("metric", ["dot_product", "euclidean_distance"])
@pytest.mark.parametrize("case", ["floats", "close", "large", "tiny", "few"])
def test_floats_only_select(metric, case):
    """The catalogue is prepared once, for every task; its floats only select: scores closer than floats
    can tell, lengths that floats cannot hold and ties give the rows of doubles."""
    rng, k, dot = np.random.default_rng(3), 5, metric == "dot_product"
    u, v = rng.normal(size=(30, 7)), rng.normal(size=(4 if case == "few" else 300, 7))
    if case == "floats":
        u, v = u.astype(np.float32).astype(float), v.astype(np.float32).astype(float)
    if case == "close":
        v = v[0] + 1e-8 * v
    if case in ("large", "tiny"):
        u, v = u * 10.0 ** rng.integers(-2, 3, (30, 1)), v * 10.0 ** (rng.integers(15, 30, (300, 1)) if case == "large" else rng.integers(-45, -30, (300, 1)))
    v[-3:] = v[0]
    users, items = [f"u{i:03d}" for i in range(len(u))], [f"i{j:03d}" for j in range(len(v))]
    order = rng.permutation(len(v))
    blocks = [(np.array(items, dtype=object)[order[a : a + 64]], v[order[a : a + 64]]) for a in range(0, len(v), 64)]
    ids, number, parts = scoring._cataloguer(dot)(blocks)
    assert list(ids) == items and all(number[x] == j for j, x in enumerate(items))
    assert all((x.dtype == np.float32) == (case == "floats") for _, x, *_ in parts)
    shared = type("Shared", (), {"value": (ids, number, parts)})
    cell = lambda x, t: pa.array([x], pa.list_(t))
    columns = {"u_ids": cell(users, pa.string()), "u_vecs": cell(u.ravel(), pa.float64()), "r_u": cell(users * 2, pa.string()), "r_i": cell([items[0]] * 60, pa.string()), "r_v": cell([1.5] * 60, pa.float64())}
    digits = None if case == "tiny" else 9
    got = [r for b in scoring._block_scorer(k, metric, digits, shared)(iter([pa.RecordBatch.from_pydict(columns)])) for r in b.to_pylist() if r["userid"]]
    raw = np.array([[(a * b).sum() if dot else np.sqrt(((a - b) ** 2).sum()) for b in v] for a in u])
    key = (raw if dot else -raw) if digits is None else np.round(raw if dot else -raw, digits)
    for i, user in enumerate(users):
        best = sorted(range(len(v)), key=lambda j: (-key[i, j], items[j]))[:k]
        mine = [r for r in got if r["userid"] == user and r["itemid"]]
        assert [(r["itemid"], r["key"], r["gain"]) for r in mine] == [(items[j], key[i, j], 3.0 * (j == 0)) for j in best]
        levels = [(r["key"], r["cnt"], r["gain"]) for r in got if r["userid"] == user and not r["itemid"]]
        want = {key[i, j]: None for j in best}
        assert levels == [(x, int((key[i] == x).sum()), 3.0 * (key[i, 0] == x)) for x in want]


def test_gram_and_lazy_loss(spark, inputs):
    g = {r["pos"]: r["g"] for r in factors.gram(inputs.item_factors).collect()}
    x = np.array([r["features"] for r in inputs.item_factors.collect()])
    assert g.pop(-1) == len(x)
    np.testing.assert_allclose([g[i] for i in range(len(g))], (x.T @ x).ravel(), rtol=1e-9, atol=1e-9)
    none = inputs.user_factors.where("false")
    r = factors.implicit_loss(inputs.train_matrix, none, none, 40.0, 1.0).first()
    assert (r["n_users"], r["nnz"], r["loss"], r["n_ratings_without_vectors"]) == (0, 0, 0.0, inputs.train_matrix.count())


@pytest.mark.parametrize("grain", ["day", "month"])
def test_partitioned_scan_reads_the_windows_files(spark, inputs, grain):
    path = tables.write_partitioned(inputs.cart_events.where("event_dt < '19950401'"), tempfile.mkdtemp(dir="/tmp") + "/t", "event_dt", grain, files_per_part=2)
    window = Window("19950105", "19950120")
    got = tables.scan_cart_events(spark, path, window)
    text = plan(got)
    column = tables.GRAINS[grain][0]
    assert f"PartitionFilters: [isnotnull({column}" in text and "ReadSchema" in text
    parts = {f.split(f"{column}=")[1].split("/")[0] for f in (r[0] for r in got.select(F.input_file_name()).distinct().collect()) if f"{column}=" in f}
    assert parts and all(window.start[: len(p)] <= p <= window.end[: len(p)] for p in parts)
    want = inputs.cart_events.where(F.col("event_dt").between(window.start, window.end))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    days = spark.createDataFrame([("19950110",), ("19950111",), (None,)], "day string")
    some = tables.scan_cart_events(spark, path, days=days)
    assert "dynamicpruning" in plan(some).lower()
    assert sorted(map(repr, some.collect())) == sorted(map(repr, inputs.cart_events.where("event_dt in ('19950110', '19950111')").collect()))


def test_partitioned_impressions(spark, inputs):
    path = tables.write_partitioned(inputs.search_results.where("SCL_CREATED_DATE < date'1995-03-01'"), tempfile.mkdtemp(dir="/tmp") + "/t", "SCL_CREATED_DATE", "day")
    day = Window("19950210", "19950210")
    got = cleaning.clean_impressions(tables.scan_impressions(spark, path, day), day)
    assert "PartitionFilters: [isnotnull(part_day" in plan(got)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, cleaning.clean_impressions(inputs.search_results, day).collect()))


def test_sorted_sink_reads_back_in_one_order(spark):
    rows = [(None, 3), ("a", None)] + [(f"k{i % 40:02d}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    for files in (1, 4, 16):
        path = sinks.write_sorted(df, ["k", "v"], tempfile.mkdtemp(dir="/tmp") + "/s", files)
        got = [(r.k, r.v) for r in sinks.read_sorted(spark, path).orderBy("place").collect()]
        assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
        assert [r.place for r in sinks.read_sorted(spark, path).orderBy("place").collect()] == list(range(len(rows)))
    assert sinks.read_sorted(spark, sinks.write_sorted(df.where("false"), ["k"], tempfile.mkdtemp(dir="/tmp") + "/s")).count() == 0


def test_template_predicates_reach_the_scan(spark, inputs):
    path = tempfile.mkdtemp(dir="/tmp")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    inputs.cart_events.write.parquet(f"{path}/c")
    inputs.search_results.write.parquet(f"{path}/s")
    templates.register_views(spark.read.parquet(f"{path}/c"), spark.read.parquet(f"{path}/s"))
    text = plan(templates.add2cart(spark, "20000101", "20001231"))
    pushed = text[text.index("PushedFilters") :].split("ReadSchema")[0]
    for c in ("userid", "item_id", "correlation_id", "search_query"):
        assert f"Not(In({c}" in pushed or f"Not(In([{c}" in pushed, pushed
    assert "GreaterThanOrEqual(event_dt,20000101)" in pushed
    assert "item_name" not in text[text.index("ReadSchema") :]
    text = plan(templates.impressions(spark, "20000101"))
    assert "Not(In(customer_id" in text and "SCL_CREATED_DATE" in text[text.index("PushedFilters") :]
