"""Vectors brought to pairs by cells: the same rows as a join, and no vector moved per pair."""

from __future__ import annotations

import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import Row
from pyspark.sql import functions as F

from ranklift.functions import cosine, dot, euclidean, norm
from ranklift.functions.vectors import squared_norm
from ranklift.operators import pairs as P
from ranklift.operators import rerank as RR
from ranklift.plans.context import Inputs
from ranklift.sources import fixtures


def _tables(spark, entry=float, n_users=40, n_items=30, rank=3):
    vec = lambda x: [entry((x * 7 + j * 3) % 11) / 7 for j in range(rank)]
    users = spark.createDataFrame([(f"U{x}", vec(x)) for x in range(n_users)], "id string, features array<double>")
    items = spark.createDataFrame([(f"I{x}", vec(x + 5)) for x in range(n_items)], "id string, features array<double>")
    rows = [(x, f"U{x % 45}" if x % 50 else None, f"I{x * 13 % 33}" if x % 60 else None, "n" if x % 2 else None) for x in range(400)]
    return spark.createDataFrame(rows, "n long, userid string, itemid string, note string"), users, items


def _joined(pairs, users, items):
    u = users.select(F.col("id").alias("userid"), F.col("features").alias("_u"))
    v = items.select(F.col("id").alias("itemid"), F.col("features").alias("_v"))
    return pairs.join(u, "userid", "left").join(v, "itemid", "left")


def _sorted(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_cells_equal_joins(spark, block_bytes):
    pairs, users, items = _tables(spark)
    want = _joined(pairs, users, items)
    assert _sorted(P.with_vectors(pairs, users, items, block_bytes=block_bytes)) == _sorted(want)
    got = P.with_measures(pairs, users, items, ["dot", "uu", "vv", "dd"], block_bytes=block_bytes)
    made = [P.MEASURES[m]("_u", "_v").alias(m) for m in ("dot", "uu", "vv", "dd")]
    want = want.select(*pairs.columns, *made, F.col("_u").isNotNull().alias("_has_u"), F.col("_v").isNotNull().alias("_has_v"))
    assert _sorted(got) == _sorted(want)  # to the last bit


def test_cells_of_odd_tables(spark):
    pairs, users, items = _tables(spark)
    ragged = users.unionByName(spark.createDataFrame([("U41", [1.0]), ("U42", None), ("U43", [1.0, None, 2.0])], users.schema))
    for u, i in ((ragged, items), (users.limit(0), items), (users, items.limit(0)), (users.limit(0), items.limit(0))):
        want = _joined(pairs, u, i)
        want = want.select("n", dot("_u", "_v").alias("dot"), squared_norm("_u").alias("uu"), F.col("_u").isNotNull().alias("_has_u"), F.col("_v").isNotNull().alias("_has_v"))
        assert _sorted(P.with_measures(pairs, u, i, ["dot", "uu"]).select("n", "dot", "uu", "_has_u", "_has_v")) == _sorted(want)


def test_grid_moves_few_vectors():
    for users, items, block, tasks in ((500, 700, 1000, 24), (10**10, 10**6, 10**8, 24), (0, 0, 10, 8), (10**9, 10**9, 10**8, 400)):
        a, b = P.grid(users, items, block, tasks)
        assert a * b >= tasks and users <= a * block and items <= b * block
        least = min(users * y + items * x for x in range(1, 2 * a + 1) for y in range(1, 2 * b + 1) if x * y >= tasks and users <= x * block and items <= y * block)
        assert users * b + items * a <= 1.5 * least


def test_rerank_moves_no_vector_with_a_product(spark):
    """An exchange or sort has a list of numbers only where the blocks of both sides are dealt."""
    _, users, items = _tables(spark)
    asked = spark.createDataFrame([(r, f"U{r}", [f"I{j}" for j in range(r, r + 4)]) for r in range(20)], "request_id long, userid string, products array<string>")
    metrics = ["dot_product", "cosine", "euclidean_distance", lambda u, v: F.try_divide(dot(u, v), norm(v))]
    forms = [RR.rerank(asked, users, items, m) for m in metrics] + [RR.rerank(asked, users, items, "cosine", cosine_norm="frobenius")]
    for df in forms:
        plan = df._jdf.queryExecution().optimizedPlan()
        for side in re.findall(r"Window [^\n]*", plan.toString()):
            assert "_u#" not in side and "_v#" not in side
        joins = [x for x in plan.toString().split("\n") if re.match(r"[\s:+-]*Join", x)]
        assert not joins, joins  # the products used to be joined to the vectors
    u, v = F.col("_u"), F.col("_v")
    for df, s in zip(forms, (dot(u, v), cosine(u, v), euclidean(u, v), F.try_divide(dot(u, v), norm(v)))):
        want = _joined(asked.select("request_id", "userid", F.explode("products").alias("itemid")), users, items).select("request_id", "itemid", s.alias("score"))
        assert _sorted(df.select("request_id", "itemid", "score")) == _sorted(want)


def test_matrix_and_replay_leave_the_names_out(spark):
    """The replay reads the shown results of its days only, and no item name."""
    from conftest import SF_SMALL
    from ranklift.plans.context import Inputs

    i = Inputs(spark, SF_SMALL)
    for df in (i.train_matrix, i.impressions, i.cart_adds):
        assert "p_name" not in df._jdf.queryExecution().optimizedPlan().toString()
    plan = i.impressions._jdf.queryExecution().optimizedPlan().toString()
    below = re.findall(r"Filter [^\n]*", plan[plan.index("Window ") :])
    assert sum(">=" in x and "o_orderdate" in x for x in below) == 2  # lines and distractors


def test_folds_move_only_the_users_they_begin_in(spark):
    from ranklift.operators import factors as FA

    rows = [(None if u == 0 else f"u{u}", None if (u + i) % 9 == 0 else f"i{i}", float(u)) for u in range(7) for i in range(1 + u * 3)]
    rows = sorted(set(rows), key=repr)
    df = spark.createDataFrame(rows, "userid string, itemid string, rating double").repartition(5)
    order = sorted(df.collect(), key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or ""))
    for folds in (1, 2, 3, 7):
        q, rest = divmod(len(order), folds)
        want = [f + 1 for f in range(folds) for _ in range(q + (f < rest))]
        got = FA.kfold_assign(df, folds)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()  # the ids used to be joined
        by = {(r.userid, r.itemid): r.fold for r in got.collect()}
        assert [by[r[0], r[1]] for r in order] == want
    same = spark.createDataFrame([("u", "i", 1.0)] * 4, df.schema)
    assert sorted(r.fold for r in FA.kfold_assign(same, 2).collect()) == [1, 1, 2, 2]


def test_requests_are_not_sorted_by_order(spark):
    """A task used to sort the shown rows of its orders in a window before it collected them."""
    from conftest import SF_SMALL
    from ranklift.sources import fixtures

    plan = fixtures.rerank_requests(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_requests_are_stored_before_their_vectors_move(spark):
    """The rerank reads the requests from one table; their rows are those of the source."""
    i = Inputs(spark, SF_SMALL)
    for got, want in ((i.rerank_requests, fixtures.rerank_requests(spark, SF_SMALL, i.user_factors, i.item_factors)), (i.whole_requests, fixtures.rerank_requests(spark, SF_SMALL))):
        assert got.schema == want.schema or got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_uneven_slices_of_a_block_are_put_together(spark):
    """A block's vectors come in several batches; both ways of meeting give the rows of a plain join."""
    rng = np.random.default_rng(4)
    vectors = lambda p, n: spark.createDataFrame([(f"{p}{j}", [float(x) for x in rng.integers(-9, 9, 5)]) for j in range(n)], "id string, features array<double>").repartition(7)
    users, items = vectors("u", 300), vectors("i", 200)
    pairs = spark.createDataFrame([(f"u{rng.integers(320)}", f"i{rng.integers(210)}") for _ in range(3000)] + [(None, "i1")], "userid string, itemid string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = sorted(map(str, P.with_vectors(pairs, users, items, block_bytes=4000).select("userid", "itemid", "_u", "_v").collect()))
        measured = P.with_measures(pairs, users, items, ["dot"], block_bytes=4000).select("userid", "itemid", F.round("dot", 9), "_has_u", "_has_v").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    u, v = ({r["id"]: r["features"] for r in x.collect()} for x in (users, items))
    rows = [(r["userid"], r["itemid"]) for r in pairs.collect()]
    assert got == sorted(str(Row(userid=a, itemid=b, _u=u.get(a), _v=v.get(b))) for a, b in rows)
    dots = lambda a, b: round(float(np.dot(u[a], v[b])), 7) if a in u and b in v else None
    assert sorted((str(r[0]), r[1], str(r[2] if r[2] is None else round(r[2], 7)), r[3], r[4]) for r in measured) == sorted((str(a), b, str(dots(a, b)), a in u, b in v) for a, b in rows)
