"""ALS: the fitted user factors solve MLlib's implicit normal equations."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import numpy as np
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ranklift.operators import factors
from ranklift.plans.context import Inputs


def test_user_factors_solve_normal_equations(spark):
    # Small on purpose: the check itself runs on the driver with numpy.
    m = Inputs(spark, SF_SMALL).train_matrix
    alpha, lam = 40.0, 0.5
    users, items = factors.fit_als(m, factors.ALSParams(rank=4, regularization=lam, alpha=alpha, iterations=4, seed=11, regularization_scale="mllib"))
    Y = {r["id"]: np.array(r["features"]) for r in items.collect()}
    X = {r["id"]: np.array(r["features"]) for r in users.collect()}
    ratings = {}
    for r in m.collect():
        ratings.setdefault(r["userid"], []).append((r["itemid"], r["rating"]))
    Ymat = np.array(list(Y.values()))
    YtY = Ymat.T @ Ymat
    worst = 0.0
    for u, rows in list(ratings.items())[:50]:
        A = YtY.copy()
        b = np.zeros(4)
        for i, r in rows:
            c = 1.0 + alpha * r
            y = Y[i]
            A += (c - 1.0) * np.outer(y, y)
            b += c * y
        A += lam * len(rows) * np.eye(4)
        x = np.linalg.solve(A, b)
        worst = max(worst, np.max(np.abs(x - X[u])) / max(1e-12, np.max(np.abs(x))))
    assert worst < 1e-4


def test_implicit_loss_matches_bruteforce(spark):
    i = Inputs(spark, SF_SMALL)
    got = factors.implicit_loss(i.train_matrix, i.user_factors, i.item_factors, 40.0, 1.0).collect()[0]
    U = np.array([r["features"] for r in i.user_factors.collect()])
    V = np.array([r["features"] for r in i.item_factors.collect()])
    all_s2 = float(((U @ V.T) ** 2).sum())
    uf = i.user_factors.select(F.col("id").alias("userid"), F.col("features").alias("x"))
    vf = i.item_factors.select(F.col("id").alias("itemid"), F.col("features").alias("y"))
    obs = i.train_matrix.join(uf, "userid").join(vf, "itemid").collect()
    s = np.array([float(np.dot(r["x"], r["y"])) for r in obs])
    c = 40.0 * np.array([r["rating"] for r in obs])
    observed = float((c * (1 - s) ** 2).sum())
    reg = float((U**2).sum() + (V**2).sum())
    assert got["observed_loss"] == __import__("pytest").approx(observed, rel=1e-9)
    assert got["unobserved_loss"] == __import__("pytest").approx(all_s2 - float((s**2).sum()), rel=1e-9)
    assert got["reg_loss"] == __import__("pytest").approx(reg, rel=1e-9)


def test_planted_blocks_beat_random(spark):
    """Two user groups, each rating only its own item group: ALS recovers it."""
    import random

    from ranklift import schemas
    from ranklift.operators import rank_metrics

    rng = random.Random(5)
    train, test = [], []
    for u in range(60):
        group = u % 2
        items = [i for i in range(60) if i % 2 == group]
        rng.shuffle(items)
        for j, i in enumerate(items[:20]):
            row = (f"u{u}", f"i{i}", 1.0 + rng.random())
            (test if j < 5 else train).append(row)
    train_df = spark.createDataFrame(train, schemas.USER_ITEM)
    users, items = factors.fit_als(train_df, factors.ALSParams(rank=4, regularization=0.1, alpha=10.0, iterations=8, seed=2, regularization_scale="mllib"))
    rand_u = spark.createDataFrame([(r["id"], [rng.gauss(0, 1) for _ in range(4)]) for r in users.collect()], schemas.FACTORS)
    rand_i = spark.createDataFrame([(r["id"], [rng.gauss(0, 1) for _ in range(4)]) for r in items.collect()], schemas.FACTORS)

    # Reconstruction of the training pairs (the metric, like the reference's,
    # does not exclude already-rated items, so held-out pairs say little here).
    def score(u, i):
        known = rank_metrics.known_pairs(train_df, u, i)
        return rank_metrics.Scored(known, u, i, 5, "dot_product").summary().collect()[0]

    fitted, rand = score(users, items), score(rand_u, rand_i)
    assert fitted["mar_at_k"] > rand["mar_at_k"] + 0.1
    assert fitted["ndcg_at_k"] > rand["ndcg_at_k"]


def test_blocks_of_a_fit_do_not_follow_its_ratings():
    # every block that rates an entity gets its vector in every iteration
    assert [factors.blocks_for(n) for n in (0, 150_000, 26_000_000, 150_000_000)] == [1, 2, 5, 5]
    assert factors.blocks_for(26_000_000, at_once=8) == 1 and factors.blocks_for(10**9) == 32  # memory of a block


def test_long_fits_drop_the_vectors_of_earlier_iterations(spark, monkeypatch):
    asked = []
    fit = factors.ALS.fit
    monkeypatch.setattr(factors.ALS, "fit", lambda self, *a: asked.append(self.getCheckpointInterval()) or fit(self, *a))
    monkeypatch.setattr(factors, "CHECKPOINT_FROM", 2)
    m = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 1.0)], "userid string, itemid string, rating double")
    users, items = factors.fit_als(m, factors.ALSParams(rank=2, iterations=4))
    assert asked == [2] and users.count() == 2 and items.count() == 2


def test_fits_at_once_share_the_collections():
    """Eight fits at once halt the driver no more often than one, and it is collected when the last ends."""
    calls = []
    system = SimpleNamespace(gc=lambda: calls.append(time.monotonic()))
    spark = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=SimpleNamespace(System=system)))

    def fit(_):
        with factors._releasing(spark, seconds=0.1):
            time.sleep(1.0)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(fit, range(8)))
    assert 1 <= len(calls) <= 15
    n = len(calls)
    time.sleep(0.3)
    assert len(calls) == n
    fit(0)  # and again
    assert len(calls) > n
