"""Whitening against numpy on expanded rows."""

import math

import numpy as np
import pytest
from conftest import SF_SMALL

from ranklift.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, d string, x string"


def brute(rows, components=8):
    """vec_id -> (n, deviation, explained, |whitened|), for vectors of one length."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(kept)
    sums = [sum(x) for x in zip(*(x for _, x in kept), strict=True)]
    c = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in kept])
    values, units = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)[:components]
    z = c @ units[:, order] / np.sqrt(values[order])
    return [(i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), values[order] / values.sum(), row) for (i, x), row in zip(kept, z, strict=True)]


def check(got, want, components=8):
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation, r.n), {}).setdefault(r.component, []).append(r)
    want_by = {}
    for i, n, dev, explained, z in want:
        want_by.setdefault((i, dev, n), []).append((explained, z))
    assert set(by) == set(want_by)
    signs = None
    for key, parts in by.items():
        assert sorted(parts) == list(range(1, components + 1))
        same = want_by[key]
        assert all(len(rs) == len(same) for rs in parts.values())
        z = np.array([parts[c][0].whitened for c in sorted(parts)])
        own = np.sign(z * same[0][1])
        signs = own if signs is None else signs
        np.testing.assert_allclose(z, same[0][1] * signs, atol=1e-6)
        np.testing.assert_allclose([parts[c][0].explained for c in sorted(parts)], same[0][0], rtol=1e-9)
        assert all(r.identity_error < 1e-9 for rs in parts.values() for r in rs)


def test_against_numpy_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, [3, 2.5, 2, 1.6, 1.3, 1, 0.8, 0.6, 0.4, 0.2], (60, 10)).tolist()
    vectors = base + [base[0]] * 50 + [base[1]] * 5
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, base[2]), (7, base[3]), (7, base[3])]
    bad = [(900, None), (901, [None, *base[0][1:]]), (902, [float("nan"), *base[0][1:]]), (903, [float("-inf"), *base[0][1:]])]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows + bad], SCHEMA).repartition(5)
    for hot in (1000, 4, 1):  # every key broadcast, some, none
        check(whitening.whitened(df, hot=hot).collect(), brute(rows + bad))


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    check(whitening.whitened(df).collect(), brute([(r.vec_id, r.embedding) for r in df.collect()]))


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(none).count() == 0
    equal = spark.createDataFrame([(i, [1.0, 2.0], "", "") for i in range(4)] + [(9, [], "", "")], SCHEMA)
    assert whitening.whitened(equal).count() == 0  # no direction in which they differ
    flat = spark.createDataFrame([(0, [1.0, 5.0, 0.0], "", ""), (1, [2.0, 5.0, 0.0], "", ""), (2, [0.5], "", ""), (3, [1.5], "", "")], SCHEMA)
    got = {(r.vec_id, r.component): (r.d, r.n, abs(r.whitened), r.explained) for r in whitening.whitened(flat).collect()}
    assert {k: v[:2] for k, v in got.items()} == {(0, 1): (3, 2), (1, 1): (3, 2), (2, 1): (1, 2), (3, 1): (1, 2)}
    assert all(abs(v[2] - 1) < 1e-12 and abs(v[3] - 1) < 1e-12 for v in got.values())


def test_weights_one_and_wide_numbers(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0], "", "")] * 9 + [(1, [1.0, 0.0], "", ""), (2, [3.0, 3.0], "", "")], SCHEMA)
    assert {r.n for r in whitening.whitened(df, weights="one").collect()} == {3}
    with pytest.raises(ValueError):
        whitening.whitened(df, weights="two")
    wide = spark.createDataFrame([(0, [1e30, 0.0], "", ""), (1, [0.0, 0.0], "", ""), (2, [1.0, 1.0], "", "")], SCHEMA)
    assert {r.deviation for r in whitening.whitened(wide).collect()} == {None}
    x = [3_000_000_000_001, 5, 2]
    gap = whitening.centred(np.array([[x[0]], [x[1]], [x[2]]]), 3_000_001, (sum(x),))
    assert gap[:, 0].tolist() == [3_000_001 * v - sum(x) for v in x]
    assert whitening.deviations(gap) == [None, None, None]
