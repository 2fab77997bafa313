"""The manifest against a plain tree, at several superblock sizes, and its SQL."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ranklift.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Levels up to one node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for r in rows:
        leaf = h(*map(field, r))
        told = leaf
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            told = h(*map(field, (*r[:4], r[4].translate(low))))
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, told, r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:4])
        trees[g] = climb([x[2] for x in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (_, _, leaf, told, doc_id) in enumerate(groups[g]):
            steps = [*path(trees[g], i), *path(top, k)]
            node = told
            for left, right in steps:
                node = h(*left, node, *right)
            out[doc_id, leaf, trees[g][-1][0], top[-1][0], h(*(x for a, b in steps for x in (*a, *b))), node, node == top[-1][0]] += 1
    return out


def manifest(spark, rows, levels):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = merkle.manifest(df, merkle.lowered_third(F.col("doc_id"), F.col("text")), levels)
    return Counter(tuple(r[:7]) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_against_plain_tree(spark, levels):
    rows = [(i, f"s{i % 3}", lang, i, f"Text {i} of É") for n, lang in ((1, "a"), (8, "b"), (9, "Ä"), (64, "d"), (65, "e"), (150, None), (2, "")) for i in range(n)]
    rows += [(None, None, None, None, None), (3, None, "a", None, "x" * 300_000 + "Y"), (3, "s", "a", 2, ""), (7, "s", "b", 1, "Same"), (7, "s", "b", 1, "Same"), (7, "s", "b", 1, "Same")]
    assert manifest(spark, rows, levels) == brute(rows)


def test_many_groups_and_single_row(spark):
    rows = [(i, "s", f"l{i % 70}", 1, f"T{i}") for i in range(100)]
    assert manifest(spark, rows, 1) == brute(rows)
    assert manifest(spark, rows[:1], 4) == brute(rows[:1])
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_untampered_rows_all_verify(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = merkle.manifest(docs, levels=2)
    assert out.count() == docs.count() and out.where("not verified").count() == 0 and out.select("root").distinct().count() == 1
