"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A row descends the tree: at every node each child draws ``-ln(u) / weight`` with ``u`` hashed
from the row's key and the child's name, and the smallest draw wins (a child of twice the weight
gets twice the rows). A draw depends on its own child only, so a changed weight moves rows into
or out of that child and nowhere else; below an unchanged node nothing moves at all. A node's
weight is the sum of its leaves'. A new shard opens a region of its own (``layout``), so
growing by one shard takes rows only into it.

Every row is placed by column expressions alone. ``slot`` numbers the rows of a shard without
gaps: rows are numbered in (shard, bucket) windows, whose sizes are counted first and turned
into offsets, with buckets enough that a window holds about ``bucket_rows``. A key that repeats
goes to one shard by the law, and into one bucket per text.

Cases: null text counts 16 bytes; a null key is a key of its own; repeated rows get slots of
their own; an empty table gives no rows; other columns are ignored; an empty tree is an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def layout(n: int, base: int = 40, per_rack: int = 2, racks: int = 5) -> list[Leaf]:
    """``base`` shards in regions of ``racks`` racks; every later shard is a region."""
    size = per_rack * racks
    first = [Leaf(f"r{i // size}", f"k{i % size // per_rack}", i) for i in range(min(n, base))]
    return first + [Leaf(f"s{i}", "k0", i) for i in range(base, n)]


def _draw(key: Column, child: Column) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), child["name"])), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(2**52)) / child["weight"]


def _choose(key: Column, children: Column) -> Column:
    """Index of the child with the smallest draw, the first on a tie."""
    return F.array_min(F.transform(children, lambda c, i: F.struct(_draw(key, c).alias("draw"), i.alias("i")))).i


def _children(names: list[tuple[str, float]]) -> Column:
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in names))


def place(key: Column, leaves: list[Leaf]) -> tuple[Column, Column, Column]:
    """The descent: index of the region; rack in it (by ``__region``); shard (by both)."""
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves:
        raise ValueError("a tree needs a shard of positive weight")
    tree: dict[str, dict[str, list[Leaf]]] = {}
    for x in leaves:
        tree.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    total = lambda xs: math.fsum(x.weight for x in xs)
    regions = _children([(r, math.fsum(total(xs) for xs in racks.values())) for r, racks in tree.items()])
    racks = F.array(*(_children([(f"{r}/{k}", total(xs)) for k, xs in ks.items()]) for r, ks in tree.items()))
    shards = F.array(*(F.array(*(_children([(f"{r}/{k}/{x.shard}", x.weight) for x in xs]) for k, xs in ks.items())) for r, ks in tree.items()))
    numbers = F.array(*(F.array(*(F.array(*(F.lit(x.shard) for x in xs)) for xs in ks.values())) for ks in tree.values()))
    rack = _choose(key, F.get(racks, F.col("__region")))
    here = lambda xs: F.get(F.get(xs, F.col("__region")), F.col("__rack"))
    return _choose(key, regions), rack, F.get(here(numbers), _choose(key, here(shards)))


def descend(df: DataFrame, key: Column, leaves: list[Leaf], name: str) -> DataFrame:
    """``df`` with the column ``name``: the leaf's shard number."""
    region, rack, shard = place(F.col("__key"), leaves)
    out = df.withColumn("__key", F.coalesce(key.cast("string"), F.lit("null")))
    return out.withColumn("__region", region).withColumn("__rack", rack).withColumn(name, shard).drop("__key", "__region", "__rack")


def slots(df: DataFrame, order: list[str], bucket_rows: int = 100_000) -> DataFrame:
    """``df`` with ``slot``: 0, 1, ... within each ``shard``."""
    biggest = df.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    buckets = max(8, -(-biggest // bucket_rows))
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    by_shard = Window.partitionBy("shard").orderBy("__bucket")  # one row per bucket
    offsets = sizes.select("shard", "__bucket", (F.sum("__n").over(by_shard) - F.col("__n")).alias("__before"))
    number = F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy(*order)) - 1
    return rows.withColumn("slot", number).join(offsets, ["shard", "__bucket"]).withColumn("slot", (F.col("slot") + F.col("__before")).cast("long")).drop("__bucket", "__before")


def shard_documents(docs: DataFrame, n: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = descend(rows, F.col("doc_id"), layout(n), "shard")
    rows = descend(rows, F.col("doc_id"), layout(n + 1), "grown_shard")
    out = slots(rows, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
