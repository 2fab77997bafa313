"""Vectors of (user, item) pairs, brought together without moving a vector per pair.

Pairs outnumber the vectors by far, so a join that carries the vectors writes each of them once per
pair. Here users and items are hashed into blocks, a pair goes to the cell (user block, item block)
without any vector, and a cell gets the vectors of its two blocks: what is moved are the pairs, the users
times the item blocks and the items times the user blocks. Within a cell the pairs stream past the
vectors; sums over the entries (``measures``) are taken there, in the order of the entries, so they
equal ``functions.vectors`` to the last bit. ``with_vectors`` hands both vectors to any expression instead.

The blocks are as few as keep a block's vectors under ``block_bytes`` and give every core work; beyond that, twice the
``block_bytes`` move half the vectors. Vectors
whose entries are all floats are moved as such (checked; MLlib's factors are).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import dot, squared_distance, squared_norm

BLOCK_BYTES = 256 << 20
BATCH_BYTES = 4 << 20


MEASURES = {
    "dot": lambda u, v: dot(u, v),
    "uu": lambda u, v: squared_norm(u),
    "vv": lambda u, v: squared_norm(v),
    "dd": lambda u, v: squared_distance(u, v),
}


def _measured(factors: DataFrame) -> dict:
    """Vectors, least and greatest length, whether floats hold all entries exactly, whether an entry is null."""
    single = F.forall("features", lambda x: x.isNull() | x.eqNullSafe(x.cast("float").cast("double")))
    size = F.size("features")
    row = factors.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.min(size), F.lit(0)).alias("least"),
        F.coalesce(F.max(size), F.lit(0)).alias("rank"),
        F.coalesce(F.bool_and(single), F.lit(True)).alias("single"),
        F.coalesce(F.bool_or(F.col("features").isNull() | F.exists("features", lambda x: x.isNull())), F.lit(False)).alias("nulls"),
    )
    return row.first().asDict()


def grid(user_bytes: int, item_bytes: int, block_bytes: int, tasks: int, users_held: bool = True) -> tuple[int, int]:
    """User blocks and item blocks: the fewest moved vectors with blocks under ``block_bytes`` and a
    cell for each of ``tasks``. ``users_held``: False if users only stream past a block of items."""
    a, b = (max(1, math.ceil(x / block_bytes)) for x in (user_bytes if users_held else 0, item_bytes))
    while a * b < tasks:  # the block whose split repeats fewer bytes
        if item_bytes <= user_bytes * b / a:
            a += 1
        else:
            b += 1
    return a, b


def _meet(payload: list[str], user: str, item: str, batch_rows: int, measures: tuple[str, ...] = (), even: bool = False):
    """The per-task kernel: a cell's vectors come first (kind 0: users, 1: items), then its pairs.
    Gives both vectors, or the ``measures`` and whether each side has a vector. ``even``: all vectors are equally
    long, without nulls; they are then held as one matrix a side, filled batch by batch, never twice."""

    added = [*measures, "_has_u", "_has_v"] if measures else ["_u", "_v"]

    def meet(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        cell, ids, vectors, held = None, None, None, None

        def table(kind):
            """(ids, vectors) of a side, built once the pairs begin."""
            if held[kind] is None:
                names = pa.chunked_array(ids[kind], pa.string()).combine_chunks()
                if even:
                    rank = len(vectors[kind][0][0]) if vectors[kind] else 0
                    found, at = np.empty((len(names), rank), vector_type.value_type.to_pandas_dtype()), 0
                    while vectors[kind]:
                        x = vectors[kind].pop(0)  # let go once it is copied
                        found[at : at + len(x)] = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), rank)
                        at += len(x)
                else:
                    found = pa.chunked_array(vectors[kind], vector_type).combine_chunks()
                held[kind] = (names, found)
                ids[kind], vectors[kind] = [], []
            return held[kind]

        def places(kind, keys):
            # a null id stands for no vector, whatever the tables hold
            return pc.if_else(pc.is_valid(keys), pc.index_in(keys, value_set=table(kind)[0]), pa.scalar(None, pa.int32()))

        def entries(kind, at):
            found = table(kind)[1]  # none: only null places
            return found[at].astype(np.float64, copy=False) if len(found) else np.zeros((len(at), 0))

        def total(terms, n):
            out = np.zeros(n)
            for x in terms:
                out += x
            return out

        def lists(kind, at):
            """The vectors at the places, null for null places."""
            found = table(kind)[1]
            if not even or not len(found):
                return pa.nulls(len(at), pa.list_(pa.float64())) if even else found.take(at).cast(pa.list_(pa.float64()))
            none, rank = ~pc.is_valid(at).to_numpy(zero_copy_only=False), found.shape[1]
            ends = np.concatenate([[0], np.cumsum(np.where(none, 0, rank))]).astype(np.int32)
            rows = found[at.drop_null().to_numpy()].astype(np.float64, copy=False)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()), mask=pa.array(none))

        def columns(at_u, at_v):
            if not measures:
                return [lists(k, at) for k, at in ((0, at_u), (1, at_v))]
            have = [pc.is_valid(x) for x in (at_u, at_v)]
            none = ~pc.and_(*have).to_numpy(zero_copy_only=False)
            x, y = (entries(k, at.fill_null(0).to_numpy()) for k, at in ((0, at_u), (1, at_v)))
            n, ranks = len(x), range(min(x.shape[1], y.shape[1]))
            terms = {
                "dot": lambda: (x[:, j] * y[:, j] for j in ranks),
                "uu": lambda: (x[:, j] * x[:, j] for j in range(x.shape[1])),
                "vv": lambda: (y[:, j] * y[:, j] for j in range(y.shape[1])),
                "dd": lambda: ((d := x[:, j] - y[:, j]) * d for j in ranks),
            }
            absent = {"uu": ~have[0].to_numpy(zero_copy_only=False), "vv": ~have[1].to_numpy(zero_copy_only=False)}
            with np.errstate(all="ignore"):
                return [*(pa.array(total(terms[m](), n), mask=absent.get(m, none)) for m in measures), *have]

        for batch in batches:
            if not batch.num_rows:
                continue
            vector_type = batch.schema.field("_vec").type
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_kind")])
            edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                if cell != marks[0, lo]:
                    cell, ids, vectors, held = marks[0, lo], [[], []], [[], []], [None, None]
                kind, part = int(marks[1, lo]), batch.slice(lo, hi - lo)
                if kind < 2:
                    ids[kind].append(part.column(user))
                    vectors[kind].append(part.column("_vec"))
                    continue
                for at in range(0, part.num_rows, batch_rows):
                    rows = part.slice(at, batch_rows)
                    made = columns(places(0, rows.column(user)), places(1, rows.column(item)))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in payload), *made], names=[*payload, *added])

    return meet


def with_measures(pairs: DataFrame, users: DataFrame, items: DataFrame, measures: list[str], user: str = "userid", item: str = "itemid", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``pairs`` with the ``measures`` of their vectors u and v: ``dot``, the squared lengths ``uu``
    and ``vv``, the squared distance ``dd``; null where a vector that they need is missing. ``_has_u`` and ``_has_v``
    say whether there are vectors."""
    sizes = _measured(users), _measured(items)
    if _even(sizes):
        return _meeting(pairs, users, items, sizes, tuple(measures), user, item, block_bytes)
    rows = _meeting(pairs, users, items, sizes, (), user, item, block_bytes)
    made = [MEASURES[m]("_u", "_v").alias(m) for m in measures]
    return rows.select(*pairs.columns, *made, F.col("_u").isNotNull().alias("_has_u"), F.col("_v").isNotNull().alias("_has_v"))


def with_vectors(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str = "userid", item: str = "itemid", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``pairs`` with ``_u`` and ``_v``, the vectors of their ``user`` and ``item`` (null: none).

    ``users``, ``items``: ``(id, features)``, a row per id. Reduce ``_u`` and ``_v`` to scores before the
    next exchange.
    """
    return _meeting(pairs, users, items, (_measured(users), _measured(items)), (), user, item, block_bytes)


def _even(sizes) -> bool:
    """Whether all vectors are equally long, without nulls."""
    lengths = {x[c] for x in sizes if x["n"] for c in ("least", "rank")}
    return len(lengths) <= 1 and 0 not in lengths and not any(x["nulls"] for x in sizes)


def _meeting(pairs, users, items, sizes, measures, user, item, block_bytes) -> DataFrame:
    of_u, of_i = sizes
    single = of_u["single"] and of_i["single"]
    width = 4 if single else 8
    tasks = 2 * pairs.sparkSession.sparkContext.defaultParallelism
    a, b = grid(of_u["n"] * of_u["rank"] * width, of_i["n"] * of_i["rank"] * width, block_bytes, tasks)
    vec = f"array<{'float' if single else 'double'}>"
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def side(factors, kind, own, other):
        copies = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("_copy")
        of_user, of_item = (F.col("_copy"), block("id", own)) if kind else (block("id", own), F.col("_copy"))
        cell = of_user * F.lit(b) + of_item
        # No null texts or lists: Spark's Arrow writer goes back over all nulls before each row it sizes.
        blank = {f.name: F.lit("") if isinstance(f.dataType, T.StringType) else F.lit(None).cast(f.dataType) for f in pairs.schema} | {user: F.col("id")}
        vectors = factors.select("id", F.col("features").cast(vec).alias("_vec"), copies)
        return vectors.select(cell.alias("_cell"), F.lit(kind).alias("_kind"), "_vec", *(x.alias(c) for c, x in blank.items()))

    payload = pairs.columns
    at = (block(user, a) * F.lit(b) + block(item, b)).alias("_cell")
    rows = pairs.select(at, F.lit(2).alias("_kind"), F.array().cast(vec).alias("_vec"), *payload)
    all_rows = rows.unionByName(side(users, 0, a, b)).unionByName(side(items, 1, b, a)).repartitionById(a * b, F.col("_cell")).sortWithinPartitions("_cell", "_kind")
    if measures:
        added = [*(T.StructField(m, T.DoubleType()) for m in measures), *(T.StructField(c, T.BooleanType()) for c in ("_has_u", "_has_v"))]
    else:
        added = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_u", "_v")]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in pairs.schema), *added])
    batch_rows = max(1, BATCH_BYTES // (8 * max(1, of_u["rank"] + of_i["rank"])))
    return all_rows.mapInArrow(_meet(payload, user, item, batch_rows, measures, _even(sizes)), schema)
