"""Score every candidate item for every user, keep only what top-k needs.

The rank metrics are defined over *all* candidate items of each user;
materialising the scores as rows would be quadratic. Users are packed into
blocks (hash of the id), items into blocks by the length of their vectors, and
a user block meets an item block in one numpy matmul inside ``mapInArrow``. Only
two small things leave a task per user:

* the top-k items under the total order (key desc, itemid asc);
* the top score levels ``(key, count, gain sum)`` covering the first k
  positions (needed for tie-averaged NDCG).

Both merge exactly: a level or item in the global top-k is in the local top-k of
every set of items that holds it. A score is bounded by the lengths alone
(|u||v| for the dot product, ||u| - |v|| for the distance), so a user whose k-th
key beats all that a block could give skips the block; the rows are those of the full scan.

First, every user block runs over the ``first_bytes`` of items that promise most (the longest
vectors, or those nearest to the users' mean length): a proven bound, so they are shipped once per
worker. The other items, if there are any, stay distributed in ranges of lengths, ``group_bytes`` of them or
less to a group; each user's k-th key picks the groups that could still matter. A task holds one group of items
and one part of the users streams past it: what is moved are the users times the groups and the items times the
parts (``pairs.grid``), never a user for each block.

A product of floats, half the work of doubles, only selects what may be kept, with room for its error
(doubles where floats could overflow); kept scores are computed directly from the doubles. Scores closer than
``digits`` decimals count as ties (``None``: only equal ones). Rows without a user count
(user, item block) pairs: ``cnt`` scored of ``gain`` in all.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import check_metric
from ..functions.vectors import norm
from .pairs import grid

KEY_DIGITS = 9
FIRST_BYTES = 64 << 20
GROUP_BYTES = 256 << 20

OUT_SCHEMA = T.StructType(
    [
        T.StructField("userid", T.StringType()),  # NULL on counts of scored pairs
        T.StructField("itemid", T.StringType()),  # NULL on level rows
        T.StructField("key", T.DoubleType()),  # rounded score, larger is better
        T.StructField("score", T.DoubleType()),  # raw dot / distance (item rows)
        T.StructField("gain", T.DoubleType()),  # relevance (item) or relevance sum (level)
        T.StructField("cnt", T.LongType()),  # 1 (item) or items in the level
    ]
)


def _reach(dot: bool, digits: int | None):
    """``reach(norms of users, shortest, longest)``: the greatest key that an item with a length
    in that range can have for each user, with room for rounding."""
    unit = 10.0**-digits if digits is not None else 0.0

    def reach(lengths, lo, hi):
        import numpy as np

        if dot:
            return lengths * hi * (1 + 1e-12) + unit
        return unit + 1e-12 * (1 + lengths + hi) - np.maximum(0.0, np.maximum(lo - lengths, lengths - hi))

    return reach


def _floats():
    """``single(x)``: ``x`` as floats; None where they could overflow (or are none). Ships by value."""

    def single(x):
        import numpy as np

        return x.astype(np.float32) if np.abs(x).max(initial=0.0) < 1e15 else None

    return single


def _cataloguer(dot: bool):
    """The function that prepares item blocks ``[(ids, matrix), ...]``, on the driver or in a task. Ships by value."""
    single = _floats()

    def catalogue(blocks):
        """All ids in order, the number of each; (numbers, vectors, the same to select by, shortest, longest) per block."""
        import numpy as np

        ids = np.concatenate([b for b, _ in blocks])
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        ids, parts, done = ids[order], [], 0
        for b, v in blocks:
            at = place[done : done + len(b)]
            done += len(b)
            o = np.argsort(at)
            at, v = at[o], v[o]
            squares = (v * v).sum(1)
            lengths = np.sqrt(squares)
            # u.v - |v||v|/2 falls as the distance grows
            by = v if dot else np.c_[v, -0.5 * squares]
            few = single(by)
            if few is not None and np.array_equal(few[:, : v.shape[1]], v):
                v = few[:, : v.shape[1]]  # held once
            parts.append((at, v, by if few is None else few, lengths.min(initial=np.inf), lengths.max(initial=0.0)))
        return ids, {x: j for j, x in enumerate(ids)}, parts

    return catalogue


def _block_scorer(k: int, metric: str, digits: int | None, shared=None):
    """The per-task kernel. Self-contained (imports inside) so it ships by value.

    ``shared``: a broadcast of the catalogue of item blocks, most promising first; otherwise the rows of
    a cell are its item blocks (``_kind`` 0), most promising first, then its user blocks with each
    user's k-th key so far (``u_keys``).
    """
    dot = metric == "dot_product"
    reach, single, catalogue = _reach(dot, digits), _floats(), _cataloguer(dot)
    unit = 10.0**-digits if digits is not None else 0.0

    def score_batches(batches):
        import numpy as np
        import pyarrow as pa

        types = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
        out_schema = pa.schema(list(zip(("userid", "itemid", "key", "score", "gain", "cnt"), types)))

        def matrix(flat, n):
            return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1)

        def strings(list_scalar):
            return np.asarray(list_scalar.values.to_pylist(), dtype=object)

        known_items = shared.value if shared is not None else None

        def first_of(rows, n):
            return np.searchsorted(rows, np.arange(n))

        def best_items(n, rows, item, key, raw, gain):
            o = np.lexsort((item, -key, rows))
            rows = rows[o]
            sel = np.arange(len(rows)) - first_of(rows, n)[rows] < k
            return rows[sel], *(x[o][sel] for x in (item, key, raw, gain))

        def best_levels(n, rows, key, gain, cnt):
            """Equal keys of a user added up; the levels that start within the first k places."""
            o = np.lexsort((-key, rows))
            rows, key = rows[o], key[o]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (key[1:] != key[:-1])
            st = np.flatnonzero(new)
            rows, key, gain, cnt = rows[st], key[st], np.add.reduceat(gain[o], st), np.add.reduceat(cnt[o], st)
            before = np.cumsum(cnt) - cnt
            sel = before - before[first_of(rows, n)[rows]] < k
            return rows[sel], key[sel], gain[sel], cnt[sel]

        def places(mask):
            return np.divmod(np.flatnonzero(mask), mask.shape[1])

        def candidates(U, by_u, lengths, V, by_v, hi, kth, room_for):
            """(user row, item column, key, raw score) of all that may stand in a user's top k; ``kth``: the
            key it takes at least; ``room_for``: memory of the sums. The product of ``by_u`` and ``by_v`` only
            selects, with room for its error; kept scores are computed directly, from doubles."""
            if by_u is None or by_v.dtype == np.float64:  # in doubles
                by_u, by_v = (U, V) if dot else (np.c_[U, np.ones(len(U))], np.c_[V, -0.5 * np.square(V, dtype=np.float64).sum(1)])
                by_v, room_for = by_v.astype(np.float64), np.empty(len(U) * len(V))
            near = np.dot(by_u, by_v.T, out=room_for[: len(by_u) * len(by_v)].reshape(len(by_u), len(by_v)))
            bits = 2.0**-23 if near.dtype == np.float32 else 2.0**-52
            error = (U.shape[1] + 8) * (bits * (lengths * hi if dot else (lengths + hi) * hi) + 1e-36 * (1 + lengths + hi))
            known = np.isfinite(kth).all()  # then no order within the block is needed
            if not known:
                top = near.shape[1] - min(k, near.shape[1])
                best = np.partition(near, top, axis=1)[:, top].astype(np.float64) - error
            if dot:
                cut = (kth if known else best) - unit
                error += 1e-12 * np.abs(cut)
            else:
                # of the squared distance: |u||u| - 2 (u.v - |v||v|/2)
                squares = lengths * lengths
                far = np.maximum(0.0, -kth if known else np.sqrt(np.maximum(0.0, squares - 2 * best))) + unit
                cut = 0.5 * (squares - far * far)
                error += 1e-11 * (squares + far * far)
            least = (cut - error).astype(near.dtype)
            rows, cols = places(near >= np.nextafter(least, near.dtype.type(-np.inf))[:, None])
            raw = np.empty(len(rows))
            for a in range(0, len(rows), 1 << 16):
                s = slice(a, a + (1 << 16))
                x, y = U[rows[s]], V[cols[s]]
                raw[s] = (x * y).sum(1) if dot else np.sqrt(((x - y) ** 2).sum(1))
            key = raw if dot else -raw
            return rows, cols, np.round(key, digits) if digits is not None else key, raw

        def gains(known, asked):
            """The gain at each place asked for; ``known``: places in order and their gains."""
            if not len(known[0]):
                return np.zeros(len(asked))
            at = np.minimum(np.searchsorted(known[0], asked), len(known[0]) - 1)
            return np.where(known[0][at] == asked, known[1][at], 0.0)

        def kth_keys(n, items):
            """Each user's k-th key; minus infinity before there are k."""
            out = np.full(n, -np.inf)
            rows, key = items[0], items[2]
            full = np.bincount(rows, minlength=n) == k
            np.minimum.at(low := np.full(n, np.inf), rows, key)
            out[full] = low[full]
            return out

        def score_users(U, rel, parts, n_ids, kth):
            """Running top k and levels of a user block over the item blocks; pairs scored. What is found waits, and
            is merged when it is twice the top k of all users, or when k-th keys are needed."""
            n = len(U)
            lengths = np.sqrt((U * U).sum(1))
            by_u = single(U if dot else np.c_[U, np.ones(n)])
            items = levels = None
            waiting, n_waiting, scored = [], 0, 0
            room_for = np.empty(n * max(len(numbers) for numbers, *_ in parts), np.float32)

            def merge():
                nonlocal items, levels, kth, n_waiting
                rows, item, key, raw = map(np.concatenate, zip(*waiting))
                waiting.clear()
                n_waiting = 0
                worth = key >= kth[rows]
                rows, item, key, raw = rows[worth], item[worth], key[worth], raw[worth]
                if not len(rows):
                    return
                gain = gains(rel, rows * n_ids + item)
                found, runs = (rows, item, key, raw, gain), (rows, key, gain, np.ones(len(rows), np.int64))
                items = best_items(n, *(found if items is None else map(np.concatenate, zip(items, found))))
                levels = best_levels(n, *(runs if levels is None else map(np.concatenate, zip(levels, runs))))
                kth = np.maximum(kth, kth_keys(n, items))

            for numbers, V, by_v, lo, hi in parts:
                active = np.flatnonzero(reach(lengths, lo, hi) >= kth)
                if not len(numbers) or not len(active):
                    continue
                scored += len(active)
                of = slice(None) if len(active) == n else active
                rows, cols, key, raw = candidates(U[of], by_u if by_u is None else by_u[of], lengths[of], V, by_v, hi, kth[of], room_for)
                if len(rows):
                    waiting.append((active[rows], numbers[cols], key, raw))
                    n_waiting += len(rows)
                if n_waiting >= 2 * n * k or (n_waiting and not np.isfinite(kth[of]).all()):
                    merge()
            if waiting:
                merge()
            return items, levels, scored

        cell, blocks = None, []
        for batch in batches:
            out = [[] for _ in types]

            def emit(*columns):
                for x, v in zip(out, columns):
                    x.append(v)

            for r in range(batch.num_rows):
                uids = strings(batch.column("u_ids")[r])
                if shared is None:
                    if cell != (now := batch.column("_cell")[r].as_py()):
                        cell, blocks, known_items = now, [], None
                    if batch.column("_kind")[r].as_py() == 0:
                        blocks.append((uids, matrix(batch.column("u_vecs")[r].values, len(uids))))
                        continue
                    if known_items is None:
                        known_items, blocks = catalogue(blocks) if blocks else ([], {}, []), []
                    kth = batch.column("u_keys")[r].values.to_numpy(zero_copy_only=False)
                else:
                    kth = np.full(len(uids), -np.inf)
                ids, number, parts = known_items
                if len(uids) == 0 or len(ids) == 0:
                    continue
                rel = [np.zeros(0, np.int64), np.zeros(0)]
                if batch.column("r_u")[r].is_valid and len(batch.column("r_u")[r]) > 0:
                    row_of = {u: j for j, u in enumerate(uids)}
                    users = np.array([row_of.get(x, -1) for x in batch.column("r_u")[r].values.to_pylist()], np.int64)
                    item = np.array([number.get(x, -1) for x in batch.column("r_i")[r].values.to_pylist()], np.int64)
                    gain = batch.column("r_v")[r].values.to_numpy(zero_copy_only=False)
                    both = (users >= 0) & (item >= 0)
                    at, run = np.unique(users[both] * len(ids) + item[both], return_inverse=True)
                    rel = [at, np.bincount(run, gain[both], len(at))]
                items, levels, scored = score_users(matrix(batch.column("u_vecs")[r].values, len(uids)), rel, parts, len(ids), kth)
                none = np.full(1, None, dtype=object)
                emit(none, none, np.full(1, np.nan), np.full(1, np.nan), np.array([float(len(uids) * len(parts))]), np.array([scored]))
                if items is None:
                    continue
                (rows, item, key, raw, gain), (l_rows, l_key, l_gain, l_cnt) = items, levels
                n, m = len(rows), len(l_rows)
                emit(uids[rows], ids[item], key, raw, gain, np.ones(n, np.int64))
                emit(uids[l_rows], np.full(m, None, dtype=object), l_key, np.full(m, np.nan), l_gain, l_cnt)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], type=t, from_pandas=True) for x, t in zip(out, types)], schema=out_schema)

    return score_batches


def _packed(rows: DataFrame, by: list[str], id_col: str, prefix: str, extra: dict[str, str] | None = None) -> DataFrame:
    """One row per ``by``: ids and their vectors flattened into one ``array<double>``
    (flat primitive arrays cross the JVM/Python boundary far faster than nested ones)."""
    extra = extra or {}
    member = F.struct(F.col(id_col).alias("id"), F.col("features").alias("v"), *(F.col(c) for c in extra))
    m = F.col("_m")
    return rows.groupBy(*by).agg(F.collect_list(member).alias("_m")).select(
        *by,
        F.transform(m, lambda s: s["id"]).alias(f"{prefix}_ids"),
        F.flatten(F.transform(m, lambda s: s["v"])).alias(f"{prefix}_vecs"),
        *(F.col("_m")[c].alias(name) for c, name in extra.items()),
    )


def _relevance(ratings: DataFrame, by: list[str]) -> DataFrame:
    return ratings.groupBy(*by).agg(F.collect_list(F.struct("userid", "itemid", F.col("rating").cast("double").alias("r"))).alias("_r")).select(
        *by, F.col("_r.userid").alias("r_u"), F.col("_r.itemid").alias("r_i"), F.col("_r.r").alias("r_v")
    )


def score_top_levels(
    users: DataFrame,
    items: DataFrame,
    ratings: DataFrame,
    k: int,
    metric: str,
    user_block: int = 512,
    item_block: int = 2048,
    first_bytes: int = FIRST_BYTES,
    group_bytes: int = GROUP_BYTES,
    n_users: int | None = None,
    n_items: int | None = None,
    digits: int | None = KEY_DIGITS,
    cached: list[DataFrame] | None = None,
) -> DataFrame:
    """Per-user top-k items and top score levels over all candidate items.

    users: ``(userid, features)``; items: ``(itemid, features)``;
    ratings: ``(userid, itemid, rating)`` (relevance; absent pairs have 0).
    Returns rows of ``OUT_SCHEMA``, merged by
    ``rank_metrics.Scored.top_items`` / ``Scored.levels``. ``cached`` gets the frames that
    stay cached behind them.
    """
    import numpy as np

    check_metric(metric)
    k, dot = int(k), metric == "dot_product"
    if n_users is None:
        n_users = users.count()
    first = items.select(F.size("features").alias("rank")).first()
    if n_users == 0 or first is None:
        return users.sparkSession.createDataFrame([], OUT_SCHEMA)
    if n_items is None:
        n_items = items.count()
    nu = max(1, math.ceil(n_users / user_block))
    room = max(1, int(first_bytes // (8 * max(1, int(first["rank"])))))  # items of the first part
    items = items.withColumn("_len", norm("features"))
    if dot:
        promise = -F.col("_len")
    else:
        middle = users.agg(F.avg(norm("features"))).first()[0]
        promise = F.abs(F.col("_len") - F.lit(float(middle)))
    items = items.withColumn("_promise", promise)
    table = items.orderBy("_promise", "itemid").limit(room).select("itemid", "features", "_promise").toArrow()  # first_bytes at most
    ids = np.array(table.column("itemid").to_pylist(), dtype=object)
    vecs = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(ids), -1)
    blocks = [(ids[a : a + item_block], vecs[a : a + item_block]) for a in range(0, len(ids), item_block)]
    shared = users.sparkSession.sparkContext.broadcast(_cataloguer(dot)(blocks))  # prepared once, not by every task
    # A block's users travel with their own relevance rows (at most one per
    # candidate item each, i.e. no more than the scores the task computes).
    by_block = lambda df: df.withColumn("ub", F.pmod(F.xxhash64("userid"), F.lit(nu)))
    near = ratings
    if n_items > len(ids):
        near = ratings.join(F.broadcast(users.sparkSession.createDataFrame([(i,) for i in ids], "itemid string")), "itemid", "left_semi")
    ub = _packed(by_block(users), ["ub"], "userid", "u").join(_relevance(by_block(near), ["ub"]), "ub", "left").repartition(nu, "ub")
    out = ub.mapInArrow(_block_scorer(k, metric, digits, shared), OUT_SCHEMA)
    if n_items <= len(ids):
        return out
    out = out.persist()  # the k-th keys and the merge read it
    last = (table.column("_promise")[-1].as_py(), ids[-1])
    rest = items.where((F.col("_promise") > last[0]) | ((F.col("_promise") == last[0]) & (F.col("itemid") > last[1])))
    cached = [] if cached is None else cached
    cached.append(out)
    return out.unionByName(_score_rest(users, rest, ratings, out, n_users, n_items - len(ids), int(first["rank"]), k, metric, user_block, item_block, digits, group_bytes, cached))


def _score_rest(users, rest, ratings, first, n_users, n_rest, rank, k, metric, user_block, item_block, digits, group_bytes, cached) -> DataFrame:
    """The items beyond the first part, for the users whom they could still matter to."""
    from ..session import ensure_checkpoint_dir

    spark = users.sparkSession
    ensure_checkpoint_dir(spark)
    dot, blocks = metric == "dot_product", max(1, math.ceil(n_rest / item_block))
    # parts of the users, groups of the item blocks
    parts, groups = grid(8 * rank * n_users, 8 * rank * n_rest, group_bytes, 4 * spark.sparkContext.defaultParallelism, users_held=False)
    groups = min(groups, blocks)
    # Ranges of lengths; written once, so that every reader sees the same blocks.
    ranged = rest.repartitionByRange(blocks, "_len", "itemid")
    group = F.floor(F.spark_partition_id() * F.lit(groups) / F.lit(blocks)).cast("int")
    ranged = ranged.select("itemid", "features", "_len", F.spark_partition_id().alias("ib"), group.alias("grp")).checkpoint(eager=True)
    sizes = ranged.groupBy("grp").agg(F.min("_len").alias("lo"), F.max("_len").alias("hi"), F.count_distinct("ib").alias("n")).orderBy("grp").collect()  # a row per group
    numbers, lo, hi = ([r[c] for r in sizes] for c in ("grp", "lo", "hi"))
    reach = _reach(dot, digits)

    def needed(batches):
        """The groups of items that could still matter to each user."""
        import numpy as np
        import pyarrow as pa

        a, b, at = np.array(lo), np.array(hi), np.array(numbers)
        for batch in batches:
            lengths, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_len", "_key"))
            found = [at[reach(x, a, b) >= y] for x, y in zip(lengths, keys)]
            yield pa.RecordBatch.from_arrays([batch.column("userid"), batch.column("_key"), pa.array(found, pa.list_(pa.int32()))], names=["userid", "_key", "groups"])

    have = first.where(F.col("userid").isNotNull() & F.col("itemid").isNotNull()).groupBy("userid").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("m"))
    key = F.when(F.col("n") >= k, F.col("m")).otherwise(F.lit(float("-inf"))).alias("_key")
    asked = users.join(have, "userid", "left").select("userid", norm("features").alias("_len"), key)
    asked = asked.mapInArrow(needed, "userid string, _key double, groups array<int>").where(F.size("groups") > 0).persist()  # a row per user
    cached.append(asked)
    packs = parts * max(1, math.ceil(n_users / (parts * user_block)))
    pack = F.pmod(F.xxhash64("userid"), F.lit(packs)).alias("_at")
    by, to = ["grp", "_at"], F.explode("groups").alias("grp")
    packed = _packed(asked.join(users, "userid").select("userid", "features", "_key", to, pack), by, "userid", "u", {"_key": "u_keys"})
    wanted = ratings.join(asked.select("userid", "groups"), "userid").join(ranged.select("itemid", "grp"), "itemid").where(F.array_contains("groups", F.col("grp")))
    packed = packed.join(_relevance(wanted.select("userid", "itemid", "rating", "grp", pack), by), by, "left")
    streamed = ["u_ids", "u_vecs", "u_keys", "r_u", "r_i", "r_v"]
    cell = (F.col("grp") * F.lit(parts) + F.col("_part")).cast("int").alias("_cell")
    packed = packed.withColumn("_part", F.col("_at") % F.lit(parts)).select(cell, F.lit(1).alias("_kind"), F.col("_at").cast("long"), *streamed)
    # an item block goes to each part of the users; for the dot product the longest come first
    copies = _packed(ranged, ["ib", "grp"], "itemid", "u").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    none = {f.name: F.array().cast(f.dataType) for f in packed.schema if f.name in streamed[2:]}
    promise = (-F.col("ib") if dot else F.col("ib")).cast("long").alias("_at")
    copies = copies.select(cell, F.lit(0).alias("_kind"), promise, "u_ids", "u_vecs", *(x.alias(c) for c, x in none.items()))
    cells = copies.unionByName(packed).repartitionById(parts * groups, F.col("_cell")).sortWithinPartitions("_cell", "_kind", "_at")
    scored = cells.mapInArrow(_block_scorer(k, metric, digits), OUT_SCHEMA)
    # pairs that were never formed count as skipped
    total = float(sum(r["n"] for r in sizes)) * n_users
    skipped = spark.createDataFrame([(None, None, None, None, total, 0)], OUT_SCHEMA)
    formed = scored.withColumn("gain", F.when(F.col("userid").isNull(), F.lit(0.0)).otherwise(F.col("gain")))
    return formed.unionByName(skipped)
