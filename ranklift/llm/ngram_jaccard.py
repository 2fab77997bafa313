"""Near-duplicate classes by an n-gram Jaccard self-join filtered under several token orders.

Two texts link when ``100 * |A & B| >= 75 * |A | B|`` over their sets of word n-grams. A pair
that links shares a token in its prefixes (the ``n - ceil(t n) + 1`` first tokens) under EVERY
global token order, so candidates come from the most selective order (rarest tokens first, by
document frequency over all texts) and must share prefix tokens under further hash orders too
before the full sets are intersected.

The work in four steps, none of which holds more than one bounded chunk or reduce group:

1. ``_chunks``: texts -> chunks of sorted 48-bit token sets (Arrow, numpy), written once.
2. ``_frequencies``: every chunk sends its distinct tokens with their local frequency to the
   reduce group of the token's range and gets back the global frequency class; a token with a
   third of all texts arrives once per chunk. A text whose prefix holds only tokens no other
   text has cannot have a partner and leaves here, which is most of a clean corpus.
3. ``_linked``: candidates from prefix buckets, verified on the full sets. First each member of
   a bucket meets only a few bucket leaders (linear in the bucket), and the links
   found are contracted to components; then every pair of a bucket whose members are still in
   different components, of sizes that fit, is verified (``_apart``). So no link that would join two classes is lost, and a
   group of thousands of near copies never turns into all its pairs.
4. ``components``: star contraction of the links.

Cases: null or word-less text has the empty set and links with nothing; fewer than ``n`` words
are one token; equal sets share one node whatever their number; rows that repeat a doc_id keep
their own rows; a null doc_id keeps its row, and never names a class unless the whole class
has none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.components import components
from ranklift.llm.storage import cut, groups, release
from ranklift.llm.words import in_runs, mix, pack, unpack, word_hashes

BITS = 48
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)  # salts of the second and third token order


def shingle_hashes(words: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every n-word window, its text); texts with 1 to n-1 words give one window."""
    sizes = np.diff(before)
    windows = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    text = np.repeat(np.arange(len(sizes)), windows)
    first = before[:-1][text] + in_runs(windows)
    out = np.full(len(text), n, np.uint64)
    length = np.minimum(sizes, n)[text]
    for i in range(n):
        has = length > i
        word = words[np.minimum(first + i, max(len(words) - 1, 0))] if len(words) else np.zeros(len(text), np.uint64)
        out = np.where(has, mix(out * np.uint64(0x9E3779B97F4A7C15) + word), out)
    return out, text


def text_sets(texts: pa.Array, n: int):
    """Sorted distinct tokens of each text: (tokens, sizes)."""
    words, before = word_hashes(texts)
    tokens, text = shingle_hashes(words, before, n)
    starts = np.searchsorted(text, np.arange(len(texts) + 1))
    found = [np.unique(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    return (np.concatenate(found) if found else tokens), np.array([len(x) for x in found], np.int64)


def _sum_runs(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _deltas(tokens: np.ndarray, sizes: np.ndarray) -> bytes:
    """Sorted runs as compressed differences."""
    d = tokens.copy()
    d[1:] -= tokens[:-1]
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    d[first] = tokens[first]
    return pack(d, BITS // 8)


def _undo(data: bytes, sizes: np.ndarray) -> np.ndarray:
    d = unpack(data, int(sizes.sum()), BITS // 8)
    total = np.cumsum(d)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    base = np.repeat(total[first] - d[first], sizes[sizes > 0])
    return total - base


_CHUNK = pa.schema([("chunk", pa.string()), ("doc_id", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("sid", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _slices(at: np.ndarray, a: int, b: int, size: int):
    """Runs of the texts a to b of at most ``size`` bytes, or one text."""
    while a < b:
        c = min(b, max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1))
        yield a, c
        a = c


def _identified(texts: pa.Array, n: int):
    """(48-bit tokens of the texts' sets, their sizes, an id of each set)."""
    tokens, sizes = text_sets(texts, n)
    with np.errstate(over="ignore"):
        sid = mix(_sum_runs(mix(tokens), sizes) + mix(_sum_runs(mix(tokens ^ np.uint64(ORDERS[0])), sizes)) + sizes.astype(np.uint64)).view(np.int64)
    return tokens >> np.uint64(64 - BITS), sizes, sid


def _chunk_rows(batches, n: int, chunk_bytes: int, slice_bytes: int = 2 << 20):
    """Chunks of about ``chunk_bytes`` of text (one text at least), hashed in slices of
    ``slice_bytes``, so that a task holds the tokens of a chunk but the rest of a slice only."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        text = batch.column("text").cast(pa.large_string())
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        a = 0
        while a < len(text):
            b = max(a + 1, int(np.searchsorted(at, at[a] + chunk_bytes, "right")) - 1)
            found = [_identified(text.slice(c, d - c), n) for c, d in _slices(at, a, b, slice_bytes)]
            short, sizes, sid = (np.concatenate(x) for x in zip(*found))
            del found
            # a set that the chunk already holds keeps its row without the tokens
            _, first = np.unique(sid, return_index=True)
            again = np.ones(len(sid), bool)
            again[first] = False
            keep = ~np.repeat(again, sizes)
            stored = np.where(again, 0, sizes)
            row = [f"{part}-{number}", batch.column("doc_id").slice(a, b - a).to_pylist(), sizes, np.where(sizes > 0, sid, 0), _deltas(short[keep], stored)]
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _CHUNK)], schema=_CHUNK)
            number += 1
            a = b


def _chunks(docs: DataFrame, n: int, chunk_bytes: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(rows.mapInArrow(functools.partial(_chunk_rows, n=n, chunk_bytes=chunk_bytes), "chunk string, doc_id array<bigint>, n array<bigint>, sid array<bigint>, tokens binary"))


def _stored(sizes: np.ndarray, sid: np.ndarray) -> np.ndarray:
    """Tokens that a chunk stores of each of its rows: those of a set's first row."""
    _, first = np.unique(sid, return_index=True)
    out = np.zeros(len(sizes), np.int64)
    out[first] = sizes[first]
    return out


def _requests(batches, parts: int):
    """A chunk's distinct tokens, with the number of its sets that hold each, by token range."""
    for batch in batches:
        for row in batch.to_pylist():
            sizes = _stored(np.array(row["n"], np.int64), np.array(row["sid"], np.int64))
            tokens, count = np.unique(_undo(row["tokens"], sizes), return_counts=True)
            edges = np.searchsorted(tokens, np.array([(r << BITS) // parts for r in range(parts + 1)], np.uint64))
            for r in range(parts):
                a, b = edges[r], edges[r + 1]
                if b > a:
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([row["chunk"]]), pa.array([int(b - a)], pa.int64()), pa.array([_deltas(tokens[a:b], np.array([b - a]))], pa.binary()), pa.array([pack(np.minimum(count[a:b], 255), 1)], pa.binary())], names=["r", "chunk", "size", "tokens", "counts"])


def _replies(pdf: pd.DataFrame) -> pd.DataFrame:
    """Frequency class (1 to 255, capped) of every token that a chunk asked for."""
    tokens = [_undo(t, np.array([s])) for t, s in zip(pdf["tokens"], pdf["size"])]
    counts = [unpack(c, s, 1) for c, s in zip(pdf["counts"], pdf["size"])]
    known, at = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, np.concatenate(counts).astype(np.int64))
    total = np.minimum(total, 255).astype(np.uint64)
    ends = np.cumsum([len(x) for x in tokens])
    out = [pack(total[at[e - len(x) : e]], 1) for x, e in zip(tokens, ends)]
    return pd.DataFrame({"chunk": pdf["chunk"], "r": pdf["r"], "size": pdf["size"], "classes": out})


def prefix_length(n, percent: int):
    """Tokens of a set of ``n`` of which a partner must share one: n - ceil(t n) + 1."""
    return n - (percent * n + 99) // 100 + 1


_SURVIVOR = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("lone", pa.int64()), ("prefix", pa.list_(pa.int64())), ("tokens", pa.binary())])


def _survivors(batches, percent: int):
    """Sets that may have a partner, with the shared tokens of their prefix in the rarest-first
    order (frequency class, then hash)."""
    for batch in batches:
        for row in batch.to_pylist():
            sid = np.array(row["sid"], np.int64)
            sizes = _stored(np.array(row["n"], np.int64), sid)
            tokens = _undo(row["tokens"], sizes)
            replies = sorted(row["replies"] or [], key=lambda x: x["r"])
            classes = np.concatenate([unpack(x["classes"], x["size"], 1) for x in replies]) if replies else np.zeros(0, np.uint64)
            cls = classes[np.searchsorted(np.unique(tokens), tokens)]
            lone = _sum_runs((cls == 1).astype(np.int64), sizes)
            need = prefix_length(sizes, percent)
            ends = np.cumsum(sizes)
            out: list[list] = [[] for _ in _SURVIVOR]
            for i in np.flatnonzero((sizes > 0) & (lone < need)):
                mine, c = tokens[ends[i] - sizes[i] : ends[i]], cls[ends[i] - sizes[i] : ends[i]]
                order = np.argsort((c << np.uint64(BITS)) | mine)[lone[i] : need[i]]
                for x, v in zip(out, (sid[i], sizes[i], lone[i], mine[order].view(np.int64), _deltas(mine, sizes[i : i + 1]))):
                    x.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, _SURVIVOR)], schema=_SURVIVOR)


def _frequencies(chunks: DataFrame, percent: int) -> DataFrame:
    parts = groups(chunks.sparkSession)
    asked = chunks.mapInArrow(functools.partial(_requests, parts=parts), "r int, chunk string, size long, tokens binary, counts binary")
    replies = cut(asked.groupBy("r").applyInPandas(_replies, "chunk string, r int, size long, classes binary"))
    del asked
    release(chunks.sparkSession)
    per_chunk = replies.groupBy("chunk").agg(F.collect_list(F.struct("r", "size", "classes")).alias("replies"))  # one entry per token range
    found = chunks.select("chunk", "n", "sid", "tokens").join(per_chunk, "chunk").mapInArrow(functools.partial(_survivors, percent=percent), "sid long, n long, lone long, prefix array<bigint>, tokens binary")
    found = cut(found)
    del per_chunk, replies
    return found


def _verified(batches, percent: int):
    """Keeps the pairs that share a prefix token under each hash order and reach the
    threshold on the full sets."""

    def first(tokens: np.ndarray, salt: int) -> np.ndarray:
        h = mix(tokens ^ np.uint64(salt))
        k = int(prefix_length(len(h), percent))
        return np.partition(h, k - 1)[:k]

    for batch in batches:
        keep, last = np.zeros(batch.num_rows, bool), (None, None, [])
        cols = [batch.column(x) for x in ("a", "na", "ta", "nb", "tb")]
        for i in range(batch.num_rows):
            a, na, ta, nb, tb = (c[i].as_py() for c in cols)
            if last[0] != a:
                tokens = _undo(ta, np.array([na]))
                last = (a, tokens, [first(tokens, s) for s in ORDERS])
            other = _undo(tb, np.array([nb]))
            if all(np.isin(first(other, s), x).any() for s, x in zip(ORDERS, last[2])):
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                keep[i] = 100 * both >= percent * (na + nb - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the candidate ``pairs`` that link."""
    left = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(functools.partial(_verified, percent=percent), "a long, b long")


def _linked(sets: DataFrame, percent: int, leaders: int = 2) -> DataFrame:
    """(node, component) of every set that links with another one."""
    size_ok = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    rows = sets.select("sid", "n", "lone", F.posexplode("prefix").alias("pos", "token"))

    def rank(k: int) -> Column:
        # the first leader is the set with the smallest share of tokens that no other has: the
        # text that a group's copies were made from, if it is there, or the nearest to it
        order = F.floor(F.col("lone") * 1000 / F.col("n")) if k == 0 else F.lit(0).cast("long")
        return F.struct(order.alias("o"), F.xxhash64(F.lit(k), "sid").alias("h"), "sid", "n")

    heads = rows.groupBy("token").agg(F.count("*").alias("size"), *(F.min(rank(k)).alias(f"l{k}") for k in range(leaders))).where("size > 1")
    met = rows.join(heads.drop("size"), "token").select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.explode(F.array(*(F.col(f"l{k}") for k in range(leaders)))).alias("l"))
    met = met.select("b", "nb", F.col("l.sid").alias("a"), F.col("l.n").alias("na")).where(size_ok & (F.col("a") != F.col("b")))
    links = cut(_links(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets, percent))
    first = cut(components(links))
    release(sets.sparkSession)
    # Members of one bucket that are still apart: every such pair is verified. A pair's
    # first common token in the common order passes the bound on what can still be shared:
    # tokens that no other set has come first in that order and are never shared.
    label = rows.join(first.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    label = cut(label.select("token", "sid", "n", "component", (F.col("n") - F.col("lone") - F.col("pos")).alias("rest")))
    apart = _apart(label, percent)
    late = cut(_links(apart.join(links, ["a", "b"], "left_anti"), sets, percent))
    joined = first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(late)
    return components(joined)


def _apart(label: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs to verify in buckets that hold several components. Components meet
    first, as one row per bucket with the range of their members' sizes: a component whose sizes fit
    no other's brings no member into the pairs, however many it has."""
    mixed = label.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    rows = label.join(mixed, "token", "left_semi")
    ranges = rows.groupBy("token", "component").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"))
    side = lambda tag: ranges.select("token", *(F.col(c).alias(f"{c}_{tag}") for c in ("component", "least", "most", "rest")))
    fits = (F.col("most_x") * 100 >= F.col("least_y") * percent) & (F.col("most_y") * 100 >= F.col("least_x") * percent)
    can = F.least("rest_x", "rest_y") * (100 + percent) >= (F.col("least_x") + F.col("least_y")) * percent
    met = cut(side("x").join(side("y"), "token").where((F.col("component_x") < F.col("component_y")) & fits & can))

    def members(tag: str, other: str, sid: str, n: str, rest: str) -> DataFrame:
        own = rows.select("token", F.col("component").alias(f"component_{tag}"), F.col("sid").alias(sid), F.col("n").alias(n), F.col("rest").alias(rest))
        near = (F.col(n) * 100 >= F.col(f"least_{other}") * percent) & (F.col(f"most_{other}") * 100 >= F.col(n) * percent)
        share = F.least(rest, f"rest_{other}") * (100 + percent) >= (F.col(n) + F.col(f"least_{other}")) * percent
        wide = met.select("token", "component_x", "component_y", f"least_{other}", f"most_{other}", f"rest_{other}")
        return own.join(wide, ["token", f"component_{tag}"]).where(near & share).select("token", "component_x", "component_y", sid, n, rest)

    size_ok = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    may = F.least("ra", "rb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    both = members("x", "y", "a", "na", "ra").join(members("y", "x", "b", "nb", "rb"), ["token", "component_x", "component_y"]).where(size_ok & may)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 75, chunk_bytes: int = 16 << 20, hot: int = 1000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text). The fewer than
    ``hot`` classes with more than 1/``hot`` of all rows each get their id by broadcast."""
    chunks = _chunks(docs, n, chunk_bytes)
    rows = chunks.select(F.explode(F.arrays_zip("doc_id", "n", "sid")).alias("x")).select("x.*")
    rows = cut(rows)
    sets = _frequencies(chunks, percent)
    del chunks
    release(docs.sparkSession)
    sets = cut(sets.dropDuplicates(["sid"]))
    release(docs.sparkSession)
    linked = _linked(sets, percent)
    rows = rows.join(linked.withColumnRenamed("node", "sid"), "sid", "left").withColumn("class", F.when(F.col("n") > 0, F.coalesce("component", "sid")))
    lowest = cut(rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("low"), F.count("*").alias("size")))
    share = (lowest.agg(F.sum("size")).first()[0] or 0) / hot
    few = F.broadcast(lowest.where(F.col("size") > share).select("class", F.col("low").alias("hot_low"), F.lit(True).alias("is_hot")))  # fewer than `hot` classes
    rows = rows.join(few, "class", "left")
    named = lambda low: (F.col("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.coalesce(low, "doc_id")).alias("component_id"))
    many = lowest.where(F.col("size") <= share).select("class", "low")
    return rows.where("is_hot").select(*named("hot_low")).unionByName(rows.where("is_hot is null").join(many, "class", "left").select(*named("low")))
