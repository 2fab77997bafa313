"""Katz backoff language model: Good-Turing discounted counts, exact backoff weights.

    P(w | v) = d(c) c(v w) / c(v)                        if v w was seen
             = alpha(v) P(w)                             else, if v was seen as a history
             = P(w)                                      else
    P(w)     = d(c) c(w) / N, and what the discounts leave for every unknown word together

``d`` is the Good-Turing ratio up to count ``K`` and 1 above; ``alpha(v)`` gives the mass the
discounts free to exactly the words not seen after v, so each history's probabilities sum to 1.
A history whose counts are all above K has nothing freed; it divides by c(v) + 1 instead.

Training and scoring share one exchange pattern, since neither vocabulary nor bigrams fit one
machine: texts become *chunks* (columnar blobs of local word codes); a chunk sends its distinct
words, or distinct pairs, once with a count to reduce groups and gets ids and counts back.
Pairs are dealt by history; a history with more than its share of all tokens is dealt by
history and word, and its (at most 4 per group) sums are put together afterwards. The tables:

* ``unigrams``: one row per reduce group: word hashes, ids, counts.
* ``bigrams``: one row per group: history, word, count, sorted; with the histories' totals and
  the probability of their followers, from which alpha follows.

Both are Parquet tables partitioned by group, beside the chunks (with the ids and counts of
their words) and the few totals of the model, in the model's folder; ``fit`` writes them, ``load``
opens them again, and scoring reads nothing else.

Each token is looked up in the bigram table first; what is not there takes alpha and the
unigram level, whose log is added per text.

Cases: null text is empty and is scored as its end alone; a null doc_id trains (its remainder
is not 2); repeated rows count and are returned each; no training text gives every token
probability 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklift.llm.storage import cut, groups, release
from ranklift.llm.words import mix, pack, unpack, word_hashes
from ranklift.session import ensure_checkpoint_dir

K = 5  # counts above K are not discounted
END = np.uint64(0)  # hash of the end of a text, a token of its own
BEGIN_ID, FIRST_ID = 1, 2  # id 0: not in training
WIDE = 5  # bytes of ids and counts in blobs


def good_turing(n: list[int]) -> np.ndarray:
    """Discounts d[0..K] from the numbers n[1..K+1] of grams with each count; absolute
    discounting instead where the counts of counts give no ratio in (0, 1)."""
    d = np.ones(K + 1)
    n = [0, *n]
    if n[1] and n[K + 1] and (K + 1) * n[K + 1] < n[1] and all(n[1 : K + 2]):
        lost = (K + 1) * n[K + 1] / n[1]
        d[1:] = [((r + 1) * n[r + 1] / (r * n[r]) - lost) / (1 - lost) for r in range(1, K + 1)]
    if not ((d[1:] > 0) & (d[1:] < 1)).all():
        off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1:] = [(r - off) / r for r in range(1, K + 1)]
    return d


@dataclass(frozen=True)
class Unigrams:
    """What a task needs of the unigram level besides a token's own count."""

    total: int
    distinct: int
    discounts: np.ndarray
    freed: float  # tokens' worth of mass that the discounts leave

    def probability(self, c: np.ndarray) -> np.ndarray:
        """Of a word with training count ``c``; 0 stands for all unknown words together."""
        c = np.asarray(c, np.float64)
        if not self.total:
            return np.ones(len(c))
        if self.freed <= 0:
            return np.where(c > 0, c, 1.0) / (self.total + 1)
        d = self.discounts[np.minimum(c, K + 1).astype(np.int64) % (K + 1)]
        return np.where(c > 0, np.where(c > K, 1.0, d) * c, self.freed) / self.total


def _bytes_slices(text: pa.Array, size: int):
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1)
        yield a, b
        a = b


_CHUNK = pa.schema([("chunk", pa.string()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int64())), ("n_words", pa.int64()), ("words", pa.binary()), ("codes", pa.binary())])


def _encode(batches, chunk_tokens: int):
    """Chunks of texts: their words, most frequent first, and every token's place there. The tokens
    of a chunk wait as 32-bit places in the words of their slice."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    held, ids, sizes, tokens = [], [], [], []

    def flush():
        nonlocal number
        words, place = np.unique(np.concatenate([w for w, _, _ in tokens]), return_inverse=True)
        count = np.bincount(place, np.concatenate([c for _, _, c in tokens]), len(words)).astype(np.int64)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        rank = rank[place]  # by word of each slice
        begin = np.cumsum([0, *(len(w) for w, _, _ in tokens)])
        codes = np.concatenate([rank[a : a + len(w)][code] for a, (w, code, _) in zip(begin, tokens)])
        row = [f"{part}-{number}", sum(ids, []), sum(held, []), np.concatenate(sizes), len(words), pack(words[order], 8), pack(codes)]
        number += 1
        for x in (held, ids, sizes, tokens):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _CHUNK)], schema=_CHUNK)

    for batch in batches:
        text = batch.column("text").cast(pa.large_string())
        for a, b in _bytes_slices(text, 8 << 20):
            for c, d in _bytes_slices(text.slice(a, b - a), 1 << 20):
                words, before = word_hashes(text.slice(a + c, d - c))
                size = np.diff(before) + 1
                out = np.full(int(size.sum()), END, np.uint64)
                last = np.zeros(len(out), bool)
                last[np.cumsum(size) - 1] = True
                out[~last] = words
                words, code, count = np.unique(out, return_inverse=True, return_counts=True)
                tokens.append((words, code.astype(np.int32), count))
                sizes.append(size)
            ids.append(batch.column("doc_id").slice(a, b - a).to_pylist())
            held.append(batch.column("held").slice(a, b - a).to_pylist())
            if sum(len(code) for _, code, _ in tokens) >= chunk_tokens:
                yield flush()
    if tokens:
        yield flush()


def _rows(batches):
    """One row at a time, since a batch may hold every chunk of a partition."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _chunk(row: dict) -> dict:
    size = np.array(row["size"], np.int64)
    return row | {"size": size, "held": np.array(row["held"], bool), "codes": unpack(row["codes"], int(size.sum())).astype(np.int32)}


def _word_requests(batches, parts: int):
    for row in map(_chunk, _rows(batches)):
        words = unpack(row["words"], row["n_words"], 8)
        count = np.bincount(row["codes"][~np.repeat(row["held"], row["size"])], minlength=len(words))
        order = np.argsort(words)
        words, count = words[order], count[order]
        edges = np.searchsorted(words, np.array([min((r << 64) // parts, 2**64 - 1) for r in range(parts)], np.uint64)).tolist() + [len(words)]
        edges[0] = 0
        for r in range(parts):
            a, b = edges[r], edges[r + 1]
            if b > a:
                step = words[a:b].copy()
                step[1:] -= words[a : b - 1]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([row["chunk"]]), pa.array([b - a], pa.int64()), pa.array([pack(step, 8)], pa.binary()), pa.array([pack(count[a:b])], pa.binary())], names=["r", "chunk", "size", "words", "counts"])


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, K + 2).astype(np.int64), minlength=K + 3)[1 : K + 2].tolist()


_WORDS = "chunk string, r int, size long, words binary, ids binary, counts binary, total long, distinct_words long, counts_of_counts array<bigint>"


def _count_words(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Replies to every chunk, and one row (chunk null) with the group's table."""
    r = int(pdf["r"].iloc[0])
    asked = [np.cumsum(unpack(w, s, 8)) for w, s in zip(pdf["words"], pdf["size"])]
    words, at = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(words), np.int64)
    np.add.at(total, at, np.concatenate([unpack(c, s) for c, s in zip(pdf["counts"], pdf["size"])]).astype(np.int64))
    order = np.argsort(-total, kind="stable")
    ids = np.empty(len(words), np.int64)
    ids[order] = FIRST_ID + np.arange(len(words)) * parts + r
    ids[total == 0] = 0
    ends = np.cumsum([len(x) for x in asked])
    rows = [(chunk, r, len(x), None, pack(ids[at[e - len(x) : e]], WIDE), pack(total[at[e - len(x) : e]], WIDE), None, None, None) for chunk, x, e in zip(pdf["chunk"], asked, ends)]
    seen = total > 0
    rows.append((None, r, int(seen.sum()), pack(words[seen], 8), pack(ids[seen], WIDE), pack(total[seen], WIDE), int(total.sum()), int(seen.sum()), _counts_of_counts(total[seen])))
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _WORDS.split(", ")]).astype({"total": "Int64", "distinct_words": "Int64"})


_KNOWN = pa.schema([("chunk", pa.string()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int64())), ("n_words", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary())])


def _learned(batches):
    """Chunks with the ids and counts of their words in place of the hashes."""
    for row in _rows(batches):
        order = np.argsort(unpack(row["words"], row["n_words"], 8))
        got = sorted(row["replies"], key=lambda x: x["r"])
        for name in ("ids", "counts"):
            out = np.empty(row["n_words"], np.uint64)
            out[order] = np.concatenate([unpack(x[name], x["size"], WIDE) for x in got])
            row[name] = pack(out, WIDE)
        yield pa.RecordBatch.from_arrays([pa.array([row[t.name]], t.type) for t in _KNOWN], schema=_KNOWN)


def _pairs(row: dict, texts: np.ndarray):
    """(history code, word code, text) of every token of the chosen texts; the begin of a text
    has the code after the last word's."""
    size, n = row["size"], row["n_words"]
    history = np.empty(len(row["codes"]), np.int32)  # a chunk has few enough words and texts
    history[1:] = row["codes"][:-1]
    history[np.cumsum(size) - size] = n
    text = np.repeat(np.arange(len(size), dtype=np.int32), size)
    if texts.all():
        return history, row["codes"], text
    chosen = np.repeat(texts, size)
    return history[chosen], row["codes"][chosen], text[chosen]


def _known(row: dict, begins: int):
    ids = np.append(unpack(row["ids"], row["n_words"], WIDE), np.uint64(BEGIN_ID))
    counts = np.append(unpack(row["counts"], row["n_words"], WIDE), np.uint64(begins))
    return ids, counts


def _group(v: np.ndarray, w: np.ndarray, cv: np.ndarray, parts: int, hot: int) -> np.ndarray:
    """Reduce group of a pair: by its history, or by both where the history is hot."""
    h = mix(v)
    h = np.where(cv > hot, mix(h ^ w), h)
    return (h % np.uint64(parts)).astype(np.int64)


def _groups(ids: np.ndarray, counts: np.ndarray, v: np.ndarray, w: np.ndarray, parts: int, hot: int, step: int = 1 << 17) -> np.ndarray:
    """:func:`_group` of pairs of codes, a step at a time."""
    out = np.empty(len(v), np.int32)
    for a in range(0, len(v), step):
        x, y = v[a : a + step], w[a : a + step]
        out[a : a + step] = _group(ids[x], ids[y], counts[x], parts, hot)
    return out


def _pair_requests(batches, parts: int, hot: int, begins: int):
    for row in map(_chunk, _rows(batches)):
        v, w, _ = _pairs(row, ~row["held"])
        n = row["n_words"]
        key, count = np.unique(v * np.int64(n) + w, return_counts=True)
        del v, w
        ids, counts = _known(row, begins)
        v, w = (key // max(n, 1)).astype(np.int32), (key % max(n, 1)).astype(np.int32)
        del key
        r = _groups(ids, counts, v, w, parts, hot)
        order = np.lexsort((ids[w], ids[v], r))
        v, w, count, edges = v[order], w[order], count[order], np.searchsorted(r[order], np.arange(parts + 1))
        for i in range(parts):
            a, b = edges[i], edges[i + 1]
            if b > a:
                cols = [pack(x, WIDE) for x in (ids[v[a:b]], counts[v[a:b]], ids[w[a:b]], counts[w[a:b]])] + [pack(count[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([int(b - a)], pa.int64()), *(pa.array([x], pa.binary()) for x in cols)], names=["r", "size", "v", "cv", "w", "cw", "count"])


_TABLE = "r int, size long, v binary, cv binary, w binary, cw binary, counts binary, n_histories long, followed binary, counts_of_counts array<bigint>, hot array<struct<v: bigint, cv: bigint, seen: array<bigint>, followed: double>>"


def _count_pairs(pdf: pd.DataFrame, unigrams: Unigrams, hot: int) -> pd.DataFrame:
    """One group's bigram table, sorted by history and word."""
    cat = lambda name, width=WIDE: np.concatenate([unpack(x, s, width) for x, s in zip(pdf[name], pdf["size"])])
    v, w, count = cat("v"), cat("w"), cat("count", 4).astype(np.int64)
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(new)
    c = np.add.reduceat(count[order], at)
    v, w, cv, cw = v[at], w[at], cat("cv")[order][at], cat("cw")[order][at]
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    followed = np.add.reduceat(unigrams.probability(cw), first)
    seen = np.stack([np.add.reduceat((c == k).astype(np.int64), first) for k in range(1, K + 1)], 1)
    hots = [{"v": int(v[f]), "cv": int(cv[f]), "seen": seen[i].tolist(), "followed": float(followed[i])} for i, f in enumerate(first) if cv[f] > hot]
    row = (int(pdf["r"].iloc[0]), len(v), pack(v, WIDE), pack(cv, WIDE), pack(w, WIDE), pack(cw, WIDE), pack(c, WIDE), len(first), followed.tobytes(), _counts_of_counts(c), hots)
    return pd.DataFrame([row], columns=["r", "size", "v", "cv", "w", "cw", "counts", "n_histories", "followed", "counts_of_counts", "hot"])


def _events(batches, parts: int, hot: int, begins: int):
    """Every token after a known history, dealt like the pairs of the table."""
    for row in map(_chunk, _rows(batches)):
        v, w, text = _pairs(row, np.ones(len(row["size"]), bool))
        ids, counts = _known(row, begins)
        seen = ids[v] > 0
        if not seen.all():
            v, w, text = v[seen], w[seen], text[seen]
        r = _groups(ids, counts, v, w, parts, hot)
        order = np.lexsort((w, v, r)).astype(np.int32)
        v, w, text, edges = v[order], w[order], text[order], np.searchsorted(r[order], np.arange(parts + 1))
        del r, order, seen
        for i in range(parts):
            a, b = edges[i], edges[i + 1]
            if b > a:
                cols = [pack(x, WIDE) for x in (ids[v[a:b]], ids[w[a:b]])] + [pack(text[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row["chunk"]]), pa.array([len(row["size"])], pa.int64()), pa.array([int(b - a)], pa.int64()), *(pa.array([x], pa.binary()) for x in cols)], names=["r", "chunk", "n_texts", "size", "v", "w", "text"])


def _weights(c: np.ndarray, cv: np.ndarray, freed: np.ndarray, followed: np.ndarray, discounts: np.ndarray):
    """(log10 of alpha by history, divisor by history); ``freed`` in counts."""
    none = freed <= 1e-12 * cv
    divisor = np.where(none, cv + 1.0, cv)
    rest = np.maximum(1.0 - followed, 1e-300)
    return np.log10(np.where(none, 1.0, freed) / divisor / rest), none, divisor


def _evaluate(events: pd.DataFrame, table: pd.DataFrame, unigrams: Unigrams, discounts: np.ndarray, hot: dict) -> pd.DataFrame:
    """Per chunk and text: sum over its tokens of log10 P(w | v) - log10 P(w)."""
    if events.empty:
        return pd.DataFrame({"chunk": pd.Series(dtype=str), "gain": pd.Series(dtype=object)})
    if len(table):
        t = table.iloc[0]
        v, cv, w, cw, c = (unpack(t[x], t["size"], WIDE) for x in ("v", "cv", "w", "cw", "counts"))
        first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        cf = c.astype(np.float64)
        d = np.where(c > K, 1.0, discounts[np.minimum(c, K).astype(np.int64)])
        freed = np.add.reduceat((1.0 - d) * cf, first)
        followed = np.frombuffer(t["followed"], np.float64).copy()
        names = v[first]
    else:
        v = w = cw = c = names = np.zeros(0, np.uint64)
        cv, d, cf, freed, followed, first = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
    history_total = cv[first].astype(np.float64)
    for name, (total, seen, p) in hot.items():
        i = int(np.searchsorted(names, np.uint64(name)))
        f = float(sum(n * k * (1.0 - discounts[k]) for k, n in enumerate(seen, 1)))
        if i < len(names) and names[i] == name:
            freed[i], followed[i] = f, p
        else:
            names, history_total, freed, followed = (np.insert(x, i, y) for x, y in ((names, np.uint64(name)), (history_total, total), (freed, f), (followed, p)))
    alpha, none, divisor = _weights(c, history_total, freed, followed, discounts)
    vi = np.searchsorted(names, v)
    key = (vi.astype(np.uint64) << np.uint64(8 * WIDE)) | w
    gain = np.log10(np.where(none[vi], 1.0, d) * cf / divisor[vi]) - np.log10(unigrams.probability(cw)) if len(v) else np.zeros(0)
    out = []
    for chunk, n, size, ev, ew, text in zip(events["chunk"], events["n_texts"], events["size"], events["v"], events["w"], events["text"]):
        ev, ew, text = unpack(ev, size, WIDE), unpack(ew, size, WIDE), unpack(text, size).astype(np.int64)
        at = np.searchsorted(names, ev)
        q = (at.astype(np.uint64) << np.uint64(8 * WIDE)) | ew
        i = np.minimum(np.searchsorted(key, q), max(len(key) - 1, 0))
        hit = (key[i] == q) if len(key) else np.zeros(size, bool)
        score = np.where(hit, gain[i] if len(key) else 0.0, alpha[at])
        out.append(np.bincount(text, score, minlength=n).tobytes())
    return pd.DataFrame({"chunk": events["chunk"].to_numpy(), "gain": out})


def _text_scores(batches, unigrams: Unigrams, begins: int):
    """Per chunk, each text's counts and unigram sums."""
    for row in map(_chunk, _rows(batches)):
        _, counts = _known(row, begins)
        c = counts[row["codes"]].astype(np.float64)
        at = np.cumsum(row["size"]) - row["size"]
        add = lambda x: np.add.reduceat(x, at) if len(x) else np.zeros(0)  # noqa: E731, B023
        cols = [row["doc_id"], row["held"], row["size"], add((c > 0).astype(np.int64)), add(np.log10((c + 1) / (unigrams.total + unigrams.distinct + 1))), add(np.log10(unigrams.probability(c)))]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), *(pa.array([x], pa.list_(t)) for x, t in zip(cols, types))], names=["chunk", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "unigram_score"])


def _finish(batches):
    for row in _rows(batches):
        score = np.array(row["unigram_score"]) + sum((np.frombuffer(x, np.float64) for x in row["gains"] or []), np.zeros(len(row["doc_id"])))
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([*(pa.array(row[x], t) for x, t in zip(names, types)), pa.array(row["unigram_score"], pa.float64()), pa.array(score)], names=[*names, "unigram_score", "score"])


@dataclass(frozen=True)
class Katz:
    """A fitted model with the chunks it was fitted beside."""

    chunks: DataFrame
    words: DataFrame  # unigram table: rows (r, size, words, ids, counts)
    bigrams: DataFrame  # rows of _TABLE
    unigrams: Unigrams
    discounts: np.ndarray
    hot_bound: int
    begins: int


_STORED = "chunk string, doc_id array<bigint>, held array<boolean>, size array<bigint>, n_words long, codes binary, ids binary, counts binary"
_TOTALS = "total long, distinct_words long, discounts array<double>, freed double, pair_discounts array<double>, hot_bound long, begins long"


def load(spark: SparkSession, path: str) -> Katz:
    """The model that ``fit`` wrote to ``path``."""
    m = spark.read.schema(_TOTALS).parquet(f"{path}/totals").first()
    unigrams = Unigrams(m.total, m.distinct_words, np.array(m.discounts), m.freed)
    table = lambda name, ddl: spark.read.schema(StructType.fromDDL(ddl)).parquet(f"{path}/{name}")
    return Katz(table("chunks", _STORED), table("unigrams", _WORDS).drop("chunk"), table("bigrams", _TABLE), unigrams, np.array(m.pair_discounts), m.hot_bound, m.begins)


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/katz-{uuid.uuid4().hex}"


def fit(docs: DataFrame, held: Column, chunk_tokens: int = 1_500_000, path: str | None = None) -> Katz:
    """Learns from the rows of ``docs`` (doc_id, text) where ``held`` is not true, and writes the
    model to ``path`` (default: a new folder beside the checkpoints)."""
    spark = docs.sparkSession
    path = path or _folder(spark)
    parts = groups(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    chunks = cut(rows.mapInArrow(functools.partial(_encode, chunk_tokens=chunk_tokens), "chunk string, doc_id array<bigint>, held array<boolean>, size array<bigint>, n_words long, words binary, codes binary"))
    words = cut(chunks.mapInArrow(functools.partial(_word_requests, parts=parts), "r int, chunk string, size long, words binary, counts binary").groupBy("r").applyInPandas(functools.partial(_count_words, parts=parts), _WORDS))
    words.where("chunk is null").drop("chunk").write.partitionBy("r").parquet(f"{path}/unigrams")
    s = words.where("chunk is null").agg(F.sum("total"), F.sum("distinct_words"), *(F.sum(F.col("counts_of_counts")[k]) for k in range(K + 1))).first()
    total, distinct, counts = int(s[0] or 0), int(s[1] or 0), [int(x or 0) for x in s[2:]]
    d = good_turing(counts)
    unigrams = Unigrams(total, distinct, d, float(sum(n * k * (1.0 - d[k]) for k, n in zip(range(1, K + 1), counts))))
    begins = int(chunks.select(F.sum(F.size(F.filter("held", lambda x: ~x)))).first()[0] or 0)
    replies = words.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("r", "size", "ids", "counts")).alias("replies"))  # one entry per group
    chunks.join(replies, "chunk").mapInArrow(_learned, _STORED).write.parquet(f"{path}/chunks")
    del chunks, replies, words
    release(spark)
    learned = spark.read.schema(StructType.fromDDL(_STORED)).parquet(f"{path}/chunks")
    hot = max(1, total // (4 * parts))
    counted = learned.mapInArrow(functools.partial(_pair_requests, parts=parts, hot=hot, begins=begins), "r int, size long, v binary, cv binary, w binary, cw binary, count binary").groupBy("r").applyInPandas(functools.partial(_count_pairs, unigrams=unigrams, hot=hot), _TABLE)
    counted.write.partitionBy("r").parquet(f"{path}/bigrams")
    stored = StructType.fromDDL(_TABLE)
    s = spark.read.schema(stored).parquet(f"{path}/bigrams").agg(*(F.sum(F.col("counts_of_counts")[k]) for k in range(K + 1))).first()
    del counted
    release(spark)
    pair_discounts = good_turing([int(x or 0) for x in s])
    totals = (total, distinct, d.tolist(), unigrams.freed, pair_discounts.tolist(), hot, begins)
    spark.createDataFrame([totals], _TOTALS).coalesce(1).write.parquet(f"{path}/totals")
    return load(spark, path)


def score(model: Katz) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, unigram_score)."""
    parts = groups(model.chunks.sparkSession)
    hot_rows = model.bigrams.select(F.explode("hot").alias("h")).groupBy("h.v").agg(F.max("h.cv"), F.array(*(F.sum(F.col("h.seen")[k]) for k in range(K))), F.sum("h.followed")).collect()  # at most 4 rows per group
    hot = {r[0]: tuple(r[1:]) for r in hot_rows}
    events = model.chunks.mapInArrow(functools.partial(_events, parts=parts, hot=model.hot_bound, begins=model.begins), "r int, chunk string, n_texts long, size long, v binary, w binary, text binary")
    table = model.bigrams.select("r", "size", "v", "cv", "w", "cw", "counts", "followed")
    evaluate = functools.partial(_evaluate, unigrams=model.unigrams, discounts=model.discounts, hot=hot)
    gains = events.groupBy("r").cogroup(table.groupBy("r")).applyInPandas(lambda e, t: evaluate(e, t), "chunk string, gain binary")
    gains = gains.groupBy("chunk").agg(F.collect_list("gain").alias("gains"))  # one entry per group
    texts = model.chunks.mapInArrow(functools.partial(_text_scores, unigrams=model.unigrams, begins=model.begins), "chunk string, doc_id array<bigint>, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base_score array<double>, unigram_score array<double>")
    out = texts.join(gains, "chunk", "left").mapInArrow(_finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, unigram_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.unigrams.total).cast("long").alias("train_tokens"), "base_score", "score", "unigram_score")


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """Scores every text; the texts of one fold by doc_id are held out of training."""
    return score(fit(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_fold))
