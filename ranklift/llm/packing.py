"""Bounded-space online packing of token sequences.

Every partition keeps at most ``windows`` open sequences of ``length`` tokens. A text's pieces
go one by one: full-length pieces leave at once; a rest goes into the open window that it fits
best; when it fits none and no new window may open, the fullest is topped up with the head of
the piece (texts may be cut) and emitted. What is open at the end of a partition are leftovers;
they are merged by the same rule in groups of ``merge`` partitions, and the last window of each
group is cut at powers of two, which need no padding.

Token ids never leave the partition except in leftovers, unless ``with_ids``; a piece carries
their checksum. Memory is one Arrow batch plus the open windows.

Cases: null text is empty, and an empty text is its end token alone; a null doc_id, repeated
rows and repeated ids are packed row by row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklift.llm.storage import cut, release
from ranklift.llm.words import word_hashes

_CACHES: dict = {}
_AT_ONCE = 200  # words that the tokenizer gets in one string
_SLICE = 16 << 20  # bytes of text that are worked off together
_KEEP = 2_000_000  # words whose ids a worker keeps from slice to slice
_MARK = "#"  # stands between words; those that hold it are encoded apart


class _Words:
    """Ids of the distinct words a worker has seen, by word hash."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.clear()

    def clear(self) -> None:
        self.hashes, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word); none of the words holds white space."""
        plain = [i for i, w in enumerate(words) if _MARK not in w] if self.mark is not None else []
        other = [i for i, w in enumerate(words) if _MARK in w] if self.mark is not None else list(range(len(words)))
        between = f" {_MARK} "
        lists = self.tokenizer.encode_batch_fast([between.join([words[i] for i in plain[a : a + _AT_ONCE]]) + between for a in range(0, len(plain), _AT_ONCE)], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in lists)])
        ends = np.flatnonzero(ids == self.mark) if self.mark is not None else np.zeros(0, np.int64)
        sizes = np.zeros(len(words), np.int64)
        sizes[plain] = np.diff(ends, prepend=-1) - 1
        singles = [x.ids for x in self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)]
        sizes[other] = [len(x) for x in singles]
        out = np.zeros(int(sizes.sum()), np.uint32)
        is_other = np.zeros(len(words), bool)
        is_other[other] = True
        apart = np.repeat(is_other, sizes)
        out[~apart] = np.delete(ids, ends)
        out[apart] = [x for xs in singles for x in xs]
        return out, sizes

    def learn(self, hashes: np.ndarray, word_at) -> np.ndarray:
        """Places of the sorted ``hashes``; ``word_at`` gives the words at the given indices."""
        if len(self.hashes) > _KEEP:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            flat, size = self.encode(word_at(new))
            begin = np.cumsum(size) - size + len(self.flat)
            all_hashes = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(all_hashes, kind="stable")
            self.hashes, self.begin, self.size = all_hashes[order], np.concatenate([self.begin, begin])[order], np.concatenate([self.size, size])[order]
            self.flat = np.concatenate([self.flat, flat])
            at = np.searchsorted(self.hashes, hashes)
        return at


def encode(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, ids per text), each text followed by ``end_id``.

    The tokenizer splits at white space, so every distinct word is encoded once and its ids are
    copied to where it stands. White space other than space and \\t to \\r stays inside what is
    encoded.
    """
    if path not in _CACHES:
        _CACHES[path] = _Words(path)
    cache = _CACHES[path]
    hashes, before, start, stop, raw = word_hashes(texts, lower=False, spans=True)
    unlike, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    data = raw.data
    at = cache.learn(unlike, lambda new: [bytes(data[x:y]).decode("utf-8") for x, y in zip(start[first[new]].tolist(), stop[first[new]].tolist())])
    size, begin = cache.size[at], cache.begin[at]
    per_word = size[place]
    total = np.concatenate([[0], np.cumsum(per_word)])
    per_text = total[before[1:]] - total[before[:-1]]
    out = np.full(int(per_text.sum()) + len(per_text), end_id, np.uint32)
    ends = np.zeros(len(out), bool)
    ends[np.cumsum(per_text + 1) - 1] = True
    out[~ends] = cache.flat[np.repeat(begin[place] - total[:-1], per_word) + np.arange(total[-1])]
    return out, per_text + 1


class _Windows:
    """Open windows of one partition or merge group; emits (pieces) of closed ones."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.open, self.done = length, most, [], []

    def add(self, piece: tuple) -> None:
        """``piece``: (doc_id, start, ids, doc_tokens)."""
        doc, start, ids, total = piece
        while len(ids) >= self.length:
            self.done.append([(doc, start, ids[: self.length], total)])
            start, ids = start + self.length, ids[self.length :]
        while len(ids):
            room = [self.length - w[0] for w in self.open]
            fits = [i for i, r in enumerate(room) if r >= len(ids)]
            if fits:
                i = min(fits, key=lambda k: room[k])
            elif len(self.open) < self.most:
                self.open.append([0, []])
                i = len(self.open) - 1
            else:
                i = min(range(len(room)), key=lambda k: room[k])
            window = self.open[i]
            take = min(len(ids), self.length - window[0])
            window[0] += take
            window[1].append((doc, start, ids[:take], total))
            start, ids = start + take, ids[take:]
            if window[0] == self.length:
                self.done.append(window[1])
                del self.open[i]

    def take(self) -> list:
        out, self.done = self.done, []
        return out


def _powers(pieces: list) -> list[list]:
    """Cuts a window's pieces into windows of decreasing powers of two."""
    total = sum(len(p[2]) for p in pieces)
    out = []
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        window = []
        while room:
            doc, start, ids, n = pieces[0]
            take = min(room, len(ids))
            window.append((doc, start, ids[:take], n))
            room -= take
            pieces = pieces[1:] if take == len(ids) else [(doc, start + take, ids[take:], n), *pieces[1:]]
        out.append(window)
    return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean, partition int"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("open", pa.bool_()), ("partition", pa.int32())])


def _rows(windows: list, first: int, with_ids: bool, still_open: bool, partition: int):
    cols: list[list] = [[] for _ in _ARROW]
    for k, window in enumerate(windows):
        offset = 0
        for doc, start, ids, total in window:
            data = np.ascontiguousarray(ids, "<u4").tobytes()
            for col, x in zip(cols, (doc, start, len(ids), zlib.crc32(data), total, first + k, offset, data if with_ids else None, still_open, partition)):
                col.append(x)
            offset += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _ARROW)], schema=_ARROW)


def _pack(batches, path: str, end_id: int, length: int, windows: int, with_ids: bool):
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    state, number = _Windows(length, windows), part << 36
    for batch in batches:
        text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        a = 0
        while a < len(text):
            b = max(a + 1, int(np.searchsorted(at, at[a] + _SLICE, "right")) - 1)
            ids, sizes = encode(text.slice(a, b - a), path, end_id)
            for doc, end, size in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), np.cumsum(sizes).tolist(), sizes.tolist()):
                state.add((doc, 0, ids[end - size : end], size))
            closed = state.take()
            if closed:
                yield _rows(closed, number, with_ids, False, part)
                number += len(closed)
            for w in state.open:  # pieces of a worked-off batch must not keep its ids alive
                w[1] = [(d, s, x.copy() if x.base is not None else x, n) for d, s, x, n in w[1]]
            a = b
    if state.open:
        yield _rows([w[1] for w in state.open], number, True, True, part)


def _merge(batches, length: int, windows: int, with_ids: bool):
    """Packs leftovers anew; a group's partitions arrive sorted by window."""
    from pyspark import TaskContext

    state, number = _Windows(length, windows), (1 << 62) + (TaskContext.get().partitionId() << 36)
    for batch in batches:
        for doc, start, ids, total in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "start", "ids", "doc_tokens"))):
            state.add((doc, start, np.frombuffer(ids, "<u4"), total))
        closed = state.take()
        if closed:
            yield _rows(closed, number, with_ids, False, -1)
            number += len(closed)
    # what is open is filled from the emptiest window on; the last one is cut at powers of two
    rest = sorted(state.open, key=lambda w: w[0])
    last = _Windows(length, 1)
    for w in rest:
        for p in w[1]:
            last.add(p)
    closed = last.take() + [x for w in last.open for x in _powers(w[1])]
    if closed:
        yield _rows(closed, number, with_ids, False, -1)


def pack_texts(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, windows: int = 8, merge: int = 64, with_ids: bool = True) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset[, ids as little-endian unsigned 32-bit])."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = cut(rows.mapInArrow(functools.partial(_pack, path=tokenizer, end_id=end_id, length=length, windows=windows, with_ids=with_ids), _PIECES))
    release(docs.sparkSession)
    left = packed.where("open").withColumn("group", F.floor(F.col("partition") / merge))
    left = left.repartition("group").sortWithinPartitions("group", "sequence_id", "offset").drop("group")
    merged = cut(left.mapInArrow(functools.partial(_merge, length=length, windows=windows, with_ids=with_ids), _PIECES))
    out = packed.where(~F.col("open")).union(merged).drop("open", "partition")
    return out if with_ids else out.drop("ids")
