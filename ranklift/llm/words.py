"""Vectorised word hashing of Arrow text columns.

A word is a run of characters outside ``\\x20\\x09-\\x0D``. Hashes are 64 bits wide: equal
words always agree, different ones collide with probability 2^-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and each text's offsets in them."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_hashes(texts: pa.Array, lower: bool = True, spans: bool = False, piece: int = 1 << 20):
    """(hash of every word, words before each text [len + 1]); with ``spans`` also the
    words' byte ranges and the bytes. Texts are worked off in pieces of whole texts, so that
    memory follows ``piece`` or the longest text."""
    raw, offsets = _flat(texts)
    hashes, begins, ends = [], [], []
    counts = np.zeros(len(offsets), np.int64)
    table = _LOWER if lower else _BYTE
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + piece, "right")) - 1)
        lo, hi = int(offsets[a]), int(offsets[b])
        part = raw[lo:hi]
        if hi > lo:
            solid = ~_SPACE[part]
            cuts = offsets[a + 1 : b] - lo
            opens = solid.copy()
            opens[1:] &= ~solid[:-1]
            inner = cuts[cuts < hi - lo]
            opens[inner] = solid[inner]  # a word never spans two texts
            start = np.flatnonzero(opens)
            edge = np.zeros(hi - lo + 1, bool)
            edge[1:-1] = solid[:-1] & (~solid[1:])
            edge[-1] = solid[-1]
            shut = inner[(inner > 0)]
            edge[shut] |= solid[shut - 1]
            edge[0] = False
            stop = np.flatnonzero(edge)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(table[part] * _powers(_BASE, hi - lo), out=total[1:])
            h = (total[stop] - total[start]) * _powers(_BASE_INVERSE, hi - lo)[start]
            hashes.append(mix(h ^ (stop - start).astype(np.uint64)))
            if spans:
                begins.append(start + lo)
                ends.append(stop + lo)
            counts[a + 1 : b + 1] = np.diff(np.searchsorted(start, np.append(0, offsets[a + 1 : b + 1] - lo)))
        a = b
    out = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    before = np.cumsum(counts)
    if not spans:
        return out, before
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return out, before, cat(begins), cat(ends), raw


def pack(x: np.ndarray, width: int = 4) -> bytes:
    """Unsigned integers below 2^(8 * width) as compressed byte planes."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, width: int = 4) -> np.ndarray:
    """Inverse of :func:`pack`, as uint64."""
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def in_runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
