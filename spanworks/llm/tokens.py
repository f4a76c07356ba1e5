"""Vectorised word splitting and hashing over Arrow batches.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; all separators are
ASCII, so working on the UTF-8 bytes gives the same words as working on the
decoded text.  A whole Arrow batch is handled with a fixed number of numpy calls,
never one call per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once.  Its arrays take about twenty times as much.
STEP_BYTES = 1_000_000

_MULT, _MULT2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PRIME = np.uint64(0x100000001B3)
_SEED = np.uint64(0xCBF29CE484222325)
_LONG = 48  # words of more bytes are hashed one by one

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A finalising permutation of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def mix_int(x: int) -> int:
    """``mix`` of one Python integer."""
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])


def steps(batch: pa.RecordBatch, column: int, limit: int | None = None, rows: int = 4096) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a batch, each with its first row, that hold at most ``limit`` bytes in ``column``.

    A row that is larger than the limit is a slice of its own; no slice has more than ``rows`` rows.
    """
    limit = STEP_BYTES if limit is None else limit
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < batch.num_rows:
        to = min(max(at + 1, int(np.searchsorted(ends, done + limit, side="right"))), at + rows, batch.num_rows)
        yield at, batch.slice(at, to - at)
        at, done = to, int(ends[to - 1])


@dataclass
class Words:
    """The words of a batch: byte ranges in ``buf``, hashes, and ``first[i]:first[i+1]`` per text."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary array and each text's offset; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def split_words(texts: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    """Split every text of a batch; ``lower`` maps A-Z to a-z first."""
    buf, off = _bytes_of(texts)
    if lower:
        buf = _LOWER[buf]
    inside = _WORD[buf]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]  # texts that touch must not share a word
    opens[edge] |= inside[edge]
    closes[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, off)
    return Words(buf, start, end, hash_ranges(buf, start, end) if hashed else np.zeros(0, np.uint64), first)


def hash_ranges(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes, equal hashes."""
    length = end - start
    h = np.full(len(start), _SEED)
    order = np.argsort(-np.minimum(length, _LONG + 1), kind="stable")
    ordered, live = start[order], length[order]
    acc = h[order]
    top = int(min(live[0], _LONG)) if len(live) else 0
    # live is descending up to the cap, so the words with more than j bytes are a prefix
    neg = -np.minimum(live, _LONG + 1)
    for j in range(top):
        n = int(np.searchsorted(neg, -j, side="left"))
        acc[:n] = (acc[:n] ^ buf[ordered[:n] + j]) * _PRIME
    h[order] = mix(acc + length[order].astype(np.uint64) * _MULT)
    for i in np.flatnonzero(length > _LONG):
        h[i] = np.frombuffer(hashlib.blake2b(buf[start[i] : end[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    return h


def windows(words: Words, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one text, and the word index each starts at."""
    h = words.hash if hashes is None else hashes
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = (acc ^ h[j : j + n]) * _MULT
        acc ^= acc >> np.uint64(29)
    text = np.repeat(np.arange(len(words.first) - 1), words.counts)
    whole = text[:n] == text[k - 1 :]
    return mix(acc[whole]), np.flatnonzero(whole)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two, in their order."""
    h = left * _MULT + right * _MULT2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


def long_windows(words: Words, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Like :func:`windows`, for several sizes: runs are put together from runs of 1, 2, 4, ... words."""
    powers, k = {1: words.hash}, 1
    while 2 * k <= max(sizes):
        h = powers[k]
        powers[2 * k] = _pair(h[:-k], h[k:]) if len(h) > k else h[:0]
        k *= 2
    text = np.repeat(np.arange(len(words.first) - 1), words.counts)
    out = []
    for size in sizes:
        n = len(words.hash) - size + 1
        if n <= 0:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            continue
        acc, at = None, 0
        for k in sorted(powers, reverse=True):
            if size & k:
                part = powers[k][at : at + n]
                acc, at = part if acc is None else _pair(acc, part), at + k
        whole = text[:n] == text[size - 1 :]
        out.append((mix(acc[whole]), np.flatnonzero(whole)))
    return out


def first_least(values: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """For each index in ``at`` that of the least of the ``width`` values from there on, the first of equals."""
    best, k = np.arange(len(values)), 1
    while 2 * k <= width:
        left, right = best[:-k], best[k:]
        best = np.where(values[right] < values[left], right, left)
        k *= 2
    left, right = best[at], best[at + width - k]
    return np.where(values[right] < values[left], right, left)
