"""Bloom filters built by Spark in segments and probed for whole batches.

Keys are 64-bit hashes.  The high bits name a segment; each segment is built by one
task from its own keys and has its own size, so that the filter is as full in one
place as in another.  The filter is a plain array that can be broadcast; its size is
set beforehand by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from spanworks.llm.tokens import mix

_LEVEL = np.uint64(0xD6E8FEB86659FD93)


def segment_of(h: np.ndarray, log_segments: int) -> np.ndarray:
    return (h >> np.uint64(64 - log_segments)).astype(np.int32) if log_segments else np.zeros(len(h), np.int32)


def places(h: np.ndarray, level: np.ndarray | int, k: int, size: np.ndarray | int) -> np.ndarray:
    """Bit positions of (key, level), ``k`` rows: double hashing from one mixed value."""
    a = mix(h + np.asarray(level).astype(np.uint64) * _LEVEL)
    step = (a >> np.uint64(32)) | np.uint64(1)
    low = a & np.uint64(0xFFFFFFFF)
    return np.stack([((low + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * np.asarray(size, np.uint64) >> np.uint64(32) for i in range(k)])


def build(h: np.ndarray, levels: np.ndarray, k: int, size: int) -> bytes:
    """The bits of one segment that holds levels 1 to ``levels`` of each key; ``size`` bits, below 2**32."""
    bits = np.zeros(-(-size // 8) * 8, np.uint8)
    for j in range(1, int(levels.max(initial=0)) + 1):
        bits[places(h[levels >= j], j, k, size).ravel()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Filter:
    """Segments put together: the bits, and each segment's first byte and size in bits."""

    data: np.ndarray
    base: np.ndarray
    size: np.ndarray
    log_segments: int
    k: int

    @classmethod
    def of(cls, parts: pa.Table, log_segments: int, k: int) -> Filter:
        """From ``segment``, ``size`` (bits) and ``data`` in any order; absent segments are empty."""
        n = 1 << log_segments
        base, size = np.zeros(n, np.int64), np.zeros(n, np.uint64)
        whole = np.zeros(sum(len(x.as_buffer()) for x in parts.column("data")) + 1, np.uint8)
        at = 0
        for seg, bits, data in zip(parts.column("segment").to_pylist(), parts.column("size").to_pylist(), parts.column("data")):
            raw = np.frombuffer(data.as_buffer(), np.uint8)
            base[seg], size[seg] = at, bits
            whole[at : at + len(raw)] = raw
            at += len(raw)
        return cls(whole, base, size, log_segments, k)

    def has(self, h: np.ndarray, level: int) -> np.ndarray:
        """Whether each key may hold the level; never false for one that does."""
        seg = segment_of(h, self.log_segments)
        size, base = self.size[seg], self.base[seg]
        hit = size > 0
        for p in places(h, level, self.k, size):
            hit &= (self.data[base + (p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return hit

    def levels(self, h: np.ndarray, most: int) -> np.ndarray:
        """The highest level reached by probing 1, 2, ... until a miss."""
        out = np.zeros(len(h), np.int8)
        live = np.arange(len(h))
        for j in range(1, most + 1):
            live = live[self.has(h[live], j)]
            if not len(live):
                break
            out[live] = j
        return out
