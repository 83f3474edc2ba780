"""Vectorised word spans and word hashes over Arrow text columns.

A word is a maximal run of bytes other than space and 0x09-0x0D. Everything
works on the byte buffer of a whole slice of texts at once; nothing loops over
words in Python, except for words longer than 64 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
SLICE_BYTES = 2 << 20
LANE_BYTES = 64
WORDS = r"[^\x20\x09-\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Words:
    """Words of consecutive texts: ``starts``/``ends`` are byte positions in
    ``data``; text i owns words ``bounds[i]`` to ``bounds[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        out = mix(size.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64))
        left, at, who = size.copy(), self.starts.copy(), np.arange(len(size))
        for _ in range(LANE_BYTES // 8):
            if not len(who):
                break
            lane = lanes[at] & KEEP[np.minimum(left, 8)]
            out[who] = mix(out[who] ^ (lane * np.uint64(0x9E3779B97F4A7C15)))
            more = left > 8
            who, at, left = who[more], at[more] + 8, left[more] - 8
        for i in np.flatnonzero(size > LANE_BYTES):
            whole = hashlib.blake2b(self.data[self.starts[i]:self.ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
            out[i] = int.from_bytes(whole.digest(), "little")
        return out


def words_of(texts: pa.Array, lower: bool = False, stops: np.ndarray = SPACE) -> Words:
    """Words of an Arrow string array; null counts as empty. ``stops`` marks the bytes that no word holds."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[first:last] if buffer is not None and last > first else np.zeros(0, np.uint8)
    if lower:
        data = LOWER[data]
    inside = ~stops[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets - first] = True
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:] = ~inside[:-1] | edge[1:-1]
        after[:-1] = ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets - first))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` text bytes, a longer text by itself."""
    sizes = np.cumsum(pa.compute.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield begin, end
        begin = end


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words (fewer words: one run of all)."""
    n = min(n, len(hashes))
    if not n:
        return np.zeros(0, np.uint64)
    runs = len(hashes) - n + 1
    out = mix(hashes[:runs] + np.uint64(n))
    for k in range(1, n):
        out = mix(out * np.uint64(0x9DDFEA08EB382D69) ^ hashes[k:k + runs])
    return out
