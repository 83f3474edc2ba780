"""Sorted hash arrays in the shared folder, and the packed rows that build them.

Tasks exchange sorted runs of 64-bit keys with values as packed rows (shard,
payload): one row per task and shard, compressed, so that Spark shuffles a few
large rows and no row per key. A shard is the key's top bits, hence the shards
in order make one sorted array. Each merged shard is written under a temporary
name and renamed, so a repeated task only replaces a file by its equal.
Readers memory-map the files: the shared folder must be a mounted path
(``file:`` or no scheme), as every executor has to see it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from menumix.session import scratch_path

PACKED = "shard int, payload binary"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir as a local path of every executor."""
    path = scratch_path(spark, name)
    scheme, _, rest = path.rpartition("://") if "://" in path else path.partition(":") if path.startswith("file:") else ("file", "", path)
    if scheme not in ("file", ""):
        raise ValueError(f"memory-mapped arrays need a mounted shared folder, not {path}")
    path = "/" + rest.lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def shard_bits(rows: int, per_shard: int = 4_000_000) -> int:
    """Bits such that a shard of evenly spread keys holds about ``per_shard``."""
    return max(3, (max(rows, 1) // per_shard).bit_length())


def pack(columns: list[np.ndarray]) -> bytes:
    """Sorted keys first; they are stored as differences."""
    key = columns[0]
    parts = [np.diff(key, prepend=key.dtype.type(0)), *columns[1:]]
    out = [np.array([len(key), len(parts)], dtype=np.int64).tobytes()]
    for p in parts:
        planes = np.ascontiguousarray(p).view(np.uint8).reshape(len(p), p.dtype.itemsize).T.tobytes() if len(p) else b""
        out += [p.dtype.str.encode().ljust(8), planes]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, width = np.frombuffer(raw, np.int64, 2)
    at, out = 16, []
    for _ in range(width):
        kind = np.dtype(raw[at:at + 8].decode().strip())
        at += 8
        size = int(n) * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, int(n))
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(int(n)))
        at += size
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def packed_rows(columns: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Split columns sorted by their first, a uint64 key, into packed shards."""
    cuts = np.searchsorted(columns[0], np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.concatenate([[0], cuts, [len(columns[0])]])
    full = [s for s in range(1 << bits) if cuts[s + 1] > cuts[s]]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([pack([c[cuts[s]:cuts[s + 1]] for c in columns]) for s in full], pa.binary())],
        names=["shard", "payload"])


def group_sum(keys: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]]


def by_shard(packed: DataFrame) -> DataFrame:
    """Rows of a shard together and in order; shards spread by range, two a task or so."""
    return packed.repartition("shard").sortWithinPartitions("shard")


def shards(batches) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """(shard, runs) of a task whose rows are ordered by shard."""
    current, runs = None, []
    for batch in batches:
        for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if shard != current and runs:
                yield current, runs
                runs = []
            current = shard
            runs.append(unpack(payload))
    if runs:
        yield current, runs


def save(folder: str, name: str, shard: int, values: np.ndarray) -> None:
    path = os.path.join(folder, f"{name}.{shard:05d}.npy")
    held = f"{path}.{uuid.uuid4().hex}"
    with open(held, "wb") as f:
        np.save(f, values)
    os.replace(held, path)


class Mapped:
    """Sorted arrays of all shards, memory-mapped on first use."""

    def __init__(self, folder: str, key: str, values: list[str], bits: int):
        self.folder, self.key, self.values, self.bits, self.open = folder, key, values, bits, {}

    def _shard(self, shard: int) -> list[np.ndarray] | None:
        if shard not in self.open:
            paths = [os.path.join(self.folder, f"{n}.{shard:05d}.npy") for n in [self.key, *self.values]]
            self.open[shard] = [np.load(p, mmap_mode="r") for p in paths] if os.path.exists(paths[0]) else None
        return self.open[shard]

    def lookup(self, keys: np.ndarray) -> list[np.ndarray]:
        """Found flag and values of each key; keys need no order. Values of
        missing keys are 0."""
        sought, back = np.unique(keys, return_inverse=True)
        found = np.zeros(len(sought), dtype=bool)
        out: list[np.ndarray | None] = [None] * len(self.values)
        cuts = np.searchsorted(sought, np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        cuts = np.concatenate([[0], cuts, [len(sought)]])
        for s in range(1 << self.bits):
            a, b = cuts[s], cuts[s + 1]
            held = self._shard(s) if b > a else None
            if held is None or not len(held[0]):
                continue
            at = np.minimum(np.searchsorted(held[0], sought[a:b]), len(held[0]) - 1)
            hit = held[0][at] == sought[a:b]
            found[a:b] = hit
            for i, v in enumerate(held[1:]):
                if out[i] is None:
                    out[i] = np.zeros(len(sought), dtype=v.dtype)
                out[i][a:b] = np.where(hit, v[at], 0)
        return [found[back], *[(np.zeros(len(sought)) if o is None else o)[back] for o in out]]
