"""Operator 7: remove repeated word windows; a count-min prefilter leaves few windows to group exactly."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.arrays import PACKED, Mapped, by_shard, packed_rows, save, shard_bits, shards, shared_dir
from menumix.llm.words import mix, slices, words_of

CHUNK = 3_000_000
ROWS = 2
LOAD = 4
LAST_ID = np.int64(2**63 - 1)
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(base), -1, 2**64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), b, np.uint64)])) for b in (base, inverse))


def window_hashes(hashes: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Hash of each run of ``width`` word hashes, by differences of prefix sums modulo 2^64."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(hashes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up)])
    return mix((sums[width:] - sums[:-width]) * down[:len(hashes) - width + 1])


class Windows:
    """All windows of a slice of texts that lie in one text."""

    def __init__(self, texts: pa.Array, width: int):
        self.words, self.width = words_of(texts), width
        self.first = self.words.hashes()
        sizes = np.diff(self.words.bounds)
        runs = np.maximum(sizes - width + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), runs)
        self.start = np.arange(len(self.doc)) - np.repeat(np.cumsum(runs) - runs, runs)
        self.at = self.words.bounds[:-1][self.doc] + self.start
        self.hash = window_hashes(self.first, width, BASES[0])[self.at]

    def second(self, chosen: np.ndarray) -> np.ndarray:
        """An independent hash of chosen windows, from other word hashes."""
        return window_hashes(self.words.hashes(seed=1), self.width, BASES[1])[self.at[chosen]]


def slots(hashes: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    """Slot of a sketch row, in the top bits."""
    moved = hashes if row == 0 else mix(hashes ^ np.uint64(0xA0761D6478BD642F * row % 2**64))
    return moved & ~np.uint64(2 ** (64 - width_bits) - 1)


class Repeated:
    """Merged count-min rows, reduced to one bit a slot: was it hit twice?"""

    def __init__(self, folder: str, width_bits: int, bits: int):
        self.folder, self.width_bits, self.bits, self.open = folder, width_bits, bits, {}

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = np.arange(len(hashes))
        for row in range(ROWS):
            slot = slots(hashes[found], row, self.width_bits) >> np.uint64(64 - self.width_bits)
            shard = (slot >> np.uint64(self.width_bits - self.bits)).astype(np.int64)
            inside = (slot & np.uint64(2 ** (self.width_bits - self.bits) - 1)).astype(np.int64)
            hit = np.zeros(len(found), dtype=bool)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange((1 << self.bits) + 1))
            for s in range(1 << self.bits):
                who = order[cuts[s]:cuts[s + 1]]
                held = self._row(row, s) if len(who) else None
                if held is not None:
                    hit[who] = (held[inside[who] >> 3] >> (inside[who] & 7).astype(np.uint8)) & 1
            found = found[hit]
        return found

    def _row(self, row: int, shard: int) -> np.ndarray | None:
        if (row, shard) not in self.open:
            path = f"{self.folder}/sketch{row}.{shard:05d}.npy"
            self.open[row, shard] = np.load(path, mmap_mode="r") if os.path.exists(path) else None  # none: no window hit it
        return self.open[row, shard]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, text): every text without the words
    of windows that also start earlier (smaller id, or same id and earlier start).

    Pass 1 counts windows in a count-min sketch: each task sends its slots, and
    merged slots never count too little. Pass 2 groups exactly, by 128 bits,
    only windows whose slots were all hit twice, so none is lost; a task sends
    one row for each different window, however often it has it. Pass 3 removes.
    Sketch and repeated windows are memory-mapped shards that grow with the
    input. ``kept`` words are joined by one space.

    Null text has no words; texts shorter than a window stay whole. A null id
    counts as larger than any. Rows that share an id share their positions, so
    a window of one is not earlier than the same start of the other. An empty table gives an empty result.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = max(int(size) // 6, 1)
    bits = shard_bits(expected)
    width_bits = max(bits + 6, (LOAD * expected - 1).bit_length())
    folder = shared_dir(spark, "substring_dedup")

    def ids_of(batch):
        return batch.column(0).fill_null(int(LAST_ID)).to_numpy(zero_copy_only=False)

    def sketch(batches):
        def flush(held):
            hashes = np.concatenate(held)
            for row in range(ROWS):
                moved = np.sort(slots(hashes, row, width_bits))
                first = np.flatnonzero(np.concatenate([[True], moved[1:] != moved[:-1]]))
                count = np.minimum(np.diff(np.append(first, len(moved))), 2).astype(np.uint8)
                rows = packed_rows([moved[first], count], bits)
                yield pa.RecordBatch.from_arrays([pa.compute.add(rows.column(0), pa.scalar(row << bits, pa.int32())), rows.column(1)], names=["shard", "payload"])

        held, total = [], 0
        for batch in batches:
            for a, b in slices(batch.column(1)):
                held.append(Windows(batch.column(1).slice(a, b - a), width).hash)
                total += len(held[-1])
                if total >= CHUNK:
                    yield from flush(held)
                    held, total = [], 0
        if total:
            yield from flush(held)

    def merge(batches):
        for shard, runs in shards(batches):
            row, shard = shard >> bits, shard & ((1 << bits) - 1)
            held = np.zeros(1 << (width_bits - bits), np.uint8)
            for key, n in runs:
                at = ((key >> np.uint64(64 - width_bits)) & np.uint64(2 ** (width_bits - bits) - 1)).astype(np.int64)
                held[at] = np.minimum(held[at] + n, 2)
            save(folder, f"sketch{row}", shard, np.packbits(held >= 2, bitorder="little"))
            yield pa.RecordBatch.from_pydict({"shards": [1]})

    by_shard(docs.mapInArrow(sketch, PACKED)).mapInArrow(merge, "shards long").agg(F.sum("shards")).first()
    def group(batches):
        def flush(held):
            key, other, doc, start = map(np.concatenate, zip(*held))
            order = np.lexsort((start, doc, other, key))
            key, other, doc, start = key[order], other[order], doc[order], start[order]
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (other[1:] != other[:-1])]))
            many = np.diff(np.append(first, len(key))) > 1
            yield packed_rows([key[first], other[first], doc[first], start[first].astype(np.int32), many.astype(np.uint8)], bits)

        repeated, held, total = Repeated(folder, width_bits, bits), [], 0
        for batch in batches:
            ids = ids_of(batch)
            for a, b in slices(batch.column(1)):
                w = Windows(batch.column(1).slice(a, b - a), width)
                chosen = repeated(w.hash)
                if len(chosen):
                    held.append((w.hash[chosen], w.second(chosen), ids[a:b][w.doc[chosen]], w.start[chosen]))
                    total += len(chosen)
                if total >= CHUNK:
                    yield from flush(held)
                    held, total = [], 0
        if total:
            yield from flush(held)

    def settle(batches):
        for shard, runs in shards(batches):
            key, other, doc, start, many = map(np.concatenate, zip(*runs))
            order = np.lexsort((start, doc, other, key))
            key, other, doc, start, many = key[order], other[order], doc[order], start[order], many[order]
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (other[1:] != other[:-1])]))
            size = np.diff(np.append(first, len(key)))
            first = first[(size > 1) | (many[first] > 0)]
            for name, values in (("window_other", other), ("window_doc", doc), ("window_start", start), ("window_key", key)):
                save(folder, name, shard, values[first])
            yield pa.RecordBatch.from_pydict({"shards": [len(first)]})

    by_shard(docs.mapInArrow(group, PACKED)).mapInArrow(settle, "shards long").agg(F.sum("shards")).first()

    def remove(batches):
        repeated = Repeated(folder, width_bits, bits)
        known = Mapped(folder, "window_key", ["window_other", "window_doc", "window_start"], bits)
        for batch in batches:
            ids, texts = ids_of(batch), batch.column(1).fill_null("")
            for a, b in slices(texts):
                part = texts.slice(a, b - a)
                w = Windows(part, width)
                chosen = repeated(w.hash)
                found, other, doc, start = known.lookup(w.hash[chosen])
                mine = ids[a:b][w.doc[chosen]]
                gone = found & ((doc != mine) | (start != w.start[chosen]))
                if found.any():
                    gone &= other.astype(np.uint64) == w.second(chosen)
                cover = np.zeros(len(w.first) + 1, np.int32)
                at = w.at[chosen[gone]]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + width, -1)
                cover = np.cumsum(cover)[:-1] > 0
                bounds = w.words.bounds
                counts = np.concatenate([[0], np.cumsum(cover)])
                removed = counts[bounds[1:]] - counts[bounds[:-1]]
                kept = []
                for i, text in enumerate(part.to_pylist()):
                    words = text.encode().split()
                    if removed[i]:
                        words = [x for x, c in zip(words, cover[bounds[i]:bounds[i + 1]].tolist()) if not c]
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)), pa.array(removed),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode() if with_text else None for k in kept], pa.string()),
                ], names=["id", "n_words", "n_removed", "kept_sha256", "text"])

    return docs.mapInArrow(remove, "id long, n_words long, n_removed long, kept_sha256 string, text string")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, with_text=False).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
