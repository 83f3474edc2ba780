"""Operator 13: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.frames import crc32_mod
from menumix.llm.words import mix, slices, words_of
from menumix.session import materialise

BITS = 22
NGRAMS = 2  # longest run of neighbouring words
SKIPS = 2  # most words left out between the two of a skip-gram
# Bytes that may stand around a word and are no part of it: ASCII signs and controls.
EDGE = np.zeros(256, dtype=bool)
EDGE[:0x30] = EDGE[0x3A:0x41] = EDGE[0x5B:0x61] = EDGE[0x7B:0x80] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word, n-gram and skip-gram: words are lower-cased (A-Z) runs without
    ASCII signs and white space; a pair's bucket also depends on how many words lie between."""
    w = words_of(texts, lower=True, stops=EDGE)
    hashes, row = w.hashes(seed=13), np.repeat(np.arange(len(texts)), np.diff(w.bounds))
    rows, found = [row], [hashes]
    run = hashes
    for k in range(1, NGRAMS):
        run = mix(run[:-1] * np.uint64(0x9DDFEA08EB382D69) ^ hashes[k:])
        same = row[k:] == row[:-k]
        rows.append(row[k:][same])
        found.append(run[same])
    for gap in range(2, SKIPS + 2):
        same = row[gap:] == row[:-gap]
        rows.append(row[gap:][same])
        found.append(mix((hashes[:-gap] + np.uint64(gap)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ hashes[gap:])[same])
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Weights:
    """What L1 leaves: few buckets with their weights, sorted, and the bias."""

    buckets: np.ndarray
    values: np.ndarray
    bias: float

    def scores(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        """Each weighted bucket of a text counts once; ``table`` is ``dense()``."""
        row, bucket = terms(texts)
        some = table[bucket] != 0
        pairs = np.unique((row[some] << BITS) | bucket[some])
        sums = np.bincount(pairs >> BITS, weights=table[pairs & ((1 << BITS) - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -35, 35)))

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.buckets] = self.values
        return table


def train(rows: list[np.ndarray], y: np.ndarray, epochs: int = 6, alpha: float = 2.0, beta: float = 1.0, l1: float = 25.0, l2: float = 1.0,
          positive: float = 2.0, seed: int = 13) -> Weights:
    """FTRL-proximal over rows of distinct buckets, in an order that the seed fixes.

    A coordinate's rate is alpha / (beta + root of its summed squared gradients); its
    weight is zero while the summed gradients stay within ``l1``. Rows of label 1 are the
    rarer ones and count ``positive`` times."""
    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    bias_z = bias_n = 0.0
    draw = np.random.default_rng(seed)

    def weights(zs, ns):
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for i in draw.permutation(len(y)):
            at = rows[i]
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            bias = -bias_z * alpha / (beta + np.sqrt(bias_n))  # no L1, L2 on the bias
            g = (1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y[i]) * (positive if y[i] else 1.0)
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
    w = weights(z, n)
    kept = np.flatnonzero(w)
    return Weights(kept, w[kept], float(-bias_z * alpha / (beta + np.sqrt(bias_n))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = 12000) -> Weights | None:
    """Learn from at most ``most_rows`` labelled texts, chosen by a hash of id and text.

    The bound counts different pairs of id and text, so also many rows that share an id
    stay within it; it bounds what the driver holds, one list of buckets a text. Labels other than 0 and 1 and texts without label are
    left out; an id with several labels takes the largest. None without any labelled text.
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_id", "_text"))
    chosen = rows.select("_id", "_hash").join(marked, "_id").distinct().orderBy("_hash", "_id").limit(most_rows)
    chosen = materialise(chosen, "toxicity_sample")
    texts = rows.join(chosen, ["_id", "_hash"]).groupBy("_id", "_hash", "_y").agg(F.any_value("_text").alias("_text"))

    def features(batches):
        for batch in batches:
            for a, b in slices(batch.column(3)):
                row, bucket = terms(batch.column(3).slice(a, b - a))
                pairs = np.unique((row << BITS) | bucket)
                cuts = np.searchsorted(pairs, np.arange(b - a + 1) << BITS)
                found = (pairs & ((1 << BITS) - 1)).astype(np.int32)
                packed = [found[cuts[i]:cuts[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(a, b - a) for i in range(3)], pa.array(packed, pa.binary())], names=["id", "hash", "y", "x"])

    # Written, then read part by part: the driver holds the lists once, as arrays.
    found = materialise(texts.mapInArrow(features, "id long, hash long, y int, x binary"), "toxicity_features")
    got = sorted(((r[1], r[0], r[2], np.frombuffer(bytes(r[3]), np.int32)) for r in found.toLocalIterator()), key=lambda r: r[:2])
    return train([r[3] for r in got], np.array([r[2] for r in got])) if got else None


def score(docs: DataFrame, weights: Weights | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row from its whole text; 0.5 for all without weights.

    Null text counts as empty; texts without words all get the score of the bias. Rows are
    scored one by one, so repeated rows, ids and null ids stay. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if weights is None:
        return rows.select("id", F.lit(0.5).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(weights.__dict__)  # the weights that L1 left, 2^22 at most

    def run(batches):
        held = Weights(**sent.value)
        table = held.dense()
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = held.scores(batch.column(1).slice(a, b - a), table)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found, pa.float64())], names=["id", "score"])

    return rows.mapInArrow(run, "id long, score double")


def held_out(column: str) -> Column:
    return crc32_mod(column, 5) == 0


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out("doc_id"))
    found = score(docs, fit(docs, labels))
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
