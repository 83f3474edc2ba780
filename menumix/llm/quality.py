"""Operator 4: quality scores from random-indexing word vectors and a small calibrated network."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.frames import crc32_mod, small_batches, trimmed
from menumix.llm.words import Words, mix, slices, words_of
from menumix.session import materialise

BUCKET_BITS = 15
SHAPES = 1 << 10
DIMS = 32
MARKS = 4  # non-zero entries of a random index vector
REACH = 2  # neighbours on each side
SAMPLE_TASKS = 4
PIECE = 1 << 19  # bytes of text worked on at once: every word takes a few hundred bytes of vectors meanwhile
CLASS = np.full(256, 3, np.uint8)  # 0 upper, 1 lower and all letters beyond ASCII, 2 digit, 3 sign
CLASS[ord("A"):ord("Z") + 1] = 0
CLASS[ord("a"):ord("z") + 1] = 1
CLASS[0x80:] = 1
CLASS[ord("0"):ord("9") + 1] = 2
SIZE = (1 << BUCKET_BITS) + SHAPES


def index_vectors(seed: int = 4) -> np.ndarray:
    """The sparse ternary index vector of every word bucket and shape, from a rule."""
    draw = np.random.default_rng(seed)
    out = np.zeros((SIZE, DIMS), np.int8)
    for _ in range(MARKS):
        out[np.arange(SIZE), draw.integers(0, DIMS, SIZE)] = draw.choice(np.array([-1, 1], np.int8), SIZE)
    return out


def _class_counts(w: Words) -> list[np.ndarray]:
    kinds = CLASS[w.data]
    return [np.diff(np.concatenate([[0], np.cumsum(kinds == c)])[np.stack([w.starts, w.ends])], axis=0)[0] for c in range(4)]


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Word bucket and shape of each word, word bounds of the texts, class counts.

    Words lose their case for the bucket; case, digits, signs, length and whether
    the word repeats the one before make up its shape."""
    w = words_of(texts)
    plain = words_of(texts, lower=True).hashes()
    bucket = (plain >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    upper, lower, digit, sign = counts = _class_counts(w)
    again = np.zeros(len(plain), bool)
    again[1:] = plain[1:] == plain[:-1]
    inner = np.zeros(len(plain) + 1, bool)
    inner[w.bounds[:-1]] = True
    again &= ~inner[:-1]
    shape = (np.minimum(upper, 2) + 3 * (lower > 0) + 6 * (digit > 0) + 12 * np.minimum(sign, 3) + 48 * np.minimum((w.ends - w.starts) // 4, 5) + 288 * again).astype(np.int64)
    return bucket, shape + (1 << BUCKET_BITS), w.bounds, counts


def context_sums(texts: pa.Array, index: np.ndarray, into: np.ndarray) -> None:
    """Add to each word's and shape's row the index vectors of its neighbours in the same text."""
    bucket, shape, bounds, _ = terms(texts)
    n = len(bucket)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    marks = index[bucket].astype(np.float32) + index[shape]
    near = np.zeros((n, DIMS), np.float32)
    for k in range(1, REACH + 1):
        same = (doc[k:] == doc[:-k])[:, None]
        near[k:] += np.where(same, marks[:-k], 0)
        near[:-k] += np.where(same, marks[k:], 0)
    for at in (bucket, shape):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        if len(first):
            into[at[order][first]] += np.add.reduceat(near[order], first, axis=0)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors plus a part of the own index vector, which alone stands for unseen words."""
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(size, 1e-9) + 0.5 * index_vectors() / np.sqrt(MARKS)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean word vector, mean shape vector, their norms and a few shares; zeros for a text without words."""
    bucket, shape, bounds, counts = terms(texts)
    n = np.diff(bounds)
    out = np.zeros((len(n), 2 * DIMS + 9), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        first, size = bounds[:-1][full], n[full][:, None].astype(np.float32)
        means = [np.add.reduceat(vectors[at], first, axis=0) / size for at in (bucket, shape)]
        key = np.repeat(np.arange(len(n)), n) * (1 << BUCKET_BITS) + bucket
        kinds = np.bincount(np.unique(key) >> BUCKET_BITS, minlength=len(n))[full]
        letters = sum(counts)
        shares = [np.add.reduceat(c, first) / np.add.reduceat(letters, first) for c in counts]
        rest = [np.linalg.norm(means[0], axis=1), np.linalg.norm(means[1], axis=1), np.log1p(n[full]), kinds / n[full], np.add.reduceat(letters, first) / n[full] / 8, *shares]
        out[full] = np.concatenate([*means, np.stack(rest, axis=1)], axis=1)
    return out


@dataclass
class Network:
    """Two layers on standardised features, a temperature on top."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return (np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ a + b) @ c + d)[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x).astype(np.float64) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 4, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature minimises
    the log loss of the last fifth. Rows must come in a fixed order."""
    draw = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    parts = [draw.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden), draw.standard_normal((hidden, 1)) / np.sqrt(hidden), np.zeros(1)]
    net = Network(vectors, mean, scale, [p.astype(np.float32) for p in parts], 1.0)
    held = np.arange(len(y)) % 5 == 4
    a, b = np.clip((x[~held] - mean) / scale, -8, 8).astype(np.float32), y[~held].astype(np.float32)
    first = [np.zeros_like(p) for p in net.layers]
    second = [np.zeros_like(p) for p in net.layers]
    step, size = 0, 128
    for epoch in range(epochs):
        order = draw.permutation(len(b))
        for at in range(0, len(order), size):
            rows = order[at:at + size]
            xs, (w, c, v, d) = a[rows], net.layers
            inner = np.tanh(xs @ w + c)
            slope = ((_sigmoid((inner @ v + d)[:, 0]) - b[rows]) / len(rows))[:, None].astype(np.float32)
            back = (slope @ v.T) * (1 - inner * inner)
            step += 1
            for k, g in enumerate([xs.T @ back + decay * w, back.sum(axis=0), inner.T @ slope + decay * v, slope.sum(axis=0)]):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.layers[k] = (net.layers[k] - rate * (0.97 ** epoch) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    if held.any():
        z, t = net.logits(x[held]).astype(np.float64), y[held]
        grid = np.geomspace(0.25, 8, 61)
        loss = [-np.mean(np.log(np.clip(np.where(t == 1, _sigmoid(z / g), _sigmoid(-z / g)), 1e-12, 1))) for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = 8000) -> Network | None:
    """Learn from at most ``most_rows`` labelled texts, chosen by the id's hash.

    The bound covers all of the fit: word vectors and network learn from the
    same texts. It also bounds what the driver holds: four partial sums of the
    word vectors and one feature row a text. Labels other than 0 and 1 and
    texts without label are left out; an id with several labels takes the
    largest, of rows that share an id the least text counts alone. None without any labelled text.
    """
    small_batches(docs.sparkSession)
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
    rows = materialise(rows.repartition(SAMPLE_TASKS, "_id").sortWithinPartitions("_id", "_text"), "quality_sample")  # most_rows pairs of integers

    def learn(batches):
        index, sums = index_vectors(), np.zeros((SIZE, DIMS), np.float32)
        for batch in batches:
            for a, b in slices(batch.column(0), PIECE):
                context_sums(batch.column(0).slice(a, b - a), index, sums)
        yield pa.RecordBatch.from_pydict({"sums": [zstandard.ZstdCompressor(level=1).compress(sums.tobytes())]})

    sums = np.zeros((SIZE, DIMS), np.float32)
    for (part,) in rows.select("_text").coalesce(SAMPLE_TASKS).mapInArrow(trimmed(learn), "sums binary").toLocalIterator():
        sums += np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(part)), np.float32).reshape(SIZE, DIMS)
    vectors = word_vectors(sums)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)  # (2^15 + 2^10) x 32 floats: 4.3 MB, whatever the input

    def features(batches):
        for batch in batches:
            for a, b in slices(batch.column(2), PIECE):
                found = pooled(batch.column(2).slice(a, b - a), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([r.tobytes() for r in found], pa.binary())], names=["id", "y", "x"])

    got = sorted(rows.select("_id", "_y", "_text").mapInArrow(trimmed(features), "id long, y int, x binary").collect(), key=lambda r: (r[0], bytes(r[2])))
    if not got:
        return None
    order = np.argsort(mix(np.arange(len(got), dtype=np.uint64)), kind="stable")
    x = np.stack([np.frombuffer(bytes(r[2]), np.float32) for r in got])[order]
    return train(x, np.array([r[1] for r in got])[order], vectors)


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row from its whole text; 0.5 for all without a network.

    Null text counts as empty; texts without words all get one score. Rows are
    scored one by one, so repeated rows and ids stay.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if net is None:
        return rows.select("id", F.lit(0.5).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((net.vectors, net.mean, net.scale, net.layers, net.temperature))

    def run(batches):
        net = Network(*sent.value)
        for batch in batches:
            for a, b in slices(batch.column(1), PIECE):
                found = net.scores(pooled(batch.column(1).slice(a, b - a), net.vectors))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found, pa.float64())], names=["id", "score"])

    return rows.mapInArrow(trimmed(run), "id long, score double")


def keep(docs: DataFrame, net: Network | None, text_col: str = "text", least: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose texts score at least ``least``; all rows without a network."""
    if net is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast((net.vectors, net.mean, net.scale, net.layers, net.temperature))
    place = docs.columns.index(text_col)

    def run(batches):
        net = Network(*sent.value)
        for batch in batches:
            texts = batch.column(place)
            for a, b in slices(texts, PIECE):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(net.scores(pooled(part.column(place), net.vectors)) >= least))

    return docs.mapInArrow(trimmed(run), docs.schema)


def held_out(column: str) -> Column:
    return crc32_mod(column, 4) == 2


def learn_from_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network | None:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~held_out("doc_id"))
    return fit(docs, labels)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = score(docs, learn_from_tables(spark, docs, sf_dir))
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
