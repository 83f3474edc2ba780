"""Operator 6: interpolated modified Kneser-Ney bigram model over sorted, memory-mapped hash """

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.arrays import PACKED, Mapped, by_shard, group_sum, packed_rows, save, shard_bits, shards, shared_dir
from menumix.llm.frames import crc32_mod
from menumix.llm.words import mix, slices, words_of

BEGIN, END = np.uint64(0xB5AD4ECEDA1CE2A9), np.uint64(0x243F6A8885A308D3)
CHUNK = 3_000_000
BIGRAMS, WORDS_TABLE = 0, 1
STATS = "kind int, types long, total double, n1 long, n2 long, n3 long, n4 long"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, hashes of the token before, and first token of each text;
    tokens are the lower-cased words and one end."""
    w = words_of(texts, lower=True)
    n, docs = len(w.starts), len(texts)
    sizes = np.diff(w.bounds)
    at = w.bounds[:-1] + np.arange(docs)
    now = np.empty(n + docs, np.uint64)
    now[np.arange(n) + np.repeat(np.arange(docs), sizes)] = w.hashes()
    now[at + sizes] = END
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[at] = BEGIN
    return now, before, at


def pair_key(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9DDFEA08EB382D69) ^ now)


def _chunks(batches):
    """(now, before) of about CHUNK tokens at a time."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(0)
        for a, b in slices(texts):
            now, before, _ = tokens(texts.slice(a, b - a))
            held.append((now, before))
            size += len(now)
            if size >= CHUNK:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _both(first: list[np.ndarray], second: list[np.ndarray], bits: int):
    """Packed rows of two tables; the second table's shards follow the first's."""
    yield packed_rows(first, bits)
    rows = packed_rows(second, bits)
    yield pa.RecordBatch.from_arrays([pa.compute.add(rows.column(0), pa.scalar(1 << bits, pa.int32())), rows.column(1)], names=["shard", "payload"])


@dataclass
class Model:
    folder: str
    bits: int
    tokens: int
    types: int
    pairs: int
    discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    left: float  # mass that the discounts of the continuation counts leave for the uniform distribution


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; 0.5, 1, 1.5 where a count of counts is 0 or they come out of range."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d <= k + 1 for k, d in enumerate(found)):
            return found
    return 0.5, 1.0, 1.5


def _discount(count: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.choose(np.minimum(count, 3).astype(np.int64), [0.0, *by])


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count a bigram model over all rows of ``docs``.

    Pass 1 counts words and bigrams: a task adds up its own text, packed
    partial counts meet by hash shard and become sorted  Pass 2 reads
    the texts again against these arrays: an occurrence of a bigram seen c
    times adds 1/c to the number of different bigrams of its context and of its
    word, which gives all Kneser-Ney continuation counts without
    storing the bigrams' words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    bits = shard_bits(int(size or 0) // 6 + rows)
    folder = shared_dir(spark, "language_model")

    def count(batches):
        for now, before in _chunks(batches):
            ones = np.ones(len(now), np.uint32)
            yield from _both(group_sum(pair_key(before, now), [ones]), group_sum(now, [ones]), bits)

    def merge(batches):
        for shard, runs in shards(batches):
            kind, shard = shard >> bits, shard & ((1 << bits) - 1)
            key, n = group_sum(np.concatenate([r[0] for r in runs]), [np.concatenate([r[1] for r in runs]).astype(np.int64)])
            name = ("pair", "word")[kind]
            save(folder, f"{name}_n", shard, n.astype(np.uint32 if n.max() < 2**32 else np.int64))
            save(folder, f"{name}_key", shard, key)
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "types": [len(key)], "total": [float(n.sum())]} | {f"n{k}": [int((n == k).sum())] for k in range(1, 5)})

    def totals(stats: DataFrame) -> dict[int, tuple]:
        names = ["types", "total", "n1", "n2", "n3", "n4"]
        return {r[0]: tuple(r)[1:] for r in stats.groupBy("kind").agg(*[F.sum(n).alias(n) for n in names]).collect()}  # two rows

    found = totals(by_shard(texts.mapInArrow(count, PACKED)).mapInArrow(merge, STATS))
    pairs, words = found.get(BIGRAMS, (0,) * 6), found.get(WORDS_TABLE, (0,) * 6)
    by = discounts(*pairs[2:])

    def spread(batches):
        known = Mapped(folder, "pair_key", ["pair_n"], bits)
        for now, before in _chunks(batches):
            n = known.lookup(pair_key(before, now))[1].astype(np.float64)
            share = 1.0 / n
            one, two = (n == 1).astype(np.float64), np.where(n == 2, share, 0.0)
            contexts = group_sum(before, [np.ones(len(now)), one, two, np.where(n > 2, share, 0.0)])
            yield from _both(contexts, group_sum(now, [share]), bits)

    def weigh(batches):
        for shard, runs in shards(batches):
            kind, shard = shard >> bits, shard & ((1 << bits) - 1)
            key, *values = group_sum(np.concatenate([r[0] for r in runs]), [np.concatenate(v) for v in list(zip(*runs))[1:]])
            values = [np.rint(v) for v in values]
            stats = dict.fromkeys(("n1", "n2", "n3", "n4"), [0])
            if kind == BIGRAMS:  # here: contexts
                save(folder, "context_total", shard, values[0])
                save(folder, "context_left", shard, sum(d * v for d, v in zip(by, values[1:])) / values[0])
                save(folder, "context_key", shard, key)
            else:
                save(folder, "word_kinds", shard, values[0].astype(np.int64))
                stats = {f"n{k}": [int((values[0] == k).sum())] for k in range(1, 5)}
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "types": [len(key)], "total": [float(values[0].sum())]} | stats)

    kinds = totals(by_shard(texts.mapInArrow(spread, PACKED)).mapInArrow(weigh, STATS)).get(WORDS_TABLE, (0,) * 6)
    word_by = discounts(*kinds[2:])
    types, once, twice = kinds[0], kinds[2], kinds[3]
    left = (word_by[0] * once + word_by[1] * twice + word_by[2] * (types - once - twice)) / pairs[0] if pairs[0] else 1.0
    return Model(folder, bits, int(words[1]), int(words[0]), int(pairs[0]), by, word_by, left)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; workers memory-map the model.

    ``score`` is the log10 probability of the text, ``base_score`` that of the
    add-one unigram model. Null text counts as empty: one end token. Rows are
    scored one by one, so repeated rows and ids stay. Words never seen
    share the uniform mass. Perplexity is 10 ** (-score / n_tokens).
    """
    m = model

    def run(batches):
        words = Mapped(m.folder, "word_key", ["word_n", "word_kinds"], m.bits)
        pairs = Mapped(m.folder, "pair_key", ["pair_n"], m.bits)
        contexts = Mapped(m.folder, "context_key", ["context_total", "context_left"], m.bits)
        spare = m.word_discounts
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts):
                now, before, at = tokens(texts.slice(a, b - a))
                seen, n, kinds = words.lookup(now)
                base = np.log10((n + 1.0) / (m.tokens + m.types + 1.0))
                kept = np.maximum(kinds - _discount(kinds, spare), 0.0) / max(m.pairs, 1)
                lower = kept + m.left / (m.types + 1.0)
                count = pairs.lookup(pair_key(before, now))[1].astype(np.float64)
                known, total, left = contexts.lookup(before)
                full = np.where(known, np.maximum(count - _discount(count, m.discounts), 0.0) / np.where(known, total, 1.0) + left * lower, lower)
                columns = [ids.slice(a, b - a), np.diff(np.append(at, len(now))), np.add.reduceat(seen.astype(np.int64), at), np.full(b - a, m.tokens),
                           np.add.reduceat(base, at), np.add.reduceat(np.log10(full), at)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(column: str) -> Column:
    return crc32_mod(column, 7) == 2


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs.where(~held_out("doc_id")))
    return score(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
