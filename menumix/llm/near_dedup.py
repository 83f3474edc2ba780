"""Operator 1: near duplicates by inverted lists of the rarest values of their sets."""

from __future__ import annotations

import math
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm import links
from menumix.llm.arrays import PACKED, Mapped, by_shard, group_sum, pack, packed_rows, save, shard_bits, shards, shared_dir
from menumix.llm.frames import settle, small_batches, trimmed
from menumix.llm.words import mix, shingle_hashes, slices, words_of
from menumix.session import materialise

MARKS = 128  # least values that pairs are estimated by, four bytes each
MISS = 1e-8
MOST_TOTAL = 20_000  # larger sets take the least shared values of this size, which are no more than their own
CHUNK = 1_000_000  # values that a task counts at once
PAIRS = 10_000  # pairs that a task compares
SHARD = 2_000_000  # values or so that are merged at once
LEFT_OUT = np.uint64(24)  # low bits of a value that counts leave out: values that agree in the others count as one


def least_shared(k: int, threshold: float, miss: float = MISS) -> int:
    """The most retained values that two documents at the threshold still share, but for a chance of ``miss``.

    Of the k smallest values of the union, each lies in both documents with
    probability ``threshold``, and any that does is retained by both."""
    tail, c = 0.0, 0
    while c < k:
        tail += math.comb(k, c) * threshold**c * (1 - threshold) ** (k - c)
        if tail > miss:
            break
        c += 1
    return max(c, 1)


@lru_cache(maxsize=None)
def least_in_union(total: int, k: int, share: int, miss: float = MISS) -> int:
    """Shared values among the ``k`` smallest of the union of two similar sets with ``total`` values together, but for a chance of ``miss``.

    At the threshold the union has ``total`` / (1 + threshold) values, of which the k smallest are a random part;
    more similar sets share more."""
    union = total * 100 // (100 + share)
    k, both = min(k, union), -(-share * union // 100)
    whole, tail, c = math.comb(union, k), 0.0, 0
    while c < k:
        tail += math.comb(both, c) * math.comb(union - both, k - c) / whole
        if tail > miss:
            break
        c += 1
    return max(c, 1)


def _parts(batches, rows: int = 500):
    """Small pieces of the batches: a pair may carry two long sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Rule:
    """Similarity threshold ``share`` per cent and what follows from it."""

    def __init__(self, n_words: int, share: int):
        self.n_words, self.share = n_words, share

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.share * (len(a) + len(b) - both)

    def least(self, n):
        """Values that a set of size ``n`` shares with any similar set."""
        return -(-self.share * n // 100)

    def near(self, a: str, b: str) -> str:
        return (f"100 * least(n{a}, n{b}) >= {self.share} * greatest(n{a}, n{b}) and "
                f"{100 + self.share} * least(most{a}, most{b}) >= {self.share} * (n{a} + n{b})")


def _sets(texts: pa.Array, n_words: int):
    for a, b in slices(texts):
        w = words_of(texts.slice(a, b - a), lower=True)
        hashes = w.hashes()
        for i in range(b - a):
            yield np.unique(shingle_hashes(hashes[w.bounds[i]:w.bounds[i + 1]], n_words))


def _mark(values: np.ndarray) -> int:
    """Fingerprint of a set."""
    return int(np.bitwise_xor.reduce(mix(values + np.uint64(0x51ED270B))) ^ mix(np.array([values.sum(), len(values)], np.uint64)).sum())


def text_hash(column: str) -> Column:
    """Tells apart the texts of rows that share an id; null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, n, node, text_hash): set size, set fingerprint and the hash of the text of every row."""
    def run(batches):
        for batch in batches:
            sizes, marks = [], []
            for s in _sets(batch.column(1), rule.n_words):
                sizes.append(len(s))
                marks.append(_mark(s) if len(s) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(marks, np.uint64).view(np.int64)), batch.column(2)],
                                             names=["id", "n", "node", "text_hash"])

    return docs.select("id", "text", text_hash("text").alias("text_hash")).mapInArrow(trimmed(run), "id long, n long, node long, text_hash long")


class Firsts:
    """The smallest id of every node, sorted and memory-mapped, so that one text of each node is taken where it is scanned."""

    def __init__(self, nodes: DataFrame, rule: Rule):
        self.rule, self.bits, self.folder = rule, shard_bits(nodes.count(), SHARD), shared_dir(nodes.sparkSession, "near_firsts")
        bits, folder = self.bits, self.folder

        def send(batches):
            for batch in batches:
                node, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                key = mix(node.view(np.uint64))
                order = np.argsort(key)
                yield packed_rows([key[order], first[order]], bits)

        def merge(batches):
            for shard, runs in shards(batches):
                key, first = map(np.concatenate, zip(*runs))
                order = np.argsort(key)
                save(folder, "first", shard, first[order])
                save(folder, "key", shard, key[order])
                yield pa.RecordBatch.from_pydict({"shards": [1]})

        by_shard(nodes.select("node", "first").mapInArrow(trimmed(send), PACKED)).mapInArrow(trimmed(merge), "shards long").agg(F.sum("shards")).first()

    def sets(self, batches):
        """Lists of (node, set) of the rows (id, text) that stand for their nodes, about ``CHUNK`` values at once. Rows that agree in both come each."""
        held = Mapped(self.folder, "key", ["first"], self.bits)

        def chosen(rows):
            found, first = held.lookup(mix(np.array([node for _, node, _ in rows], np.uint64)))
            return [(node, s) for (i, node, s), hit, at in zip(rows, found.tolist(), first.tolist()) if hit and at == i]

        rows, total = [], 0
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            for i, s in zip(batch.column(0).to_pylist(), _sets(batch.column(1), self.rule.n_words)):
                if len(s):
                    rows.append((i, _mark(s) % 2**64, s))
                    total += len(s)
                if total >= CHUNK:
                    yield chosen(rows)
                    rows, total = [], 0
        if rows:
            yield chosen(rows)


class Shared:
    """The values that lie in two sets or more, and in how many, memory-mapped.

    Tasks send their values' counts as packed shards: no row per value is shuffled. ``sets`` makes lists of (node, set) of a batch iterator."""

    def __init__(self, frame: DataFrame, sets, total: int):
        self.bits, self.folder = shard_bits(total, SHARD), shared_dir(frame.sparkSession, "near_counts")
        bits, folder = self.bits, self.folder

        def send(batches):
            for rows in sets(batches):
                if rows:
                    values = np.concatenate([s for _, s in rows]) >> LEFT_OUT << LEFT_OUT
                    yield packed_rows(group_sum(values, [np.ones(len(values), np.int32)]), bits)

        def merge(batches):
            for shard, runs in shards(batches):
                value, df = map(np.concatenate, zip(*runs))
                value, df = group_sum(value, [df])
                save(folder, "df", shard, df[df > 1])
                save(folder, "value", shard, value[df > 1])
                yield pa.RecordBatch.from_pydict({"shards": [1]})

        by_shard(frame.mapInArrow(trimmed(send), PACKED)).mapInArrow(trimmed(merge), "shards long").agg(F.sum("shards")).first()

    def counts(self):
        """A function that gives of lists of (node, set) all values, their rows, and in how many sets they are (at least 1)."""
        held = Mapped(self.folder, "value", ["df"], self.bits)

        def of(rows):
            values, row = np.concatenate([s for _, s in rows]), np.repeat(np.arange(len(rows)), [len(s) for _, s in rows])
            found, df = held.lookup(values >> LEFT_OUT << LEFT_OUT)
            return values, row, np.where(found, df, 1)

        return of


class Sets:
    """Sets of nodes, written by shard and memory-mapped: pairs are compared where they are, and no set is shuffled with them."""

    def __init__(self, spark: SparkSession, total: int):
        self.bits, self.folder = shard_bits(total, SHARD), shared_dir(spark, "near_sets")

    def write(self, packed: DataFrame) -> DataFrame:
        """(node, n) of the sets in packed rows, each payload a node and its set. A node may come more than once."""
        folder = self.folder

        def merge(batches):
            for shard, runs in shards(batches):
                held = {run[0][0]: run[0][1:] for run in runs}
                node = np.array(list(held), np.uint64)
                key, size = mix(node), np.array([len(s) for s in held.values()])
                order = np.argsort(key)
                save(folder, "start", shard, (np.cumsum(size) - size)[order])
                save(folder, "size", shard, size[order])
                save(folder, "value", shard, np.concatenate(list(held.values())))
                save(folder, "key", shard, key[order])
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(size)], names=["node", "n"])

        return by_shard(packed).mapInArrow(trimmed(merge), "node long, n long")

    def reader(self):
        """A function that gives the sets of an array of nodes."""
        held, values = Mapped(self.folder, "key", ["start", "size"], self.bits), {}

        def of(nodes: np.ndarray) -> list[np.ndarray]:
            keys = mix(nodes.view(np.uint64))
            _, start, size = held.lookup(keys)
            out = []
            for shard, at, n in zip((keys >> np.uint64(64 - self.bits)).tolist(), start.tolist(), size.tolist()):
                if shard not in values:
                    values[shard] = np.load(os.path.join(self.folder, f"value.{shard:05d}.npy"), mmap_mode="r").view(np.ndarray)
                out.append(values[shard][at:at + n])
            return out

        return of

    def rows(self, batches):
        """Lists of (node, set) of rows (node)."""
        of = self.reader()
        for batch in _parts(batches):
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            yield list(zip(nodes.tolist(), of(nodes)))

    def pairs(self, batches):
        """(a, b, sets of a, sets of b) of rows (a, b)."""
        of = self.reader()
        for batch in _parts(batches):
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            yield a, b, of(a), of(b)


def linkable(docs: DataFrame, nodes: DataFrame, rule: Rule, sets: Sets) -> DataFrame:
    """(node, n) of the nodes that share enough of their values with any others to be similar to one; their sets are written to ``sets``."""
    firsts = Firsts(nodes, rule)
    shared = Shared(docs.select("id", "text"), firsts.sets, nodes.agg(F.sum("n")).first()[0] or 0)
    bits = sets.bits

    def run(batches):
        counts = shared.counts()
        for rows in firsts.sets(batches):
            if not rows:
                continue
            _, row, df = counts(rows)
            held = np.bincount(row[df > 1], minlength=len(rows))
            rows = [(node, s) for (node, s), h in zip(rows, held.tolist()) if h >= rule.least(len(s))]
            shard = mix(np.array([node for node, _ in rows], np.uint64)) >> np.uint64(64 - bits)
            payloads = [pack([np.concatenate([np.array([node], np.uint64), s])]) for node, s in rows]
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(payloads, pa.binary())], names=["shard", "payload"])

    return sets.write(docs.select("id", "text").mapInArrow(trimmed(run), PACKED))


def prefixes(nodes: DataFrame, sets: Sets, shared: Shared, rule: Rule) -> DataFrame:
    """(k, node, n, most): the values of each set that enter the inverted lists.

    All values are ordered by the number of sets that hold them, then by value, the rarest first. Of a set of n values any similar one
    holds ``least(n)``, so the first one that both hold is among the first n - least(n) + 1 of each. Where that is the first one,
    no more are in both than follow it, itself included: ``most``. Values and sets that can have no partner are left out."""

    def run(batches):
        counts = shared.counts()
        for rows in sets.rows(batches):
            if not rows:
                continue
            value, row, df = counts(rows)
            node, n = np.array([x for x, _ in rows], np.int64), np.array([len(s) for _, s in rows])
            able = np.bincount(row[df > 1], minlength=len(rows)) >= rule.least(n)
            order = np.lexsort((value, df, row))
            value, row, df = value[order], row[order], df[order]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            keep = (df > 1) & able[row] & (nth <= (n - rule.least(n))[row])
            value, row, nth = value[keep], row[keep], nth[keep]
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(node[row]), pa.array(n[row]), pa.array(n[row] - nth)], names=["k", "node", "n", "most"])

    return nodes.select("node").mapInArrow(trimmed(run), "k long, node long, n long, most long")


class Search(links.Search):
    """Components of the different shingle sets (nodes) of a corpus."""

    def __init__(self, spark: SparkSession, written: Sets, shared: Shared, rule: Rule):
        super().__init__(spark)
        self.shared, self.sets, self.rule, self.near = shared, written, rule, rule.near

    def read_sets(self, wanted: DataFrame) -> None:
        """All sets that may be wanted are written."""

    def spread(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) in tasks of about ``PAIRS``: a written pair is small, and its comparison is not."""
        return pairs.select("a", "b").repartition(max(1, -(-pairs.count() // PAIRS)), "a", "b")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """(a, b, score): pairs whose union sketch, by the upper halves of the ``MARKS`` least values, holds enough shared ones, and their share in thousandths.

        Halves keep the order of the values; where two values share a half, a pair is estimated too high, and verified."""
        written, share = self.sets, self.rule.share

        def run(batches):
            for a, b, x, y in written.pairs(batches):
                keep, score = np.zeros(len(a), bool), np.zeros(len(a), np.int64)
                for i, (s, t) in enumerate(zip(x, y)):
                    both = np.sort(np.concatenate([s[:MARKS], t[:MARKS]]) >> np.uint64(32))
                    twin = np.concatenate([both[1:] == both[:-1], [False]])
                    first = np.concatenate([[True], both[1:] != both[:-1]])
                    held = twin[first][:MARKS]
                    keep[i], score[i] = held.sum() >= least_in_union(min(len(s) + len(t), MOST_TOTAL), MARKS, share), 1000 * held.sum() // len(held)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(score[keep])], names=["a", "b", "score"])

        pairs = self.scratch.settle(pairs, "apart")
        return self.spread(pairs).mapInArrow(trimmed(run), "a long, b long, score long")

    def similar(self, pairs: DataFrame) -> DataFrame:
        written, rule = self.sets, self.rule

        def run(batches):
            for a, b, x, y in written.pairs(batches):
                keep = np.array([rule.similar(s, t) for s, t in zip(x, y)], bool)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

        return self.spread(pairs).mapInArrow(trimmed(run), "a long, b long")

    def outside(self, pairs: DataFrame) -> DataFrame:
        """(k, node, n, leader, need, inside): the values of a set outside its leader, how many of them a similar partner shares, and how many values are inside.
        Values that no other set holds are left out."""
        written, shared, rule = self.sets, self.shared, self.rule

        def run(batches):
            held_in = shared.counts()
            for a, b, sets, leaders in written.pairs(batches):
                keys, rows, counts = [np.zeros(0, np.uint64)], [], []
                df = np.split(held_in(list(zip(a, sets)))[2], np.cumsum([len(x) for x in sets])[:-1]) if len(a) else []
                for node, leader, x, y, held in zip(a.tolist(), b.tolist(), sets, leaders, df):
                    rest = np.setdiff1d(x, y, assume_unique=True)
                    inside = len(x) - len(rest)
                    rest = np.setdiff1d(x[held > 1], y, assume_unique=True)
                    need = max(1, math.ceil(rule.share * (len(x) + len(y)) / (100 + rule.share) - inside - 1e-9))
                    if len(rest) < need:
                        continue
                    keys.append(mix(rest ^ mix(np.array([leader % 2**64], np.uint64))))
                    rows.append((node, len(x), leader, need, inside))
                    counts.append(len(rest))
                columns = np.repeat(np.array(rows, np.int64).reshape(-1, 5), counts, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), *[pa.array(columns[:, i]) for i in range(5)]],
                                                 names=["k", "node", "n", "leader", "need", "inside"])

        return self.spread(pairs).mapInArrow(trimmed(run), "k long, node long, n long, leader long, need long, inside long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, share: int = 80, with_text_hash: bool = False) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row, and its text's hash if asked for.

    Words are lower-cased (A-Z) runs of non-space bytes; a document's set holds
    its different ``n_words``-word shingles, or its whole sequence when shorter.
    Documents whose sets have at least ``share`` per cent of their union in
    common are linked, and a component takes its smallest id.

    Equal sets are one node, so copies never multiply. A node whose values lie too rarely in other nodes is similar to none;
    the sets of the others are written once. Their rarest values enter the inverted lists (``prefixes``), which miss no link.
    ``links.Search`` works through the lists without emitting all pairs of long ones; pairs pass
    a union-sketch estimate (which misses a pair at the threshold with a chance of 1e-8) and are confirmed on the full sets.

    Texts without words have size 0 and are linked with nothing. Null text counts as
    empty. A row without id has no component id and is kept, and makes no links. Rows
    that share id and text agree; rows that share an id but not the text are documents
    of their own. An empty table gives an empty result.
    """
    rule = Rule(n_words, share)
    small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(fingerprints(docs, rule), "near_fingerprints")
    nodes = rows.where("n > 0 and id is not null").groupBy("node").agg(F.min("id").alias("first"), F.any_value("n").alias("n"))
    nodes = materialise(nodes, "near_nodes")
    written = Sets(df.sparkSession, nodes.agg(F.sum("n")).first()[0] or 0)
    able = settle(linkable(docs, nodes, rule, written), "near_linkable")
    shared = Shared(able.select("node"), written.rows, able.agg(F.sum("n")).first()[0] or 0)
    search = Search(df.sparkSession, written, shared, rule)
    labels = search.run(prefixes(able, written, shared, rule).withColumn("parent", F.lit(0))).join(nodes.select("node", "first"), "node")
    firsts = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    named = settle(nodes.select("node", "first").join(labels.select("node", "component"), "node", "left").join(firsts, "component", "left").select(
        F.col("node"), F.coalesce("component_id", "first").alias("component_id")), "near_components")
    search.scratch.close()
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    out = rows.select("id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"), "text_hash").join(named, "node", "left")
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
                      *(["text_hash"] if with_text_hash else []))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, n_words=2).withColumnRenamed("id", "doc_id")
