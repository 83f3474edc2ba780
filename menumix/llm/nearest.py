"""Operator 10: nearest neighbours by collision counting over sorted projections."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"


def _inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, components added in order."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def _best(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the best ``k`` of the rows ``near``, ties to the smaller id."""
    if len(near) > k:
        # Reading all rows in order is faster than gathering many.
        rough = (vectors @ query)[near] if 4 * len(near) > len(vectors) else vectors[near] @ query
        bar = np.partition(rough, len(near) - k)[len(near) - k]
        near = near[rough >= bar - 1e-9 * (1 + abs(bar))]  # keeps all that rounding might reorder
    scores = _inner(vectors[near], query)
    order = np.lexsort((ids[near], -scores))[:k]
    return ids[near][order], scores[order]


def _reach(projections: int, need: int, miss: float) -> float:
    """Half window, in distances, at which a row lies in fewer than ``need`` windows with a chance of at most ``miss``."""
    low, high = 0.0, 10.0
    for _ in range(60):
        half = (low + high) / 2
        p = math.erf(half / math.sqrt(2))
        passed = sum(math.comb(projections, j) * p**j * (1 - p) ** (projections - j) for j in range(need, projections + 1))
        low, high = (low, half) if passed >= 1 - miss else (half, high)
    return high


class Block:
    """Sorted projections of one block of vectors.

    One more component makes all norms equal, so that the largest inner product
    is the smallest distance.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, norm: float, projections: int, seed: int):
        self.vectors, self.ids, self.norm, self.projections = vectors, ids, norm, projections
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, projections))
        lifted = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0.0))
        at = (vectors @ self.lines[:-1] + lifted[:, None] * self.lines[-1]).T
        self.order = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.order, axis=1)

    def windows(self, centres: np.ndarray, half: float | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of every centre's window in each sorted array."""
        lo = np.stack([np.searchsorted(a, c, side="left") for a, c in zip(self.sorted, (centres - half).T)], axis=1)
        hi = np.stack([np.searchsorted(a, c, side="right") for a, c in zip(self.sorted, (centres + half).T)], axis=1)
        return lo, hi

    def missed(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The number of windows that each row lies outside of."""
        outside = np.concatenate([part for o, a, b in zip(self.order, lo, hi) for part in (o[:a], o[b:])])
        return np.bincount(outside, minlength=len(self.ids))

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int, threshold: float, miss: float, width: float) -> list[pd.DataFrame]:
        """Best ``k`` of the block for each query, whatever other queries there are.

        The ``k`` rows in most windows of half ``width`` are verified first; the
        worst of them is no nearer than the true ``k``-th. Windows of ``_reach`` times its
        distance then let every row that is as near pass the threshold but for the chance ``miss``.
        """
        need = int(np.ceil(threshold * self.projections))
        reach = _reach(self.projections, need, miss)
        lengths = np.linalg.norm(queries, axis=1)
        # A query's length does not change its order of inner products; at the common norm distances differ most.
        centres = (queries * (self.norm / lengths)[:, None]) @ self.lines[:-1]
        far, first = np.zeros(len(queries)), np.zeros((len(queries), k), dtype=int)
        ample = len(self.ids) - max(np.unique(self.ids, return_counts=True)[1]) > k
        if ample:
            los, his = self.windows(centres, width)
            for q in range(len(queries)):
                missed = self.missed(los[q], his[q])
                missed[self.ids == query_ids[q]] = self.projections + 1
                first[q] = np.argpartition(missed, k)[:k]
                low = (self.vectors[first[q]] @ queries[q]).min() / lengths[q]
                far[q] = np.sqrt(max(0.0, 2 * self.norm * (self.norm - low)))
            los, his = self.windows(centres, (reach * far + 1e-7 * self.norm)[:, None])  # more than rounding
        out = []
        for q in range(len(queries)):
            near = np.ones(len(self.ids), dtype=bool)
            if ample:
                near = self.missed(los[q], his[q]) <= self.projections - need
                near[first[q]] = True
            ids, scores = _best(self.vectors, self.ids, np.flatnonzero(near & (self.ids != query_ids[q])), queries[q], k)
            out.append(pd.DataFrame({"query_id": np.full(len(ids), query_ids[q]), "vec_id": ids, "score": scores}))
        return out


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, block: int = 8192,
            queries_per_task: int = 2048, projections: int = 64, threshold: float = 0.8, miss: float = 0.02, width: float = 1.0, seed: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    other rows. Every row is indexed: rows are dealt into blocks of about
    ``block`` by the id's hash, each block holds its sorted projections, and the
    queries visit all blocks in groups, so a task never holds more than one block and one group
    of queries. No cap cuts off candidates: whatever passes the threshold is verified exactly.
    A true neighbour is lost with a chance of at most ``miss``, taken over the random
    projections, at any table size and whatever the ids and the other queries are.

    Vectors that are null, zero, of another length than most rows' length, or
    that hold null or non-finite components take no part, nor do rows without
    id. Ties go to the smaller id. Other columns are ignored. Rows that share an
    id count once each as candidates, not for their own id. With fewer than ``k`` candidates
    all are returned; an empty table gives an empty result.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).where(
        "id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.expr("aggregate(v, double(0), (a, x) -> a + x * x)")).alias("top"),
        F.count(F.when(F.pmod("id", F.lit(every)) == 0, 1)).alias("q")).orderBy(F.desc("n"), "dims").first()
    if lengths is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, n, top, asked = lengths
    blocks, groups, norm = max(1, round(n / block)), max(1, -(-asked // queries_per_task)), float(np.sqrt(top))
    rows = rows.where(F.size("v") == dims)
    spread = F.xxhash64("id")
    held = rows.select("id", "v", F.pmod(spread, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("query_group"))
    asks = rows.where(F.pmod("id", F.lit(every)) == 0).select(
        "id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.shiftright(spread, 20), F.lit(groups)).cast("int").alias("query_group"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        left, right = left.sort_values("id"), right.sort_values("id")
        held = Block(np.stack(left["v"].to_numpy()), left["id"].to_numpy(), norm, projections, seed)
        return pd.concat(held.search(np.stack(right["v"].to_numpy()), right["id"].to_numpy(), k, threshold, miss, width * norm))

    found = held.groupBy("block", "query_group").cogroup(asks.groupBy("block", "query_group")).applyInPandas(run, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
