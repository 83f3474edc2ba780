"""Operator 2: mix sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm.words import WORDS, mix
from menumix.session import materialise

STATE = "id long, skey string, stratum string, size long, source_size long, target double, base long, p double, spread long"
EDGE = 1e-9


def _position(df: DataFrame, column: str) -> DataFrame:
    """0-based rank of distinct values in Spark's binary string order, without
    one task that sorts them all: ranges in order, counts of ranges added up."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, F.col(column).isNull(), F.col(column)).sortWithinPartitions(F.col(column).isNull(), column)
    ranged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    counts = ranged.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect()  # one row a partition
    offsets, total = {}, 0
    for part, n in counts:
        offsets[part] = total
        total += n
    if not offsets:
        return ranged.withColumn("position", F.lit(0).cast("long")).drop("_at")
    table = F.create_map(*[F.lit(x).cast("long") for pair in offsets.items() for x in pair])
    return ranged.withColumn("position", table[F.shiftright("_at", 33).cast("long")] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def targets(items: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source, skey, source_size, target): weighted shares of all sizes, none above ``cap`` times its source.

    Shares are ``level * weight`` with one rising level; sources that reach
    their cap stay there and the level of the others rises, until none is above.
    """
    sums = _position(items.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sums = materialise(sums.withColumn("weight", F.get(cycle, F.pmod("position", F.lit(len(weights))).cast("int"))), "sources")
    total = float(sums.agg(F.sum("source_size")).first()[0] or 0)
    level, over = 0.0, None
    while True:
        full = F.col("weight") * F.lit(level) > F.lit(cap) * F.col("source_size")
        capped, n, free = sums.agg(F.sum(F.when(full, F.lit(float(cap)) * F.col("source_size"))), F.count(F.when(full, 1)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == over or not free:
            break
        over, level = n, (total - (capped or 0.0)) / free
    return sums.select("source", _key("source").alias("skey"), "source_size",
                       F.least(F.col("weight") * F.lit(level), F.lit(float(cap)) * F.col("source_size")).alias("target"))


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def _pivot(level: int, last: bool):
    """Rounds the probabilities of each block in order; one row of a block may stay fractional unless ``last``."""
    def run(batches):
        held, block = None, None  # the row still fractional, as a list
        names = ["id", "skey", "stratum", "size", "source_size", "target", "base", "p", "spread"]

        def settle(row):
            if last and EDGE < row[7] < 1 - EDGE:
                row[7] = 1.0 if _unit(row[8], level + 1000) < row[7] else 0.0
            return row

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            blocks, out = batch.column("block").to_pylist(), []
            chance = _unit(np.array(columns[8], dtype=np.int64), level)
            for i, row in enumerate(map(list, zip(*columns))):
                here = (row[1], blocks[i])
                if here != block:
                    if held is not None:
                        out.append(settle(held))
                    held, block = None, here
                p = row[7]
                if p <= EDGE or p >= 1 - EDGE:
                    row[7] = round(p)
                    out.append(row)
                elif held is None:
                    held = row
                else:
                    total = held[7] + p
                    if total < 1:
                        up, down = (row, held) if chance[i] < p / total else (held, row)
                        up[7], down[7] = total, 0.0
                    else:
                        up, down = (held, row) if chance[i] < (1 - p) / (2 - total) else (row, held)
                        up[7], down[7] = 1.0, total - 1
                    done, held = (down, up) if total < 1 else (up, down)
                    out.append(done)
                    if held[7] <= EDGE or held[7] >= 1 - EDGE:
                        held[7] = round(held[7])
                        out.append(held)
                        held = None
            yield _rows(out)
        if held is not None:
            yield _rows([settle(held)])

    return run


def _unit(spread, level: int):
    """Numbers in [0, 1) that depend on the row and the level only."""
    x = mix(np.atleast_1d(np.asarray(spread, dtype=np.int64)).view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64))
    out = (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return out if np.ndim(spread) else float(out[0])


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
    names = ["id", "skey", "stratum", "size", "source_size", "target", "base", "p", "spread"]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 0, block: int = 256) -> DataFrame:
    """One row per input row: ``id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    A document's expected number of copies is its source's target over its
    source's size. The whole part is taken outright; the fractions of a source
    are rounded dependently: within blocks of about ``block`` documents of
    like size, pairs pass their mass on by chance until one is 0 or 1, so a
    block leaves one fraction at most, and the fractions left over meet in
    further levels (a reduction tree) until the last of a source is rounded.
    Blocks and chances derive from ids, so reruns agree however rows lie.

    Null text counts as size 0, a null source as a source of its own, sorted
    last. Rows with size 0 may be copied but take nothing. Rows that share an
    id are rounded one by one. An empty table gives an empty result.
    """
    items = materialise(df.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORDS)).cast("long").alias("size")), "mix_items")
    items = items.select("id", _key("source").alias("skey"), "source", "size", F.floor(F.log2(F.col("size") + 1)).cast("int").alias("cls"))
    goals = materialise(targets(items, weights, cap), "mix_targets")
    strata = items.groupBy("skey", "cls").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    strata = materialise(strata.join(goals, "skey"), "mix_strata")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = items.join(strata.drop("source"), ["skey", "cls"]).withColumn("spread", F.xxhash64(F.lit(seed), "id")).select(
        "id", "skey", F.concat_ws(":", F.lpad(F.col("cls").cast("string"), 2, "0"), F.pmod(F.shiftright("spread", 7), F.col("blocks")).cast("string")).alias("stratum"),
        "size", "source_size", "target", F.floor(rate + EDGE).alias("base"), F.greatest(rate - F.floor(rate + EDGE), F.lit(0.0)).alias("p"), "spread")
    rows, level, done = rows.withColumn("block", F.col("stratum")), 0, []
    while True:
        last = False
        if level:
            sizes = rows.groupBy("skey").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
            sizes = materialise(sizes, "mix_level_sizes")
            last = (sizes.agg(F.max("blocks")).first()[0] or 1) <= 1
            rows = rows.join(sizes, "skey").withColumn("block", F.pmod(F.xxhash64(F.lit(level), "stratum"), F.col("blocks")).cast("string")).drop("blocks")
        placed = rows.repartition("skey", "block").sortWithinPartitions("skey", "block", "size", "spread", "id")
        state = materialise(placed.mapInArrow(_pivot(level, last), STATE), f"mix_level{level}")
        open_rows = (F.col("p") > EDGE) & (F.col("p") < 1 - EDGE)
        done.append(state.where(~open_rows))
        if last:
            break
        rows, level = state.where(open_rows), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    copies = (F.col("base") + F.round("p").cast("long")).alias("copies")
    return out.select("id", "skey", "size", "source_size", "target", copies, (copies * F.col("size")).alias("taken"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
