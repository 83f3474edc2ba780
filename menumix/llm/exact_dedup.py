"""Operator 9: exact duplicates by a content sort, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PREFIX = 32


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = None, sample_rows: int = 50) -> DataFrame:
    """Every row of ``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Sampled splitters range-partition the rows by the leading bytes and the
    fingerprint of the normalised text (short keys, so that the splitters stay
    small); an external sort places equal texts side by side, and the window
    compares neighbours over the whole text. ``keep``: the smallest or the
    largest id of equal texts stays.

    A text that fills several splitters would be one hot run. Such texts show
    in a sample of ``sample_rows`` rows a partition (bounded: at most a twelfth
    of those hashes reach the driver); their runs are split by the id's hash and
    joined again by the SHA-256 of the text. The result does not depend on the
    sample.

    Null texts count as empty. A null id is never preferred to another. Of rows
    that share text and id, one is kept. Result columns replace input columns
    of the same name. An empty table gives an empty result.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.withColumns({"_head": F.substring("_text", 1, PREFIX), "_hash": F.xxhash64("_text")})
    total = df.count()
    fraction = min(1.0, sample_rows * parts / max(total, 1))
    hot = [r[0] for r in rows.sample(fraction, seed=9).groupBy("_hash").count().where("count >= 12").select("_hash").collect()]
    keys = ["_head", "_hash"]
    if hot:  # a constant third key would not match the partitioning that the window asks for
        is_hot = F.col("_hash").isin(hot)
        rows = rows.withColumn("_split", F.when(is_hot, F.pmod(F.xxhash64("_id"), F.lit(parts))).otherwise(F.lit(0)))
        keys.append("_split")
    ranged = rows.repartitionByRange(parts, *keys)
    best, order = (F.max, F.col("_id").desc_nulls_last()) if keep == "largest" else (F.min, F.col("_id").asc_nulls_last())
    run = Window.partitionBy(*keys, "_text").orderBy(order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = ranged.select(
        "_row", "_id", "_hash", F.sha2("_text", 256).alias("_sha"), best("_id").over(whole).alias("_keep"),
        F.count(F.lit(1)).over(whole).alias("_size"), F.row_number().over(run).alias("_nth"))
    keep_id, size = F.col("_keep"), F.col("_size")
    if hot:
        merged = rows.where(is_hot).groupBy(F.sha2("_text", 256).alias("_sha")).agg(best("_id").alias("_all_keep"), F.count(F.lit(1)).alias("_all_size"))
        found = found.join(F.broadcast(merged), "_sha", "left")  # at most one row for each hot hash
        keep_id, size = F.when(F.col("_all_size").isNull(), keep_id).otherwise(F.col("_all_keep")), F.coalesce("_all_size", "_size")
    results = {
        "keep_id": keep_id, "group_size": size, "kept": (F.col("_nth") == 1) & F.col("_id").eqNullSafe(keep_id), "text_sha256": F.col("_sha"),
    }
    own = [F.col("_row").getField(c).alias(c) for c in df.columns if c.lower() not in results]  # their names meet none of the columns used here
    return found.select(*own, *[c.alias(n) for n, c in results.items()])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs, keep="largest").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t"""
