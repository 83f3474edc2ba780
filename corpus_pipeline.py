"""A training corpus from raw documents: quality, exact and near duplicates, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.llm import bpe, exact_dedup, mixing, near_dedup, quality
from menumix.session import scratch_path


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more, whatever their ids; all documents where no text has a label."""
    return quality.keep(docs, quality.learn_from_tables(spark, docs, sf_dir))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; null text counts as empty, a null id goes before any other,
    and of rows that share both one stays."""
    rows = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return exact_dedup.exact_dedup(rows, keep="largest").where("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 80 per cent) the document with the smallest id.
    Rows go by id and text, so of rows that share an id only near copies of smaller ids go."""
    gone = near_dedup.near_duplicates(docs, with_text_hash=True).where("not kept").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = (docs["doc_id"] == gone["_id"]) & (near_dedup.text_hash("text") == gone["_hash"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it; documents that it does not take go.
    Rows that share an id are taken equally often."""
    copies = mixing.mix_sources(docs).groupBy(F.col("id").alias("_id")).agg(F.max("copies").alias("_copies")).where("_copies > 0")
    taken = docs.join(copies, docs["doc_id"].eqNullSafe(copies["_id"]))
    row, times = F.struct(*[docs[c] for c in docs.columns]), F.sequence(F.lit(1), copies["_copies"].cast("int"))
    return taken.select(row.alias("row"), F.explode(times).alias("nth")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of the ids and of the bytes that they decode to; null text has no ids."""
    return bpe.encode_and_decode(spark, docs, with_ids=True)


STAGES = [
    ("quality", reject_low_quality),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("mixture", mix_sources),
    ("bpe", encode),
]
#: SQL expresses neither the classifier nor the rounding; tests/llm/test_pipeline.py compares stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
