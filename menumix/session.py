"""Session settings, shared scratch folder and small rule frames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings only; a cluster's own values for anything else stay.
# forceOptimizeSkewedJoin lets AQE split a hot join key even when that costs
# one more shuffle, which is the right trade when one key holds a third of rows.
# fileCompressionFactor makes the broadcast size check count Parquet files at
# about their size in memory, not on disk. initialPartitionNum keeps a task's
# share of a large shuffle small, however few partitions the session names; AQE
# joins small ones. Documents differ too much for typed
# columns of their own: inferring these holds back rows of every written file,
# and a reader that wants whole documents has to put them together again. The files of
# a query's shuffles go when it ends, not when the driver happens to collect garbage,
# and written tables are compressed well: at level 9 zstd takes hardly longer than at 3.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "480",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("menumix")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master falls back to a temporary folder, because there driver
    and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="menumix-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/menumix/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, parts: list[Column] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage is cut, the
    result survives lost executors, and file sizes give the optimizer real
    statistics for choosing broadcast or shuffle joins. With ``parts`` (conditions that share out the rows, see
    ``key_parts``) it is written one part after the other."""
    path = scratch_path(df.sparkSession, name)
    for rows in [df] if parts is None else [df.filter(part) for part in parts]:
        rows.write.mode("append").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_scratch"] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables that ``materialise`` wrote for these frames; their last reader must be done. Other frames are left."""
    for df in frames:
        path = df.__dict__.pop("_scratch", None)
        if path:
            delete_path(df.sparkSession, path)


def scratch_bytes(df: DataFrame) -> int:
    """Bytes that a frame of ``materialise`` takes where it is written."""
    return stored_bytes(df.sparkSession, df.__dict__["_scratch"])


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder; 0 where there is none."""
    place, files = _place(spark, path)
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


# Parquet bytes that are shuffled at once where a job can be done part by part.
PART_BYTES = 256 << 20


def key_parts(size: int, *keys: str) -> list[Column]:
    """Conditions that share out rows by the hash of their ``keys``, as many as ``size`` bytes of Parquet ask for.

    What a part shuffles is freed before the next one begins, so the disk that a job needs beside its tables is bounded."""
    n = max(1, -(-size // PART_BYTES))
    return [F.pmod(F.xxhash64(*keys), F.lit(n)) == i for i in range(n)] if n > 1 else [F.lit(True)]


def rule_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A rule table as inline rows, so the optimizer knows its exact size.

    ``schema`` lists ``name type`` pairs separated by comma and space.
    """
    fields = schema.split(", ")
    names = [f.split()[0] for f in fields]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.split(None, 1)[1]).alias(n) for f, n in zip(fields, names)])
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = [F.col(n).cast(f.split(None, 1)[1]).alias(n) for f, n in zip(fields, names)]
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})").select(*casts)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    if hasattr(value, "isoformat"):
        return f"DATE'{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
