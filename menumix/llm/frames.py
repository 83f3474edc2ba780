"""Frame helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.session import scratch_path

PART_BYTES = 2 << 20


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold at most ``rows`` rows from now on: a batch of texts is held several times over on its way to a worker
    and in it, and is cut by rows whatever their size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def free_shuffles(spark: SparkSession) -> None:
    """Let the files of a query's shuffles go when it ends, not when the driver happens to collect garbage, from now on."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def trimmed(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving free memory back to the system when a task is through: workers are
    reused, and what one stage has freed would otherwise stand beside the next one's memory."""
    def through(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return through


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it in as few partitions as its
    size asks for (one per two megabytes of Parquet), so that small
    tables need no shuffle in what follows. Lineage is cut and lost executors cost nothing."""
    return _settled(df, scratch_path(df.sparkSession, name))


def _settled(df: DataFrame, path: str, *more: DataFrame) -> DataFrame:
    spark = df.sparkSession
    for rows in (df, *more):
        rows.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path).coalesce(max(1, -(-_length(spark, path) // PART_BYTES)))


def _length(spark: SparkSession, path: str) -> int:
    place, files = _place(spark, path)
    return files.getContentSummary(place).getLength()


class Scratch:
    """Tables in the shared folder that go when their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def settle(self, df: DataFrame, name: str, *more: DataFrame) -> DataFrame:
        """A table of the frame and ``more`` like it, which are written one after the other."""
        path = scratch_path(self.spark, name)
        out = _settled(df, path, *more)
        self.paths[id(out)] = (out, path)  # the frame is held, so its id stays its own
        return out

    def size(self, name: str) -> int:
        """Bytes of the tables of that name."""
        return sum(_length(self.spark, path) for _, path in self.paths.values() if f"/{name}-" in path)

    def drop(self, *frames: DataFrame | None) -> None:
        """Delete the tables of these frames; frames that are no table here are left."""
        for df in frames:
            held = self.paths.pop(id(df), None)
            if held:
                place, files = _place(self.spark, held[1])
                files.delete(place, True)

    def close(self) -> None:
        self.drop(*[df for df, _ in self.paths.values()])


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component),
    the component being its smallest node. Nodes without edges do not occur.

    Alternating large-star and small-star rounds: only joins and minima that
    combine before the shuffle, each round written to the shared folder and deleted once the next is.
    """
    scratch = Scratch(edges.sparkSession)
    now = scratch.settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if not now.select(F.col("u").alias("v")).join(now, "v", "left_semi").limit(1).count() and now.count() == now.agg(F.count_distinct("u")).first()[0]:
            break  # every node points to one centre, and no centre points on
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.where("m < u").select("u", F.col("m").alias("v")))
        large = scratch.settle(large.distinct(), "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
        before, now = now, scratch.settle(small.distinct(), "small_star")
        scratch.drop(before, large)
    else:
        raise RuntimeError("components did not settle")
    out = settle(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    scratch.close()
    return out


class Labels:
    """Components of nodes whose links arrive in parts: (node, component) of all linked nodes so far."""

    def __init__(self, spark: SparkSession, scratch: Scratch):
        self.spark, self.scratch = spark, scratch
        self.frame = spark.createDataFrame([], "node long, component long")

    def of(self, df: DataFrame, node: str, out: str) -> DataFrame:
        """``df`` with the component of its column ``node``; a node without links is its own."""
        side = self.frame.toDF("_node", "_component")
        return df.join(side, df[node] == side["_node"], "left").select(*[df[c] for c in df.columns], F.coalesce("_component", node).alias(out))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, ...) of different components."""
        return self.of(self.of(pairs, "a", "_ca"), "b", "_cb").where("_ca <> _cb").drop("_ca", "_cb")

    def add(self, links: DataFrame) -> None:
        """Links (a, b) join components: only the components that they touch are worked on."""
        ends = links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct()
        new = ends.join(self.frame, "node", "left_anti").select("node", F.col("node").alias("component"))
        between = self.of(self.of(links, "a", "_ca"), "b", "_cb").select(F.col("_ca").alias("a"), F.col("_cb").alias("b"))
        joined = components(between).toDF("_old", "_new")
        every = self.frame.unionByName(new)
        after = every.join(joined, every["component"] == joined["_old"], "left").select("node", F.coalesce("_new", "component").alias("component"))
        before, self.frame = self.frame, self.scratch.settle(after, "labels")
        self.scratch.drop(before)
