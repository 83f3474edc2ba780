"""Similar pairs among many sets and their components, without all pairs of a long list.

DataFrame operations only. What a set is, how a pair is estimated and how it is verified is up to the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from menumix.llm.frames import Labels, Scratch

GUIDES = 48


class Search:
    """Components of different sets (nodes) by similarity.

    An operator gives ``near`` (SQL: may two members of a list be similar, by the columns ``n`` and ``most`` with two endings), ``estimated`` (pairs that are likely similar, with a score),
    ``find_sets`` (full sets of nodes), ``similar`` (pairs that are similar by ``sets``) and ``outside`` (values of a set outside another, the number inside with them).
    """

    def __init__(self, spark: SparkSession):
        self.scratch = Scratch(spark)
        self.labels = Labels(spark, self.scratch)
        self.seen = self.sets = None

    def run(self, index: DataFrame) -> DataFrame:
        """(node, component) of all nodes that are similar to another one; ``index`` (k, node, n, most, parent) lists the nodes by shared values, n being a set's size
        and ``most`` a bound for what it shares with a partner whose first common list this is, in one order of the lists of a parent, in which it falls from list to list."""
        index = self.scratch.settle(index, "index")
        while index is not None:
            before, index = index, self.resolve(index)
            self.scratch.drop(before)
        return self.labels.frame

    def read_sets(self, wanted: DataFrame) -> None:
        """Read the full sets of nodes that have none yet."""
        wanted = wanted.distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        wanted = self.scratch.settle(wanted, "wanted")
        if wanted.limit(1).count():
            found = self.scratch.settle(self.find_sets(wanted), "sets")
            self.sets = found if self.sets is None else self.sets.unionAll(found)
        self.scratch.drop(wanted)

    def verify(self, pairs: DataFrame) -> None:
        """Join the components of pairs that are similar by their full sets."""
        links = self.scratch.settle(self.similar(pairs), "links")
        self.labels.add(links)
        self.scratch.drop(links)

    def meet(self, pairs: DataFrame) -> None:
        """Check pairs (a, b) of nodes: the estimate leaves the likely ones, every node's likeliest is
        verified first, and of the rest only what then still lies in two components.
        So a large group of near copies costs about one exact comparison a node."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["a", "b"], "left_anti")
        pairs = self.scratch.settle(pairs, "pairs")
        self.seen = pairs if self.seen is None else self.seen.unionAll(pairs)
        likely = self.scratch.settle(self.estimated(self.labels.apart(pairs)), "likely")
        ends = likely.select(F.col("a").alias("x"), F.col("b").alias("y"), "score").unionAll(likely.select("b", "a", "score"))
        self.read_sets(ends.select(F.col("x").alias("node")))
        if self.sets is None:
            return
        best = ends.groupBy("x").agg(F.max(F.struct("score", "y")).alias("top")).select(F.least("x", "top.y").alias("a"), F.greatest("x", "top.y").alias("b"))
        best = self.scratch.settle(best.distinct(), "best")
        self.verify(best)
        rest = self.scratch.settle(self.labels.apart(likely.select("a", "b").join(best, ["a", "b"], "left_anti")), "rest")
        if rest.limit(1).count():
            self.verify(rest)
        self.scratch.drop(likely, best, rest)

    def resolve(self, index: DataFrame) -> DataFrame | None:
        """Check the lists of ``index`` (k, node, n, most, parent); the index of what is left, or None.

        Every member meets its list's smallest set, the leader, and its hub, the one with least of its own. Lists that are then
        one component are done. In the others every member meets the list's guides, up to ``GUIDES`` members of the
        components with fewest members in it: that settles short lists, and long ones where few stand apart from many.
        If the rest of a list is still several components, one of its sets, which is not similar to the leader,
        can only be similar to another one that shares with it a value outside
        the leader (the other is no smaller than the leader, so what both share
        within the leader is not enough): the rest goes on to lists of those values. A list's work grows with
        its members; every level takes its guides out, so this ends.
        """
        hub = F.max(F.struct((F.col("most") / F.col("n")).alias("part"), "node", "n", "most"))  # what has least of its own is likely similar to most
        lists = index.groupBy("k").agg(F.min(F.struct("n", "node", "most")).alias("leader"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("members"), hub.alias("hub"), F.any_value("parent").alias("parent"))
        lists = lists.where("size > 1").groupBy("members", "size", "parent", "leader.n", "leader.node").agg(F.max(F.struct("leader.most", "k", "hub")).alias("list"))  # of a parent's lists with the same members the first
        lists = lists.select("list.k", F.col("node").alias("leader"), F.col("n").alias("n_b"), F.col("list.most").alias("most_b"), "list.hub")
        met = self.scratch.settle(index.join(lists.hint("merge"), "k"), "met")
        ends = met.where("node <> leader").select("node", "n", "most", F.col("leader").alias("node_b"), "n_b", "most_b").unionAll(
            met.where("node <> hub.node").select("node", "n", "most", "hub.node", "hub.n", "hub.most"))
        self.meet(ends.where(self.near("", "_b")).select(F.col("node").alias("a"), F.col("node_b").alias("b")))
        mixed = self.mixed(met.drop("parent", "n_b", "most_b", "hub"), "mixed")
        self.scratch.drop(met)
        held = mixed.groupBy("k", "component").agg(F.count(F.lit(1)).alias("held"))
        ranked = mixed.join(held, ["k", "component"]).withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy("held", "n", "node")))
        guides = self.scratch.settle(ranked.where(F.col("nth") <= GUIDES).select("k", "node", "n", "most", "component"), "guides")
        left, right = (df.select("k", *[F.col(c).alias(c + s) for c in ("node", "n", "most", "component")]) for df, s in ((mixed, "_a"), (guides, "_b")))
        self.meet(left.join(right, "k").where(f"component_a <> component_b and {self.near('_a', '_b')}").select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
        rest = self.mixed(mixed.drop("component").join(guides, ["k", "node"], "left_anti"), "rest")
        long = self.scratch.settle(self.led(rest).distinct(), "long")
        self.scratch.drop(mixed, guides, rest)
        if not long.limit(1).count():
            return None
        self.read_sets(long.select(F.col("a").alias("node")).unionAll(long.select("b")))
        index = self.rare_values(long)
        self.scratch.drop(long)
        return index if index.limit(1).count() else None

    def led(self, rest: DataFrame) -> DataFrame:
        """(a, b): the members of each list with its smallest set, which all have met. Sizes in the index must be those of the sets."""
        return rest.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))

    def rare_values(self, pairs: DataFrame) -> DataFrame:
        """(k, node, n, most, parent): for each set and leader, values outside the leader of which any similar partner shares one.

        Only values that occur in two components or more count. A partner of another component shares ``need`` of them, hence one outside
        the ``need - 1`` most frequent. Where that is the rarest one that both hold, they share what the set has inside the leader and the ``nth`` most frequent
        values at most. The leader is the parent of its lists.
        """
        values = self.scratch.settle(self.outside(pairs), "outside")
        counts = self.labels.of(values.select("k", "node"), "node", "component").groupBy("k").agg(
            F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("k", "df")
        ranked = values.join(counts, "k").selectExpr("*", "row_number() over (partition by node, leader order by df desc, k desc) as nth")
        index = self.scratch.settle(ranked.where("nth >= need").select("k", "node", "n", (F.col("inside") + F.col("nth")).alias("most"), F.col("leader").alias("parent")), "index")
        self.scratch.drop(values)
        return index

    def mixed(self, members: DataFrame, name: str) -> DataFrame:
        """The members (k, node, ...) of lists with several components, and their components."""
        labelled = self.labels.of(members, "node", "component")
        mixed = labelled.groupBy("k").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("k")
        return self.scratch.settle(labelled.join(mixed, "k"), name)
