"""Menu engineering: popularity and profitability quadrants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.scalars import blank_to_null, ratio
from menumix.operators.shares import share_of
from menumix.session import materialise


def in_scope(items: DataFrame, channels: list[str] | None = None) -> Column:
    """Items that take part: sold, priced, categorised, in the three main channels.

    Where ``items`` says so (``is_open_item``, ``is_excluded``), open and excluded
    items do not; an unknown flag counts as no.
    """
    taken = (
        (F.col("quantity") > 0) & (F.col("avg_cost") > 0) & blank_to_null(F.col("category")).isNotNull()
        & F.col("channel_code").isin(channels or fv.ENGINEERING_CHANNELS)
    )
    for flag in ("is_open_item", "is_excluded"):
        if flag in items.columns:
            taken = taken & ~F.coalesce(F.col(flag), F.lit(False))
    return F.coalesce(taken, F.lit(False))


def thresholds(items: DataFrame, by: list[str] = (), channels: list[str] | None = None) -> DataFrame:
    """Item count, margin threshold (total margin over total sales) and mix
    threshold (0.7 / n), over everything or within ``by``."""
    sums = items.filter(in_scope(items, channels)).groupBy(*by).agg(
        F.count("*").alias("n_items"),
        ratio(F.sum("total_margin"), F.sum("net_sales")).alias("margin_threshold"),
    )
    factor = F.lit(float(fv.MIX_THRESHOLD_FACTOR))
    return sums.withColumn("mix_threshold", ratio(F.lit(1), F.col("n_items")) * factor)


def menu_engineering(
    items: DataFrame, strict: bool = True, by: list[str] = (), channels: list[str] | None = None
) -> DataFrame:
    """Quadrant of each item row; rows out of scope get null.

    ``items`` has the columns of ``item_metrics`` plus category and channel.
    Thresholds are aggregates over the scope, read as a scalar subquery or
    joined back per ``by`` group. ``strict`` asks for more than the threshold,
    otherwise reaching it is enough.
    """
    by = list(by)
    items = materialise(items, "engineering-items")  # read by the thresholds and the classification
    limits = thresholds(items, by, channels)
    if by:
        out = items.join(limits, by, "left")
    else:
        one = limits.select(F.struct("n_items", "margin_threshold", "mix_threshold")).scalar()
        out = items.withColumn("_t", one).select("*", "_t.*").drop("_t")

    def high(value: str, limit: str) -> Column:
        reached = F.col(value) > F.col(limit) if strict else F.col(value) >= F.col(limit)
        return F.when(reached, "High").otherwise("Low")

    scoped = in_scope(items, channels)
    out = out.withColumn("margin_class", F.when(scoped, high("margin_pct", "margin_threshold")))
    out = out.withColumn("mix_class", F.when(scoped, high("menu_mix_pct", "mix_threshold")))
    margin, mix = F.col("margin_class"), F.col("mix_class")
    quadrant = (
        F.when((margin == "High") & (mix == "High"), "Star").when((margin == "High") & (mix == "Low"), "Puzzle")
        .when((margin == "Low") & (mix == "High"), "Plow Horse").when((margin == "Low") & (mix == "Low"), "Dog")
    )
    return out.withColumn("quadrant", quadrant)


def quadrant_summary(items: DataFrame) -> DataFrame:
    """Items and revenue share per quadrant."""
    sums = items.filter(F.col("quadrant").isNotNull()).groupBy("quadrant").agg(
        F.count("*").alias("n_items"), F.sum("net_sales").alias("net_sales")
    )
    return share_of(sums, "net_sales", out="revenue_share")


def overall_from_channels(items: DataFrame) -> DataFrame:
    """An item's overall class is that of its best-selling classified channel."""
    classified = items.filter(F.col("quadrant").isNotNull())
    best = F.max_by(F.struct("quadrant", "channel_code"), F.struct("net_sales", "channel_code")).alias("b")
    return classified.groupBy("canonical_name").agg(best, F.sum("net_sales").alias("net_sales")).select(
        "canonical_name", F.col("b.quadrant").alias("overall_quadrant"),
        F.col("b.channel_code").alias("from_channel"), "net_sales",
    )


def contribution(items: DataFrame) -> DataFrame:
    """Total contribution margin and average price of each item row."""
    return items.withColumn("contribution", F.col("net_sales") - F.col("total_cost")).withColumn(
        "avg_price", ratio(F.col("net_sales"), F.col("quantity"))
    )
