"""Shares, ranks, top-n, paging, subtotals and period comparison (H1 to H8)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menumix.functions.calendar import prior_range
from menumix.functions.scalars import ratio
from menumix.session import materialise


def shares_of(df: DataFrame, values: dict[str, str], by: list[str] = ()) -> DataFrame:
    """H1: values as parts of their totals, over everything or within ``by``; ``values`` names a share column for each.

    ``df`` is an aggregated frame. It is written once, so the facts behind it are read once: details and totals both come from
    the small table. Totals are read as a scalar subquery or joined back, so no group is gathered in one task
    as an unbounded window would do.
    """
    by, names = list(by), list(df.columns)
    df = materialise(df, "shares")
    sums = [F.sum(v).alias(f"_total_{out}") for v, out in values.items()]
    if by:
        totals = df.groupBy(*by).agg(*sums)
        df = _null_safe_join(df, totals, by, "left")
    else:
        total = df.agg(*sums).select(F.struct("*")).scalar()
        df = df.withColumn("_totals", total).select("*", "_totals.*").drop("_totals")
    parts = [ratio(F.col(v), F.col(f"_total_{out}")).alias(out) for v, out in values.items()]
    return df.select(*names, *parts)


def share_of(df: DataFrame, value: str, by: list[str] = (), out: str = "share") -> DataFrame:
    """H1 for one value."""
    return shares_of(df, {value: out}, by)


RANK_BUCKETS = 64


def global_rank(df: DataFrame, value: str, out: str = "rank", by: list[str] = ()) -> DataFrame:
    """H3: rank (1 = largest, ties equal) without sorting everything in one task.

    Equal values are collapsed first. Distinct values are split into buckets at
    quantiles of the distinct values (of all, and so of every ``by`` group of any
    size), hence values that lie close together split too; a value's rank is the
    row count of all higher buckets, plus that of higher values in its bucket, plus
    one, which is exact wherever the splitters lie. NaN ranks first, as Spark
    sorts it, then infinity; null ranks last.
    """
    by = list(by)
    # Written: quantiles, offsets and ranks read the distinct values, not the rows again.
    counts = materialise(df.groupBy(*by, value).agg(F.count("*").alias("_n")), "rank-counts")
    number = F.col(value).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    splitters = counts.agg(F.percentile_approx(finite, F.lit([i / RANK_BUCKETS for i in range(1, RANK_BUCKETS)]), F.lit(50 * RANK_BUCKETS)).alias("s"))
    cuts = sorted(set(splitters.first()[0] or []))  # at most RANK_BUCKETS numbers
    bucket = F.lit(0)
    if cuts:  # width_bucket over given bounds: how many of them the value reaches
        bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= number))
    bucket = F.when(number.isNull(), F.lit(-1)).when(F.isnan(number), F.lit(len(cuts) + 1)).otherwise(bucket)
    counts = counts.withColumn("_bucket", bucket)
    buckets = counts.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_rows"))
    higher = Window.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_offset", F.coalesce(F.sum("_rows").over(higher), F.lit(0))).drop("_rows")
    inside = (
        Window.partitionBy(*by, "_bucket").orderBy(F.desc_nulls_last(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranks = _null_safe_join(placed, offsets, by + ["_bucket"], "inner")
    ranks = ranks.select(*by, value, (F.col("_offset") + F.col("_ahead") + 1).alias(out))
    return _null_safe_join(df, ranks, by + [value], "left").select(*df.columns, out)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = right
    condition = F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def mix_rank(items: DataFrame, mix: str = "quantity") -> DataFrame:
    """Rank of each item by its menu mix, for the engineering scatter."""
    return global_rank(items, mix, "mix_rank")


def vs_prior(
    df: DataFrame, start: date, end: date, keys: list[str], value: str = "line_total", share: bool = False
) -> DataFrame:
    """H4: value per key in a range and in the range of equal length before it.

    Both ranges come from one scan and one aggregation. With ``share`` the
    change of each key's part of the total is added in percentage points.
    """
    before_start, before_end = prior_range(start, end)
    day = F.col("business_date")
    now = day.between(F.lit(start), F.lit(end))
    out = (
        df.filter(day.between(F.lit(before_start), F.lit(end)))
        .groupBy(*keys)
        .agg(
            F.sum(F.when(now, F.col(value))).alias("current_value"),
            F.sum(F.when(~now, F.col(value))).alias("prior_value"),
        )
    )
    change = F.coalesce("current_value", F.lit(0)) - F.coalesce("prior_value", F.lit(0))
    out = out.withColumn("change", change).withColumn("change_pct", ratio(F.col("change"), F.col("prior_value")))
    if share:
        out = shares_of(out, {"current_value": "current_share", "prior_value": "prior_share"})
        points = F.coalesce("current_share", F.lit(0.0)) - F.coalesce("prior_share", F.lit(0.0))
        out = out.withColumn("share_change_pp", points * 100)
    return out


def top_items(
    df: DataFrame, n: int, by: str = "net_sales", name: str = "canonical_name", per: list[str] = ()
) -> DataFrame:
    """H5: the n largest rows, overall or per group, name breaking ties."""
    if not per:
        return df.orderBy(F.desc_nulls_last(by), name).limit(n)
    within = Window.partitionBy(*per).orderBy(F.desc_nulls_last(by), name)
    return df.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= n)


def page(df: DataFrame, number: int, order: list, size: int = 25) -> DataFrame:
    """H6: page ``number`` (first = 1) of the rows in ``order``."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def union_retention(instore: DataFrame, delivery: DataFrame) -> DataFrame:
    """H7: both retention sources with the channel they describe."""
    return instore.withColumn("source_channel", F.lit("IN_STORE")).unionByName(
        delivery.withColumn("source_channel", F.lit("DELIVERY")), allowMissingColumns=True
    )


def subtotals(df: DataFrame, levels: list[str], values: dict[str, Column | str]) -> DataFrame:
    """H8: header totals for each level from the whole down to single rows.

    Rows are summed at the finest level before the rollup multiplies them.
    ``level`` is 0 for single rows and grows by one per collapsed column.
    """
    finest = df.groupBy(*levels).agg(*[F.sum(v).alias(name) for name, v in values.items()])
    rolled = finest.rollup(*levels).agg(
        *[F.sum(name).alias(name) for name in values],
        sum((F.grouping(c) for c in levels[1:]), F.grouping(levels[0])).alias("level"),
    )
    return rolled.withColumn("level", F.col("level").cast("int"))
