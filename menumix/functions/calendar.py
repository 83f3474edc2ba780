"""Fiscal periods, time buckets and date ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.session import rule_frame


def default_calendar(spark: SparkSession) -> DataFrame:
    return rule_frame(
        spark, fv.FISCAL_PERIODS, "period_label string, period_key int, period_start date, period_end date"
    )


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per covered day. Where periods overlap the first one wins."""
    days = calendar.select(
        F.explode(F.sequence("period_start", "period_end")).alias("business_date"),
        "period_label", "period_key", "period_start",
    )
    first = F.min_by(F.struct("period_label", "period_key"), F.struct("period_start", "period_key"))
    return days.groupBy("business_date").agg(first.alias("p")).select("business_date", "p.*")


def assign_period(df: DataFrame, calendar: DataFrame, date_col: str = "business_date") -> DataFrame:
    """Fiscal period of each date, ``Other`` when no period covers it.

    The calendar is unrolled to days, so this is an equality join on a frame of
    a few hundred rows per year instead of a range comparison per row.
    """
    days = calendar_days(calendar).withColumnRenamed("business_date", date_col)
    joined = df.join(days, date_col, "left")
    return joined.withColumn("period_label", F.coalesce("period_label", F.lit("Other")))


def bucket_time(df: DataFrame, granularity: str, calendar: DataFrame | None = None) -> DataFrame:
    """Adds ``bucket``: the day, the Monday of the ISO week, or the period."""
    if granularity == "daily":
        return df.withColumn("bucket", F.col("business_date"))
    if granularity == "weekly":
        return df.withColumn("bucket", F.date_trunc("week", "business_date").cast("date"))
    if granularity == "period":
        return assign_period(df, calendar).withColumn("bucket", F.col("period_label"))
    raise ValueError(f"granularity must be daily, weekly or period, not {granularity!r}")


def weekday_number(col: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(col) + 1


def _month(day: date, back: int = 0) -> tuple[date, date]:
    months = day.year * 12 + day.month - 1 - back
    start = date(months // 12, months % 12 + 1, 1)
    after = months + 1
    return start, date(after // 12, after % 12 + 1, 1) - timedelta(days=1)


def date_range(name: str, today: date, periods: list[tuple] | None = None) -> tuple[date, date]:
    """C17: first and last day of a named range.

    Weeks start on Monday; ``last n weeks`` are the 7n days ending today; a
    custom range is written ``2026-01-05..2026-02-01``.
    """
    key = name.strip().lower()
    monday = today - timedelta(days=today.weekday())
    if ".." in key:
        first, last = key.split("..")
        return date.fromisoformat(first.strip()), date.fromisoformat(last.strip())
    if key == "today":
        return today, today
    if key == "yesterday":
        return today - timedelta(days=1), today - timedelta(days=1)
    if key == "this week":
        return monday, monday + timedelta(days=6)
    if key == "last week":
        return monday - timedelta(days=7), monday - timedelta(days=1)
    if key in ("last 4 weeks", "last 8 weeks"):
        return today - timedelta(days=7 * int(key.split()[1]) - 1), today
    if key == "this month":
        return _month(today)
    if key == "last month":
        return _month(today, 1)
    if key == "ytd":
        return date(today.year, 1, 1), today
    if key.startswith("q") and key[1:2] in "1234":
        year = int(key[2:].strip() or today.year)
        start = date(year, 3 * int(key[1]) - 2, 1)
        return start, _month(date(year, 3 * int(key[1]), 1))[1]
    for label, _, start, end in periods or fv.FISCAL_PERIODS:
        if label.lower() == key:
            return start, end
    raise ValueError(f"unknown date range {name!r}")


def in_range(df: DataFrame, start: date, end: date, date_col: str = "business_date") -> DataFrame:
    return df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))


def date_preset(df: DataFrame, name: str, today: date, periods: list[tuple] | None = None) -> DataFrame:
    return in_range(df, *date_range(name, today, periods))


def prior_range(start: date, end: date) -> tuple[date, date]:
    """The range of the same length that ends the day before ``start``."""
    length = end - start + timedelta(days=1)
    return start - length, start - timedelta(days=1)
