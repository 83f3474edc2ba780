"""Channel attribution, inclusion rules, scope filters and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.calendar import weekday_number
from menumix.functions.scalars import is_blank, lookup_literal, matches_any
from menumix.session import rule_frame


# --- C8 ------------------------------------------------------------------------
def payment_channel(alt_payment: Column, patterns: list | None = None) -> Column:
    """Channel named by the paying vendor alone, null when none matches."""
    expr = F.lit(None).cast("string")
    for channel, words in reversed(patterns or fv.PAYMENT_CHANNEL_PATTERNS):
        expr = F.when(matches_any(alt_payment, words), channel).otherwise(expr)
    return expr


def line_channel(patterns: list | None = None, default: str | None = fv.DEFAULT_CHANNEL) -> Column:
    """Channel named by line columns (dining option, sales category)."""
    expr = F.lit(default)
    for channel, column, words in reversed(patterns or fv.LINE_CHANNEL_PATTERNS):
        expr = F.when(matches_any(F.col(column), words), channel).otherwise(expr)
    return expr


def attribute_channel(
    df: DataFrame,
    payment_patterns: list | None = None,
    line_patterns: list | None = None,
    override: str | None = None,
    alt_payment: str = "alt_payment_name",
    paid_channel: str | None = None,
    out: str = "channel_code",
) -> DataFrame:
    """Manual override, then payment rules, then line rules, then in-house.

    ``paid_channel`` names a column that already holds the payment rules' result,
    worked out once per order instead of once per line.
    """
    paid = F.col(paid_channel) if paid_channel else payment_channel(F.col(alt_payment), payment_patterns)
    steps = [paid, line_channel(line_patterns)]
    if override:
        steps.insert(0, F.col(override))
    return df.withColumn(out, F.coalesce(*steps))


# --- C9, C10, C11 ----------------------------------------------------------------
def filter_revenue(df: DataFrame, mode: str = "report") -> DataFrame:
    """``load`` drops voids only (pipeline checks), ``report`` also drops deferred lines."""
    kept = df.filter(~F.col("is_voided"))
    if mode == "load":
        return kept
    if mode == "report":
        return kept.filter(~F.col("is_deferred"))
    raise ValueError(f"mode must be load or report, not {mode!r}")


def inclusion_rule(df: DataFrame) -> DataFrame:
    """Report lines; a line without menu group but with a sales category is
    an open item, one with neither is a ghost row and goes."""
    kept = filter_revenue(df, "report")
    no_group, no_category = is_blank(F.col("menu_group")), is_blank(F.col("sales_category"))
    return kept.filter(~(no_group & no_category)).withColumn("is_open_item", no_group)


def real_menu_items(
    df: DataFrame, menus: list[str] | None = None, groups: list[str] | None = None, items: list[str] | None = None
) -> DataFrame:
    """C11: drop operational menus, groups and items; unknown (null) values stay."""
    def outside(column: str, values: list[str]) -> Column:
        return F.coalesce(~F.col(column).isin(values), F.lit(True))

    return df.filter(
        outside("menu_name", fv.EXCLUDED_MENUS if menus is None else menus)
        & outside("menu_group", fv.EXCLUDED_GROUPS if groups is None else groups)
        & outside("canonical_name", fv.EXCLUDED_ITEMS if items is None else items)
    )


# --- C12, C13 --------------------------------------------------------------------
def category_rules(spark: SparkSession) -> dict[str, DataFrame]:
    """Default rule tables for ``resolve_category``."""
    return {
        "groups": rule_frame(spark, fv.GROUP_CATEGORIES, "menu_group string, category string, sub_category string"),
        "items": rule_frame(spark, fv.ITEM_CATEGORIES, "canonical_name string, category string, sub_category string"),
        "subs": rule_frame(spark, fv.SUBCATEGORY_CATEGORIES, "sub_category string, category string"),
    }


def lookup_one_per_name(lookup: DataFrame, operational: list[str] | None = None) -> DataFrame:
    """Newest lookup row per cleaned name, operational names removed."""
    names = fv.OPERATIONAL_ITEMS if operational is None else operational
    newest = F.max_by(F.struct("category_1", "category_2"), F.struct("loaded_at", "raw_item_name"))
    return (
        lookup.filter(~F.col("cleaned_item_name").isin(names))
        .groupBy("cleaned_item_name").agg(newest.alias("r"))
        .select("cleaned_item_name", "r.category_1", "r.category_2")
    )


def resolve_category(
    df: DataFrame, rules: dict[str, DataFrame], lookup: DataFrame | None = None, offsite_menu: str = fv.OFFSITE_MENU
) -> DataFrame:
    """Category and sub-category of each line.

    Item override, menu group, then the lookup's sub-category. On the offsite
    menu the group is the vendor and is itself the category. ``lookup`` is the
    output of ``lookup_one_per_name``; a null category marks an open item.
    """
    items = rules["items"].select("canonical_name", F.col("category").alias("_ic"), F.col("sub_category").alias("_is"))
    groups = rules["groups"].select("menu_group", F.col("category").alias("_gc"), F.col("sub_category").alias("_gs"))
    out = df.join(items, "canonical_name", "left").join(groups, "menu_group", "left")
    if lookup is None:
        out = out.withColumn("_ls", F.lit(None).cast("string")).withColumn("_lc", F.lit(None).cast("string"))
    else:
        subs = rules["subs"].select(F.col("sub_category").alias("_ls"), F.col("category").alias("_lc"))
        known = lookup.select(F.col("cleaned_item_name").alias("canonical_name"), F.col("category_2").alias("_ls"))
        out = out.join(known.join(subs, "_ls", "left"), "canonical_name", "left")
    offsite = F.coalesce(F.col("menu_name") == offsite_menu, F.lit(False))
    category = F.when(offsite, F.col("menu_group")).otherwise(F.coalesce("_ic", "_gc", "_lc"))
    sub_category = F.when(~offsite, F.coalesce("_is", "_gs", "_ls"))
    return (
        out.withColumn("category", category).withColumn("sub_category", sub_category)
        .drop("_ic", "_is", "_gc", "_gs", "_ls", "_lc")
    )


def category_position(category: Column) -> Column:
    """Place of a category in the fixed display order; others come last."""
    pairs = [(name, str(i)) for i, name in enumerate(fv.CATEGORY_ORDER)]
    return F.coalesce(lookup_literal(category, pairs).cast("int"), F.lit(len(pairs)))


# --- C18, C19, C20 ---------------------------------------------------------------
def scope(
    df: DataFrame,
    locations: list[str] | None = None,
    channels: list[str] | None = None,
    menus: list[str] | None = None,
    search: str | None = None,
) -> DataFrame:
    """The global filter bar; an empty choice means all."""
    for column, values in (("location_code", locations), ("channel_code", channels), ("menu_name", menus)):
        if values:
            df = df.filter(F.col(column).isin(values))
    if search:
        literal = search.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        df = df.filter(F.col("canonical_name").ilike(f"%{literal}%"))
    return df


def split_name_check(df: DataFrame, pattern: str = "%- %", n: int = 15) -> DataFrame:
    """Names that look like an unstripped variant, by quantity."""
    return (
        filter_revenue(df, "load").filter(F.col("canonical_name").ilike(pattern))
        .groupBy("canonical_name")
        .agg(F.countDistinct("location_code").alias("locations"), F.sum("quantity").alias("quantity"))
        .orderBy(F.desc("quantity"), "canonical_name").limit(n)
    )


def day_of_week(df: DataFrame) -> DataFrame:
    """C20: distinct orders and revenue per weekday, Monday first."""
    return df.groupBy(weekday_number(F.col("business_date")).alias("weekday")).agg(
        F.countDistinct("order_guid").alias("orders"), F.sum("line_total").alias("net_sales")
    )
