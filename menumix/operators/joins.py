"""Joins of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.scalars import natural_key, normalise_external_name


def attach_item_key(lines: DataFrame, dim_item: DataFrame) -> DataFrame:
    """Surrogate item key by natural key (item guid, else location and raw name)."""
    keyed = lines.withColumn(
        "natural_key", natural_key(F.col("item_guid"), F.col("location_code"), F.col("raw_name"))
    )
    return keyed.join(dim_item.select("natural_key", "item_key"), "natural_key", "left")


def attach_override(lines: DataFrame, override: DataFrame) -> DataFrame:
    """Manual channel of the order, null when none was set."""
    table = override.select("order_guid", F.col("channel_code").alias("override_channel"))
    return lines.join(table, "order_guid", "left")


def vendor_per_order(payments: DataFrame) -> DataFrame:
    """The vendor that paid most of each order, nulls last, guid breaking ties.

    One aggregation with map-side combine, so an order with very many payments
    is reduced before the shuffle.
    """
    rank = F.struct(F.col("amount").isNull(), -F.col("amount"), F.col("payment_guid"))
    return (
        payments.filter(F.col("alt_payment_name").isNotNull())
        .groupBy("order_guid").agg(F.min_by("alt_payment_name", rank).alias("alt_payment_name"))
    )


def top_payment(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """D3: the outer side of D4: every line, with its order's vendor or null."""
    return lines.join(vendor_per_order(payments), "order_guid", "left")


def attach_modifier_type(mods: DataFrame, dim_modifier: DataFrame) -> DataFrame:
    """Type by canonical name; blocklisted modifiers do not reach the facts."""
    types = dim_modifier.select("canonical_name", "mod_type")
    return mods.filter(~F.col("is_blocklisted")).join(types, "canonical_name", "left")


def orphan_modifiers(mods: DataFrame, lines: DataFrame) -> DataFrame:
    """Modifiers whose selection is missing."""
    guids = lines.select(F.col("selection_guid").alias("parent_selection"))
    return mods.join(guids, "parent_selection", "left_anti")


def restrict_to(lines: DataFrame, staged: DataFrame) -> DataFrame:
    """Lines whose selection was staged in this run."""
    return lines.join(staged.select("selection_guid"), "selection_guid", "left_semi")


def line_totals(lines: DataFrame) -> DataFrame:
    """One row: line count and non-void revenue."""
    revenue = F.sum(F.when(~F.col("is_voided"), F.col("line_total")))
    return lines.agg(
        F.count("*").alias("n_lines"), F.round(F.coalesce(revenue, F.lit(0)), 2).alias("revenue")
    )


def compare_totals(staged: DataFrame, public: DataFrame) -> DataFrame:
    """Both one-row totals side by side, the second as scalar subqueries."""
    other = line_totals(public)
    return line_totals(staged).select(
        F.col("n_lines").alias("staged_lines"),
        other.select("n_lines").scalar().alias("public_lines"),
        F.col("revenue").alias("staged_revenue"),
        other.select("revenue").scalar().alias("public_revenue"),
    )


def cost_lookup(items: DataFrame, cost: DataFrame, exempt: list[str] | None = None) -> DataFrame:
    """Unit cost of an item: its location and period, else company-wide in the
    period, else its newest period, else null.

    ``items`` has canonical_name, period_key and, when costs carry a location,
    location_code. ``cost`` has item_name, period_key, avg_cost and optionally
    location_code (null for company-wide rows). Adds avg_cost, cost_source and
    the ``no_cost`` flag.
    """
    by_location = "location_code" in cost.columns and "location_code" in items.columns
    company = cost.filter(F.col("location_code").isNull()) if "location_code" in cost.columns else cost
    priced = company.filter(F.col("avg_cost").isNotNull())
    c2 = priced.groupBy(F.col("item_name").alias("canonical_name"), "period_key").agg(F.min("avg_cost").alias("_c2"))
    # Newest period over every priced row; company-wide rows come first within it.
    place = F.col("location_code").isNotNull() if "location_code" in cost.columns else F.lit(False)
    newest = F.min_by("avg_cost", F.struct(-F.col("period_key"), place, F.col("avg_cost")))
    c3 = (
        cost.filter(F.col("avg_cost").isNotNull())
        .groupBy(F.col("item_name").alias("canonical_name")).agg(newest.alias("_c3"))
    )
    out = items
    if by_location:
        c1 = (
            cost.filter(F.col("avg_cost").isNotNull() & F.col("location_code").isNotNull())
            .groupBy(F.col("item_name").alias("canonical_name"), "period_key", "location_code")
            .agg(F.min("avg_cost").alias("_c1"))
        )
        out = out.join(c1, ["canonical_name", "period_key", "location_code"], "left")
    else:
        out = out.withColumn("_c1", F.lit(None).cast(cost.schema["avg_cost"].dataType))
    out = out.join(c2, ["canonical_name", "period_key"], "left").join(c3, "canonical_name", "left")
    source = (
        F.when(F.col("_c1").isNotNull(), "location").when(F.col("_c2").isNotNull(), "period")
        .when(F.col("_c3").isNotNull(), "latest")
    )
    exempt_names = fv.NO_COST_EXPECTED if exempt is None else exempt
    return (
        out.withColumn("avg_cost", F.coalesce("_c1", "_c2", "_c3"))
        .withColumn("cost_source", source)
        .withColumn("no_cost", F.col("avg_cost").isNull() & ~F.col("canonical_name").isin(exempt_names))
        .drop("_c1", "_c2", "_c3")
    )


def attach_retention(items: DataFrame, retention: DataFrame) -> DataFrame:
    """Retention of each item by canonical name (after the alias rules).

    Items that say their ``fiscal_year`` and ``period`` meet the figures of that
    period only, so several periods can be attached at once; items without
    them meet every period in ``retention``.
    """
    named = retention.withColumn("canonical_name", normalise_external_name(F.col("item_name"))).drop("item_name")
    dated = [c for c in ("fiscal_year", "period") if c in items.columns and c in named.columns]
    return items.join(named, ["canonical_name", *dated], "left")


def modifiers_of_items(mods: DataFrame, lines: DataFrame) -> DataFrame:
    """Modifiers with name, channel, location and date of their parent line.

    AQE splits a selection that owns a large share of all modifiers.
    """
    parents = lines.select(
        F.col("selection_guid").alias("parent_selection"),
        F.col("canonical_name").alias("item_name"),
        "channel_code",
        F.col("location_code").alias("item_location"),
        F.col("business_date").alias("item_date"),
        F.col("order_guid").alias("item_order"),
    )
    return mods.join(parents, "parent_selection", "inner")
