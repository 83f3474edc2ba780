"""The menu-engineering request as one chain: from order lines to costed, classified items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menumix.operators import clean, costing, engineering, filters, joins, reports


def menu_report(
    lines: DataFrame,
    type_costs: DataFrame,
    item_costs: DataFrame,
    days: DataFrame,
    rules: dict[str, DataFrame],
    exclusions: DataFrame,
    lookup: DataFrame | None = None,
    strict: bool = True,
    by: list[str] = (),
) -> DataFrame:
    """One row per item and channel with categories, costs, shares and quadrant.

    Inclusion, operational and mix exclusions (C10, C11, C5), category (C12),
    period (C15), unit cost with its fallbacks (D9), modifier cost (G7), metrics
    (F5) and quadrants (G8), in the order of the specification. ``lines`` may be
    narrowed by ``filters.scope`` first; ``type_costs`` comes from
    ``modifier_cost_by_type`` after the channel and plates rules; ``days`` maps
    business_date to period_key. Items without cost keep null costs and stay out of the
    classification, as do open items and those without category.
    """
    kept = filters.real_menu_items(filters.inclusion_rule(lines))
    kept = filters.resolve_category(clean.exclude_from_mix(kept, "canonical_name", exclusions), rules, lookup)
    kept = kept.join(days, "business_date", "left")
    # Lines shrink to items, channels and periods before any cost is joined.
    sold = kept.groupBy("canonical_name", "channel_code", "period_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("net_sales"), F.max("category").alias("category"),
        F.max("sub_category").alias("sub_category"), F.min("is_open_item").alias("is_open_item"),
    )
    priced = joins.cost_lookup(sold, item_costs).withColumnRenamed("avg_cost", "base_cost")
    costed = costing.avg_cost_with_modifiers(priced, type_costs)
    known = F.count("total_cost") == F.count(F.lit(1))
    items = costed.groupBy("canonical_name", "channel_code").agg(
        F.sum("quantity").alias("quantity"), F.sum("net_sales").alias("net_sales"), F.max("category").alias("category"),
        F.max("sub_category").alias("sub_category"), F.min("is_open_item").alias("is_open_item"),
        F.when(known, F.sum("total_cost")).alias("total_cost"), F.sum("unpriced_quantity").alias("unpriced_quantity"),
        F.max("no_cost").alias("no_cost"),
    )
    return engineering.menu_engineering(reports.item_metrics(items), strict, by)
