"""Modifier costs and item cost with modifiers.

Modifiers are summed by name before any cost is looked up, so the frames that
meet the cost tables have one row per item, type, name, channel and period.
Costs stay decimal until the last division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.scalars import normalise_modifier_type, ratio
from menumix.operators.filters import filter_revenue
from menumix.operators.joins import modifiers_of_items

COST = "decimal(12,4)"
COST_SUM = "decimal(24,4)"
UNTYPED = "Untyped"


def _name_rules(name: Column) -> tuple[Column, Column]:
    """Name whose cost a derived modifier takes, and the part of it; the last
    matching rule decides. Names matching no rule give null."""
    rules = [
        (name.startswith("Extra "), _from(name, 7), "1"),
        (name.startswith("1/2 "), F.regexp_replace(_from(name, 5), "^and ", ""), "0.5"),
        (name.endswith(" - Side"), _without_tail(name, 7), "1"),
        (name.startswith("Organic "), _from(name, 9), "1"),
        (name.endswith(" - Pick 2 Combo"), F.trim(_without_tail(name, 15)), "1"),
    ]
    base, part = F.lit(None).cast("string"), F.lit(None).cast("decimal(2,1)")
    for matches, target, share in rules:
        base = F.when(matches, target).otherwise(base)
        part = F.when(matches, F.lit(share).cast("decimal(2,1)")).otherwise(part)
    return base, part


def _from(name: Column, position: int) -> Column:
    return F.substring(name, F.lit(position), F.length(name))


def _without_tail(name: Column, n: int) -> Column:
    return F.substring(name, F.lit(1), F.length(name) - n)


def is_zero_cost(name: Column) -> Column:
    return name.rlike(fv.ZERO_COST_PATTERN)


def is_half_and_half(name: Column) -> Column:
    return name.startswith("1/2 and 1/2 ")


def modifier_unit_costs(costs: DataFrame) -> DataFrame:
    """One unit cost per clean modifier name and period from the cost sheets.

    Several recipes may share a clean name; the cheapest priced one stands.
    """
    return (
        costs.filter(F.col("cost_per_portion").isNotNull())
        .groupBy(F.col("clean_name").alias("cost_name"), "period_key")
        .agg(F.min("cost_per_portion").cast(COST).alias("unit_cost"))
    )


def _with_costs(names: DataFrame, costs: DataFrame) -> DataFrame:
    """Adds the name's own cost, that of the name it is made from, and its part."""
    base, part = _name_rules(F.col("canonical_name"))
    own = costs.select(F.col("cost_name").alias("canonical_name"), "period_key", F.col("unit_cost").alias("_own"))
    made = costs.select(F.col("cost_name").alias("_base"), "period_key", F.col("unit_cost").alias("_made"))
    out = names.withColumn("_base", base).withColumn("_part", part)
    return out.join(own, ["canonical_name", "period_key"], "left").join(made, ["_base", "period_key"], "left")


def _unit_cost() -> Column:
    derived = (F.col("_made") * F.col("_part")).cast(COST)
    zero = is_zero_cost(F.col("canonical_name"))
    return F.when(zero, F.lit(0).cast(COST)).otherwise(F.coalesce(derived, F.col("_own")))


def derive_modifier_cost(names: DataFrame, costs: DataFrame) -> DataFrame:
    """G1: adds the unit cost of each row's canonical_name and period_key.

    Extra, half, side, organic and combo names take (part of) the cost of the
    name they are made from, skips and packaging cost nothing, other names
    their own cost. ``costs`` is the output of ``modifier_unit_costs``.
    """
    rule = (
        F.when(is_zero_cost(F.col("canonical_name")), "zero").when(F.col("_made").isNotNull(), "derived")
        .when(F.col("_own").isNotNull(), "listed").otherwise("missing")
    )
    return (
        _with_costs(names, costs).withColumn("unit_cost", _unit_cost()).withColumn("cost_rule", rule)
        .drop("_base", "_part", "_own", "_made")
    )


def modifier_quantities(mods: DataFrame, lines: DataFrame, period: DataFrame | None = None) -> DataFrame:
    """Live modifier quantity per item, channel, type and name (and period).

    ``period`` maps business_date to period_key; without it the period is null.
    Modifiers without a type form the type ``Untyped``.
    """
    joined = modifiers_of_items(mods.filter(~F.col("is_voided")), filter_revenue(lines, "report"))
    if period is None:
        joined = joined.withColumn("period_key", F.lit(None).cast("int"))
    else:
        days = period.select(F.col("business_date").alias("item_date"), "period_key")
        joined = joined.join(days, "item_date", "left")
    return (
        joined.withColumn("mod_type", F.coalesce(normalise_modifier_type(F.col("mod_type")), F.lit(UNTYPED)))
        .groupBy("item_name", "channel_code", "period_key", "mod_type", "canonical_name")
        .agg(F.sum("quantity").alias("quantity"))
    )


def _is_half(name: Column) -> Column:
    return name.startswith("1/2 ") & ~is_half_and_half(name)


QUANTITY = "decimal(20,4)"
GROUP = ["item_name", "channel_code", "period_key", "mod_type"]


def half_and_half_cost(quantities: DataFrame, costs: DataFrame) -> DataFrame:
    """Cost of a "1/2 and 1/2" choice per item, channel, period and type.

    The mean cost of the full versions of the halves that were chosen, weighted
    by quantity; null when there were none.
    """
    halves = _with_costs(quantities.filter(_is_half(F.col("canonical_name"))), costs)
    return halves.groupBy(*GROUP).agg(
        F.sum(F.col("quantity").cast(QUANTITY) * F.col("_made")).cast(COST_SUM).alias("half_amount"),
        F.sum("quantity").alias("half_quantity"),
    ).withColumn("half_cost", ratio(F.col("half_amount"), F.col("half_quantity")))


def _is_untyped() -> Column:
    return F.col("mod_type").isNull() | (F.col("mod_type") == UNTYPED)


def channel_modifier_scope(df: DataFrame, online: list[str] | None = None, counter: list[str] | None = None) -> DataFrame:
    """Online channels record every type, the others only mains and meals.

    Untyped modifiers may be either and stay in every channel.
    """
    online = fv.ONLINE_CHANNELS if online is None else online
    counter = fv.COUNTER_MODIFIER_TYPES if counter is None else counter
    return df.filter(F.col("channel_code").isin(online) | F.col("mod_type").isin(counter) | _is_untyped())


def plates_rule(
    df: DataFrame, sub_category: str = "sub_category", plate: str = fv.PLATE_SUBCATEGORY, items: list[str] | None = None
) -> DataFrame:
    """Plates come with their main, so mains and extra mains cost nothing more.

    A plate has the sub-category or is one of the named ``items``.
    """
    named = F.col("item_name").isin(fv.PLATE_ITEMS if items is None else items) if "item_name" in df.columns else F.lit(False)
    plates = F.coalesce(F.col(sub_category) == plate, F.lit(False)) | F.coalesce(named, F.lit(False))
    return df.filter(~(plates & F.coalesce(F.col("mod_type").isin(fv.PLATE_DROPPED_TYPES), F.lit(False))))


def modifier_cost_by_type(quantities: DataFrame, costs: DataFrame) -> DataFrame:
    """Modifier cost per item, channel, period and type, with the quantity
    that found no cost. ``quantities`` is the output of ``modifier_quantities``.
    Untyped modifiers take no cost: all of their quantity is unpriced.

    One aggregation holds both the plain sums and the weighted halves (as in
    ``half_and_half_cost``) that price the "1/2 and 1/2" choices.
    """
    name, q = F.col("canonical_name"), F.col("quantity").cast(QUANTITY)
    both, half = is_half_and_half(name), _is_half(name)
    unit = F.when(~_is_untyped(), _unit_cost())
    sums = _with_costs(quantities, costs).groupBy(*GROUP).agg(
        F.sum(F.when(~both, (q * unit).cast(COST_SUM))).alias("_plain"),
        F.sum(F.when(~both & unit.isNull(), q)).alias("_unpriced"),
        F.sum(F.when(both, q)).alias("_both"),
        F.sum(F.when(half, q * F.col("_made"))).cast(COST_SUM).alias("_half_amount"),
        F.sum(F.when(half, q)).alias("_half_quantity"),
        F.sum("quantity").alias("modifier_quantity"),
    )
    halves = F.col("_both").cast("double") * ratio(F.col("_half_amount"), F.col("_half_quantity"))
    mixed = F.when(~_is_untyped(), halves.cast(COST_SUM))
    zero = F.lit(0).cast(COST_SUM)
    return sums.select(
        *GROUP,
        F.when(F.col("_plain").isNull() & mixed.isNull(), F.lit(None))
        .otherwise(F.coalesce("_plain", zero) + F.coalesce(mixed, zero)).cast(COST_SUM).alias("type_cost"),
        "modifier_quantity",
        (F.coalesce("_unpriced", zero) + F.when(mixed.isNull(), F.coalesce("_both", zero)).otherwise(zero))
        .alias("unpriced_quantity"),
    )


NO_UPLIFT_CATEGORIES = ["Sides", "NA Drinks", "Sweets", "Retail", "Alc Drinks"]


def avg_cost_with_modifiers(
    items: DataFrame,
    type_costs: DataFrame,
    third_party: str = "TPD",
    rate: str = fv.THIRD_PARTY_COST_RATE,
    no_uplift: list[str] | None = None,
) -> DataFrame:
    """Total and unit cost of an item including its modifiers.

    ``items`` has canonical_name, channel_code, period_key, quantity, base unit
    cost ``base_cost`` and ``category``; ``type_costs`` comes from
    ``modifier_cost_by_type`` after G4 and G5. Third-party modifiers carry the
    surcharge; categories that are not built to order have no modifier cost.
    ``unpriced_quantity`` is the modifier quantity that found no cost and
    counts as 0. Rows without a period meet type costs without one.
    """
    plain = NO_UPLIFT_CATEGORIES if no_uplift is None else no_uplift
    # Type costs from elsewhere may not say what they left unpriced.
    unpriced = F.sum("unpriced_quantity") if "unpriced_quantity" in type_costs.columns else F.lit(0)
    totals = (
        type_costs.groupBy(F.col("item_name").alias("canonical_name"), "channel_code", "period_key")
        .agg(F.sum("type_cost").cast(COST_SUM).alias("modifier_cost"), unpriced.alias("_unpriced"))
        .withColumnRenamed("period_key", "_period")
    )
    out = items.alias("i").join(
        totals.alias("t"), (F.col("i.canonical_name") == F.col("t.canonical_name")) & (F.col("i.channel_code") == F.col("t.channel_code"))
        & F.col("i.period_key").eqNullSafe(F.col("t._period")), "left"
    ).select("i.*", "t.modifier_cost", "t._unpriced")
    built = ~F.coalesce(F.col("category").isin(plain), F.lit(False))
    factor = F.when(F.col("channel_code") == third_party, F.lit(rate)).otherwise(F.lit("1")).cast("decimal(3,2)")
    modifiers = F.when(built, F.coalesce("modifier_cost", F.lit(0).cast(COST_SUM)) * factor).otherwise(F.lit(0))
    base = F.col("base_cost") * F.col("quantity").cast("decimal(20,4)")
    return (
        out.withColumn("total_modifier_cost", modifiers.cast("decimal(28,4)"))
        .withColumn("total_base_cost", base.cast("decimal(28,4)"))
        .withColumn("total_cost", (F.col("total_base_cost") + F.col("total_modifier_cost")).cast("decimal(28,4)"))
        .withColumn("avg_cost", ratio(F.col("total_cost"), F.col("quantity")))
        .withColumn("unpriced_quantity", F.when(built, F.coalesce("_unpriced", F.lit(0))).otherwise(F.lit(0)).cast(COST_SUM))
        .drop("modifier_cost", "_unpriced")
    )
