"""Report aggregates.

Inputs are order lines (or payments, modifiers, item frames). Every report
aggregates with partial sums first, so a hot item, order or location is
reduced on the map side and never gathered as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.calendar import assign_period, bucket_time
from menumix.functions.scalars import is_blank, ratio, retention_band
from menumix.operators.filters import category_position, filter_revenue, payment_channel
from menumix.operators.joins import compare_totals, modifiers_of_items, orphan_modifiers, restrict_to
from menumix.operators.shares import share_of, shares_of

def _sales(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("line_total").alias("net_sales"), F.sum("quantity").alias("quantity"))


# --- F1 to F4 ------------------------------------------------------------------
def revenue_by(df: DataFrame, keys: list[str], mode: str = "load") -> DataFrame:
    """lines, sales and quantity by any columns."""
    kept = filter_revenue(df, mode)
    return kept.groupBy(*keys).agg(
        F.count("*").alias("n_lines"), F.sum("line_total").alias("net_sales"), F.sum("quantity").alias("quantity")
    )


def location_reconciliation(df: DataFrame, start, end) -> DataFrame:
    """rows, live sales, void amount and unattributed lines per location."""
    void = F.col("is_voided")
    return (
        df.filter(F.col("business_date").between(F.lit(start), F.lit(end)))
        .groupBy("location_code")
        .agg(
            F.count("*").alias("n_lines"),
            F.round(F.sum(F.when(~void, F.col("line_total"))), 2).alias("net_item_sales"),
            F.round(F.sum(F.when(void, F.col("line_total"))), 2).alias("voided_amount"),
            F.count_if(F.col("channel_code") == "OTHER").alias("unattributed"),
        )
    )


def validate(staged: DataFrame, public: DataFrame, mods: DataFrame) -> DataFrame:
    """the five counters printed after each run, as (check, value) rows."""
    revenue = F.sum(F.when(~F.col("is_voided"), F.col("line_total")))
    staged_counts = staged.agg(F.count("*").alias("a"), F.round(F.coalesce(revenue, F.lit(0)), 2).alias("b"))
    public_counts = public.agg(F.count("*").alias("a"), F.count_if(F.col("channel_code").isNull()).alias("b"))
    orphans = orphan_modifiers(mods, public).agg(F.count("*").alias("a"))

    def rows(counts: DataFrame, first: str, second: str | None = None) -> DataFrame:
        """Both counters of an aggregate as rows, so that its table is read once."""
        pairs = [(first, "a")] + ([(second, "b")] if second else [])
        entries = F.array(*[F.struct(F.lit(label).alias("check"), F.col(c).cast("decimal(28,4)").alias("value")) for label, c in pairs])
        return counts.select(F.inline(entries))

    return (
        rows(staged_counts, "staging lines", "staging revenue (non-void)")
        .unionByName(rows(public_counts, "public lines", "lines missing channel"))
        .unionByName(rows(orphans, "orphan modifiers"))
    )


def drift(staged: DataFrame, public: DataFrame, tol: str = "0.01") -> DataFrame:
    """staged rows and revenue against the public rows they became."""
    totals = compare_totals(staged, restrict_to(public, staged))
    same_rows = F.col("staged_lines") == F.col("public_lines")
    gap = F.abs(F.col("staged_revenue") - F.col("public_revenue"))
    return totals.withColumn("ok", same_rows & (gap < F.lit(tol).cast("decimal(18,4)")))


# --- F5 to F8 ------------------------------------------------------------------
def item_sales(lines: DataFrame, keys: list[str] = ("canonical_name", "channel_code")) -> DataFrame:
    """Quantity, sales and line count per item; the grain of the item reports."""
    return lines.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("net_sales"), F.count("*").alias("n_lines")
    )


def item_metrics(items: DataFrame, scope_by: list[str] = ()) -> DataFrame:
    """price, cost, margin and mix columns of an item frame.

    Needs quantity, net_sales and either ``total_cost`` or unit ``avg_cost``.
    Margin per cent comes from totals, never from averaged item margins.
    """
    if "total_cost" not in items.columns:
        items = items.withColumn("total_cost", F.col("avg_cost") * F.col("quantity").cast("decimal(24,4)"))
    if "avg_cost" not in items.columns:
        items = items.withColumn("avg_cost", ratio(F.col("total_cost"), F.col("quantity")))
    out = (
        items.withColumn("avg_price", ratio(F.col("net_sales"), F.col("quantity")))
        .withColumn("cogs_pct", ratio(F.col("total_cost"), F.col("net_sales")))
        .withColumn("margin_pct", F.lit(1.0) - F.col("cogs_pct"))
        .withColumn("margin", F.col("avg_price") - F.col("avg_cost").cast("double"))
        .withColumn("total_margin", F.col("net_sales") - F.col("total_cost"))
    )
    return shares_of(out, {"quantity": "menu_mix_pct", "net_sales": "sls_pct"}, scope_by)


def blended_metrics(items: DataFrame, keys: list[str] = ("canonical_name",)) -> DataFrame:
    """weighted price, cost and margin over channels.

    Cost and margin speak of the rows with a known cost only; the sales of the
    others stand beside them as ``unpriced_sales``.
    """
    priced = F.col("total_cost").isNotNull()
    sums = items.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("net_sales").alias("net_sales"),
        F.sum("total_cost").alias("total_cost"),
        F.sum(F.when(priced, F.col("quantity"))).alias("_quantity"), F.sum(F.when(priced, F.col("net_sales"))).alias("_sales"),
        F.coalesce(F.sum(F.when(~priced, F.col("net_sales"))), F.lit(0)).alias("unpriced_sales"),
    )
    return (
        sums.withColumn("blended_avg_price", ratio(F.col("net_sales"), F.col("quantity")))
        .withColumn("blended_avg_cost", ratio(F.col("total_cost"), F.col("_quantity")))
        .withColumn("blended_margin", F.lit(1.0) - ratio(F.col("total_cost"), F.col("_sales")))
        .drop("_quantity", "_sales")
    )


def kpi_summary(items: DataFrame) -> DataFrame:
    """one row of headline figures from an item frame with total_margin.

    The margin is that of the rows with a known margin over their own sales;
    sales without one are ``unpriced_sales``.
    """
    priced = F.col("total_margin").isNotNull()
    per_item = items.groupBy("canonical_name").agg(
        F.sum("quantity").alias("q"), F.sum("net_sales").alias("s"), F.sum("total_margin").alias("m"),
        F.sum(F.when(priced, F.col("net_sales"))).alias("p"), F.sum(F.when(~priced, F.col("net_sales"))).alias("u"),
    )
    top = F.max_by(F.struct("canonical_name", "s", "q"), F.struct("s", "canonical_name"))
    one = per_item.agg(
        F.sum("q").alias("items_sold"), F.sum("s").alias("net_revenue"),
        ratio(F.sum("m"), F.sum("p")).alias("avg_margin_pct"), F.coalesce(F.sum("u"), F.lit(0)).alias("unpriced_sales"),
        F.count("*").alias("unique_items"), top.alias("t"),
    )
    return one.select(
        "items_sold", "net_revenue", "avg_margin_pct", "unpriced_sales", "unique_items",
        F.col("t.canonical_name").alias("top_item"), F.col("t.s").alias("top_item_sales"),
        ratio(F.col("t.q"), F.col("items_sold")).alias("top_item_mix_pct"),
    )


def item_mix(lines: DataFrame, keys: list[str] = ("canonical_name", "menu_group")) -> DataFrame:
    """the item-mix table: quantity, revenue, price, part of the mix, orders."""
    sums = lines.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("net_sales"),
        F.countDistinct("order_guid").alias("orders"),
    )
    priced = sums.withColumn("avg_price", ratio(F.col("net_sales"), F.col("quantity")))
    return share_of(priced, "quantity", out="menu_mix_pct")


def trend(lines: DataFrame, granularity: str, calendar: DataFrame | None = None, by: list[str] = ()) -> DataFrame:
    """F8: sales and quantity per time bucket, optionally per channel."""
    return _sales(bucket_time(lines, granularity, calendar), ["bucket", *by])


# --- F9 to F12 -----------------------------------------------------------------
def category_mix(lines: DataFrame, by: list[str] = ()) -> DataFrame:
    """sales by category with its share overall or within ``by``."""
    sums = _sales(lines, [*by, "category"])
    mixed = share_of(sums, "net_sales", by, "category_mix_pct")
    return mixed.withColumn("category_position", category_position(F.col("category")))


def location_matrix(
    lines: DataFrame, locations: list[str], metric: str = "revenue", top_n: int | None = 20
) -> DataFrame:
    """one row per item, one column per location, null where unsold.

    ``metric`` is revenue, quantity or mix (quantity share within the location).
    ``avg`` is the mean over listed locations that sold the item; what unlisted
    locations sold is summed up in ``other``.
    """
    cells = _sales(lines, ["canonical_name", "location_code"])
    if metric == "mix":
        cells = share_of(cells, "quantity", ["location_code"], "cell")
    else:
        cells = cells.withColumn("cell", F.col("net_sales" if metric == "revenue" else "quantity"))
    place = F.when(F.col("location_code").isin(locations), F.col("location_code")).otherwise("other")
    wide = cells.groupBy("canonical_name", place.alias("_place")).agg(F.sum("cell").alias("cell"))
    wide = wide.groupBy("canonical_name").pivot("_place", [*locations, "other"]).agg(F.sum("cell"))
    pairs = F.array_compact(F.array(*[
        F.when(F.col(f"`{name}`").isNotNull(),
               F.struct(F.col(f"`{name}`").alias("v"), F.lit(-i).alias("p"), F.lit(name).alias("n")))
        for i, name in enumerate(locations)
    ]))
    total = sum((F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in locations[1:]),
                F.coalesce(F.col(f"`{locations[0]}`"), F.lit(0)))
    out = (
        wide.withColumn("_pairs", pairs)
        .withColumn("avg", ratio(total, F.size("_pairs")))
        .withColumn("best_location", F.array_max("_pairs")["n"])
        .drop("_pairs")
    )
    return out if top_n is None else out.orderBy(F.desc_nulls_last("avg"), "canonical_name").limit(top_n)


def channel_split(lines: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """item sales per channel side by side, those of unlisted channels, and
    the total of all."""
    names = channels or [code for code, _ in fv.CHANNELS]
    sums = lines.groupBy("canonical_name", "channel_code").agg(F.sum("line_total").alias("s"))
    channel = F.when(F.col("channel_code").isin(names), F.col("channel_code")).otherwise("unlisted")
    sums = sums.groupBy("canonical_name", channel.alias("_channel")).agg(F.sum("s").alias("s"))
    names = [*names, "unlisted"]
    wide = sums.groupBy("canonical_name").pivot("_channel", names).agg(F.sum("s"))
    cells = [F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in names]
    return wide.select(
        "canonical_name", *[c.alias(n.lower()) for c, n in zip(cells, names)], sum(cells[1:], cells[0]).alias("total")
    )


def location_cards(lines: DataFrame) -> DataFrame:
    """revenue, items sold and part of the group per location."""
    sums = _sales(lines, ["location_code"])
    shared = shares_of(sums, {"net_sales": "revenue_share", "quantity": "menu_mix_pct"})
    return shared.withColumnsRenamed({"net_sales": "revenue", "quantity": "items_sold"})


# --- F13 to F15 ----------------------------------------------------------------
def vendor_breakdown(lines: DataFrame, channel: str, vendor: str | None = None) -> DataFrame:
    """orders, revenue, order value and share per vendor of one channel.

    Offsite vendors are menu groups; elsewhere the paying name is the vendor.
    """
    column = vendor or ("menu_group" if channel == "OFFSITE" else "alt_payment_name")
    sums = (
        lines.filter(F.col("channel_code") == channel).groupBy(F.col(column).alias("vendor"))
        .agg(F.countDistinct("order_guid").alias("orders"), F.sum("line_total").alias("revenue"))
    )
    sums = sums.withColumn("avg_order_value", ratio(F.col("revenue"), F.col("orders")))
    return share_of(sums, "revenue", out="share")


def channel_kpis(lines: DataFrame, channel: str) -> DataFrame:
    """revenue, orders, order value and part of all sales of one channel."""
    mine = F.col("channel_code") == channel
    sums = lines.agg(
        F.sum(F.when(mine, F.col("line_total"))).alias("revenue"),
        F.countDistinct(F.when(mine, F.col("order_guid"))).alias("orders"),
        F.sum("line_total").alias("_all"),
    )
    return sums.select(
        "revenue", "orders", ratio(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
        ratio(F.col("revenue"), F.col("_all")).alias("share"),
    )


def payment_mix(payments: DataFrame, keys: list[str] = ("source", "payment_type")) -> DataFrame:
    """count, revenue, ticket and share by paying source, type or location.

    The source is the alternative payment's name, else the payment type.
    """
    named = payments.withColumn("source", F.coalesce("alt_payment_name", "payment_type"))
    sums = named.groupBy(*keys).agg(F.count("*").alias("payments"), F.sum("amount").alias("revenue"))
    sums = sums.withColumn("avg_ticket", ratio(F.col("revenue"), F.col("payments")))
    return share_of(sums, "revenue", out="share")


def byo_breakdown(
    mods: DataFrame, lines: DataFrame, items: list[str] | None = None, channels: list[str] | None = None
) -> DataFrame:
    """per modifier type, how often each modifier was chosen, its part of
    the type and the part of the parent items' orders that carry it. Modifiers
    without a type form the group ``Untyped``."""
    parents = filter_revenue(lines, "report")
    if items:
        parents = parents.filter(F.col("canonical_name").isin(items))
    if channels:
        parents = parents.filter(F.col("channel_code").isin(channels))
    joined = modifiers_of_items(mods.filter(~F.col("is_voided")), parents)
    joined = joined.withColumn("mod_type", F.coalesce("mod_type", F.lit("Untyped")))
    sums = joined.groupBy("mod_type", "canonical_name").agg(
        F.sum("quantity").alias("quantity"), F.countDistinct("item_order").alias("orders")
    )
    all_orders = parents.agg(F.countDistinct("order_guid").alias("n")).scalar()
    sums = sums.withColumn("order_share", ratio(F.col("orders"), all_orders))
    return share_of(sums, "quantity", ["mod_type"], "type_share")


# --- F16 to F18 ----------------------------------------------------------------
def renames_audit(lines: DataFrame) -> DataFrame:
    """F16: items that were sold under more than one raw name.

    Rows are reduced to (item, raw name, location) first, so the name list of
    an item is built from its distinct names only.
    """
    live = F.when(~F.col("is_voided"), F.col("quantity")), F.when(~F.col("is_voided"), F.col("line_total"))
    finest = lines.groupBy("canonical_name", "raw_name", "location_code").agg(
        F.sum(live[0]).alias("q"), F.sum(live[1]).alias("s"), F.min("business_date").alias("d")
    )
    return (
        finest.groupBy("canonical_name")
        .agg(
            F.array_sort(F.collect_set("raw_name")).alias("raw_names"),
            F.sum("q").alias("lifetime_quantity"), F.sum("s").alias("lifetime_sales"),
            F.countDistinct("location_code").alias("locations"), F.min("d").alias("first_seen"),
        )
        .filter(F.size("raw_names") > 1)
        .withColumn("n_names", F.size("raw_names"))
    )


def open_items(
    lines: DataFrame,
    lookup: DataFrame,
    known_subs: DataFrame,
    period_costs: DataFrame,
    payment_patterns: list | None = None,
) -> DataFrame:
    """items that need a category, group, cost or channel decision.

    ``lines`` have passed ``inclusion_rule`` and carry alt_payment_name;
    ``lookup`` is one row per cleaned name, ``known_subs`` the sub-categories
    that map to a category, ``period_costs`` the items priced in the current period.
    """
    paid = payment_channel(F.col("alt_payment_name"), payment_patterns)
    wrong = F.coalesce(paid != F.col("channel_code"), F.lit(False))
    grain = ["canonical_name", "sales_category", "menu_group", "channel_code"]
    sums = lines.groupBy(*grain).agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("net_sales"),
        F.max("business_date").alias("last_seen"), F.max(wrong).alias("_wrong"),
    )
    known = lookup.select(F.col("cleaned_item_name").alias("canonical_name"), "category_2", F.lit(True).alias("_listed"))
    subs = known_subs.select(F.col("sub_category").alias("category_2"), F.lit(True).alias("_mapped")).distinct()
    priced = period_costs.select(F.col("item_name").alias("canonical_name"), F.lit(True).alias("_priced")).distinct()
    out = (
        sums.join(known.join(subs, "category_2", "left"), "canonical_name", "left")
        .join(priced, "canonical_name", "left")
    )
    no_group = is_blank(F.col("menu_group"))
    uncategorised = F.col("_listed").isNull() | F.col("_mapped").isNull()
    issues = F.array_compact(F.array(
        F.when(F.col("_priced").isNull() & ~F.coalesce(F.col("canonical_name").isin(fv.NO_COST_EXPECTED), F.lit(False)), "NO COST"),
        F.when(uncategorised, "UNCATEGORIZED"),
        F.when(no_group, "MISSING MENU GROUP"),
        F.when(F.col("_wrong"), "WRONG CHANNEL"),
    ))
    is_open = (no_group & F.col("sales_category").isNotNull()) | uncategorised
    fix = (
        F.when(F.col("_listed").isNull(), F.concat(F.lit("Add to item lookup: "), "canonical_name"))
        .when(F.col("_mapped").isNull(), F.concat(F.lit("Map sub-category: "), F.coalesce("category_2", F.lit("(none)"))))
        .when(no_group, F.concat(F.lit("Assign menu group for: "), "canonical_name"))
    )
    return out.filter(is_open).select(
        *grain, "quantity", "net_sales", "last_seen", issues.alias("issues"), fix.alias("suggested_fix")
    )


def with_issue(items: DataFrame, issue: str = "ALL") -> DataFrame:
    """the issue filter of the open-items table."""
    return items if issue == "ALL" else items.filter(F.array_contains("issues", issue))


def open_item_totals(items: DataFrame) -> DataFrame:
    """the four headline counts over open items."""
    def distinct_with(issue: str) -> Column:
        return F.countDistinct(F.when(F.array_contains("issues", issue), F.col("canonical_name")))

    return items.agg(
        F.countDistinct("canonical_name").alias("open_items"),
        F.sum("net_sales").alias("revenue_affected"),
        distinct_with("NO COST").alias("missing_cost"),
        distinct_with("UNCATEGORIZED").alias("uncategorized"),
    )


def needs_review(lines: DataFrame, payment_patterns: list | None = None) -> DataFrame:
    """orders whose stored channel differs from what their vendor implies.

    ``lines`` carry channel_code and alt_payment_name. The channel is attributed
    again without overrides; only payment evidence counts as a conflict.
    """
    suggested = payment_channel(F.col("alt_payment_name"), payment_patterns)
    conflict = lines.withColumn("suggested_channel", suggested).filter(
        F.col("suggested_channel").isNotNull() & (F.col("suggested_channel") != F.col("channel_code"))
    )
    keys = ["order_guid", "location_code", "business_date", "channel_code", "dining_option",
            "alt_payment_name", "suggested_channel"]
    out = conflict.groupBy(*keys).agg(F.sum("line_total").alias("amount"))
    return out.withColumn("issue_type", F.lit("CHANNEL_CONFLICT"))


# --- F19, F20 ------------------------------------------------------------------
def retention_report(items: DataFrame) -> DataFrame:
    """rates, change to the previous range and colour band per item.

    ``items`` is the output of ``attach_retention``.
    """
    return (
        items.withColumn("return_delta", F.col("return_rate") - F.col("return_rate_prev"))
        .withColumn("reorder_delta", F.col("reorder_rate") - F.col("reorder_rate_prev"))
        .withColumn("band", retention_band(F.col("return_rate")))
    )


def retention_kpis(report: DataFrame) -> DataFrame:
    """average rates, best and worst item by return rate."""
    rank = F.struct("return_rate", "canonical_name")
    rated = F.when(F.col("return_rate").isNotNull(), rank)
    return report.agg(
        ratio(F.sum("return_rate"), F.count("return_rate")).alias("avg_return_rate"),
        ratio(F.sum("reorder_rate"), F.count("reorder_rate")).alias("avg_reorder_rate"),
        F.max_by("canonical_name", rated).alias("best_item"),
        F.min_by("canonical_name", rated).alias("worst_item"),
    )


def period_guard(retention: DataFrame, calendar: DataFrame, mode: str = "flag") -> DataFrame:
    """flag extracts whose previous range does not end where their period starts.

    An extract of a period compares it with the days before it, so a range that
    ends anywhere else shows a stale file. ``raise`` stops on the first one.
    """
    spans = calendar.select(
        F.expr("period_key div 100").cast("int").alias("fiscal_year"),
        (F.col("period_key") % 100).cast("int").alias("period"), "period_start",
    )
    joined = retention.join(spans, ["fiscal_year", "period"], "left")
    fits = F.col("prev_period_end") == F.date_sub("period_start", 1)
    out = joined.withColumn("is_stale", F.col("prev_period_end").isNotNull() & ~F.coalesce(fits, F.lit(False)))
    if mode == "raise" and not out.filter("is_stale").isEmpty():
        raise ValueError("retention extract dates do not fit the period named by the file")
    return out.drop("period_start")


# --- F21, F22 ------------------------------------------------------------------
def verify_metrics(items: DataFrame) -> DataFrame:
    """the published identities of an item frame, within their tolerances.

    ``blended_ok`` compares quantity with the sum over in-house, app and
    third-party columns where the frame has them.
    """
    def near(a: Column, b: Column, tol: float) -> Column:
        return F.coalesce(F.abs(a.cast("double") - b.cast("double")) <= F.lit(tol), F.lit(True))

    q, s, c = F.col("quantity"), F.col("net_sales"), F.col("total_cost")
    out = (
        items.withColumn("price_ok", near(F.col("avg_price"), ratio(s, q), 0.01))
        .withColumn("cost_ok", near(c, F.col("avg_cost").cast("double") * q.cast("double"), 1.0))
        .withColumn("cogs_ok", near(F.col("cogs_pct"), ratio(c, s), 0.001))
        .withColumn("margin_pct_ok", near(F.col("margin_pct"), F.lit(1.0) - F.col("cogs_pct"), 0.001))
        .withColumn("margin_ok", near(F.col("margin"), F.col("avg_price") - F.col("avg_cost").cast("double"), 0.01))
    )
    parts = ["ih_quantity", "app_quantity", "tpd_quantity"]
    if set(parts) <= set(items.columns):
        total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts[1:]), F.coalesce(F.col(parts[0]), F.lit(0)))
        out = out.withColumn("blended_ok", near(q, total, 0.5))
    return out


def freshness(df: DataFrame) -> DataFrame:
    """newest business date."""
    return df.agg(F.max("business_date").alias("last_business_date"))


def period_sales(lines: DataFrame, calendar: DataFrame, keys: list[str]) -> DataFrame:
    """Sales per fiscal period and any other columns."""
    return _sales(assign_period(lines, calendar), ["period_label", "period_key", *keys])
