"""Cleaning, filters, joins and upserts over the test tables (C, D and E)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from menumix.functions import calendar as cal
from menumix.functions import scalars as sc
from menumix.operators import clean, filters, joins, reports, upsert
from menumix.plans import driver_tables as t
from menumix.plans.catalogue import CALENDAR, LINES, ORDERS, REPORT, d, modifier_cte, query
from menumix.session import rule_frame
from menumix.sources.files import default_rules

TAKEN = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,4))"


# --- C1 to C7 ------------------------------------------------------------------
@query("c1_repair_encoding", """
SELECT doc_id, nfc_normalize(replace(text, 'è', 'e' || chr(768))) AS repaired FROM documents""")
def repair_encoding(spark, sf):
    docs = t.table(spark, sf, "documents")
    broken = F.replace(F.replace("text", F.lit("è"), F.lit("è")), F.lit("é"), F.lit("Ã©"))
    return docs.select("doc_id", sc.repair_encoding(broken).alias("repaired"))


NAME_RULES = [("red widget", "Crimson Widget"), ("blue ring - side", "Azure Ring"), ("old rod", "Antique Rod")]


def _raw_part_names(spark, sf):
    suffix = (
        F.when(F.col("p_size") <= 10, "").when(F.col("p_size") <= 20, " - Side").when(F.col("p_size") <= 30, " -Club  Feast - GAMEDAY ")
        .when(F.col("p_size") <= 40, " - Lemon").otherwise(" - in-house")
    )
    return t.table(spark, sf, "part").select("p_partkey", F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("  ")), suffix).alias("raw_name"))


@query("c2_clean_names", """
WITH r AS (SELECT p_partkey, p_name, CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 20 THEN ' - Side'
    WHEN p_size <= 30 THEN ' -Club  Feast - GAMEDAY ' WHEN p_size <= 40 THEN ' - Lemon' ELSE ' - in-house' END AS suffix, p_size FROM part)
SELECT p_partkey, '  ' || replace(p_name, ' ', '  ') || suffix AS raw_name,
       CASE WHEN p_name = 'blue ring' AND suffix = ' - Side' THEN 'Azure Ring'
            WHEN suffix = ' - Lemon' THEN p_name || suffix
            WHEN p_name = 'red widget' THEN 'Crimson Widget' WHEN p_name = 'old rod' THEN 'Antique Rod' ELSE p_name END AS clean_name
FROM r""")
def clean_names(spark, sf):
    rules = rule_frame(spark, NAME_RULES, "key string, value string")
    return clean.clean_names(_raw_part_names(spark, sf), "raw_name", rules)


@query("c3_flag_blocklisted", f"""
WITH {modifier_cte()} SELECT modifier_guid, canonical_name, canonical_name = 'Napkins' AS is_blocklisted FROM m""")
def flag_blocklisted(spark, sf):
    mods = t.modifiers(spark, sf).select("modifier_guid", "canonical_name")
    return clean.flag_blocklisted(mods, "canonical_name", default_rules(spark)["blocklist"])


@query("c4_tag_modifier_type", f"""
WITH {modifier_cte()} SELECT modifier_guid, canonical_name,
  CASE WHEN canonical_name IN ('Basmati Rice', 'Mixed Greens', '1/2 and 1/2 Base') THEN 'base'
       WHEN canonical_name IN ('Chicken Tikka', 'Tandoori Paneer', 'Organic Tandoori Paneer', 'Lamb Kebab') THEN 'main'
       WHEN canonical_name = 'Spiced Chickpeas' THEN 'veggie' END AS mod_type FROM m""")
def tag_modifier_type(spark, sf):
    mods = t.modifiers(spark, sf).select("modifier_guid", "canonical_name")
    return clean.tag_modifier_type(mods, "canonical_name", default_rules(spark)["tags"])


@query("c5_exclude_from_mix", f"""
WITH {LINES} SELECT canonical_name, {d("SUM(quantity)", "quantity")} FROM l
WHERE {REPORT} AND canonical_name NOT IN ('red widget', 'old rod') GROUP BY 1""")
def exclude_from_mix(spark, sf):
    rules = rule_frame(spark, [("red widget",), ("old rod",)], "key string")
    lines = filters.filter_revenue(t.order_lines(spark, sf, "canonical_name", "quantity", "is_voided", "is_deferred"))
    sums = lines.groupBy("canonical_name").agg(F.sum("quantity").alias("quantity"))
    return clean.exclude_from_mix(sums, "canonical_name", rules)


@query("c6_to_business_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS business_date FROM orders""")
def to_business_date(spark, sf):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    stored = F.when(F.col("o_orderstatus") == "P", number % 10000).otherwise(number)
    return t.table(spark, sf, "orders").select("o_orderkey", sc.to_business_date(stored).alias("business_date"))


@query("c7_natural_key", f"""
WITH {LINES} SELECT selection_guid, CASE WHEN p_size > 5 THEN item_guid ELSE location_code || '::' || raw_name END AS natural_key FROM l""")
def natural_key(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "item_guid", "location_code", "raw_name")
    return lines.select("selection_guid", sc.natural_key(F.col("item_guid"), F.col("location_code"), F.col("raw_name")).alias("natural_key"))


# --- C8 to C13 -----------------------------------------------------------------
@query("c8_attribute_channel", f"""
WITH {LINES} SELECT selection_guid, CASE WHEN menu_name = 'P' THEN 'OTHER' ELSE channel_code END AS channel_code FROM l""")
def attribute_channel(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "alt_payment_name", "dining_option", "sales_category", "menu_name")
    manual = lines.withColumn("manual", F.when(F.col("menu_name") == "P", "OTHER"))
    out = filters.attribute_channel(manual, t.PAYMENT_PATTERNS, t.LINE_PATTERNS, override="manual")
    return out.select("selection_guid", "channel_code")


for _mode, _where in (("load", "NOT is_voided"), ("report", REPORT)):
    query(f"c9_filter_revenue_{_mode}", f"""
WITH {LINES} SELECT menu_name, COUNT(*) AS n_lines, {d("SUM(line_total)", "net_sales")} FROM l WHERE {_where} GROUP BY 1""")(
        lambda spark, sf, mode=_mode: filters.filter_revenue(
            t.order_lines(spark, sf, "menu_name", "line_total", "is_voided", "is_deferred"), mode)
        .groupBy("menu_name").agg(F.count("*").alias("n_lines"), F.sum("line_total").alias("net_sales")))


@query("c10_inclusion_rule", f"""
WITH {LINES}, b AS (SELECT *, CASE WHEN menu_group = 'SMALL' THEN '' WHEN menu_group <> 'PROMO' THEN menu_group END AS g,
                           CASE WHEN sales_category <> 'Brand#1' THEN sales_category END AS c FROM l)
SELECT selection_guid, COALESCE(g, '') = '' AS is_open_item FROM b
WHERE {REPORT} AND NOT (COALESCE(g, '') = '' AND COALESCE(c, '') = '')""")
def inclusion_rule(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "menu_group", "sales_category", "is_voided", "is_deferred")
    group, category = F.col("menu_group"), F.col("sales_category")
    blanked = lines.withColumn("menu_group", F.when(group == "SMALL", "").when(group != "PROMO", group))
    blanked = blanked.withColumn("sales_category", F.when(category != "Brand#1", category))
    return filters.inclusion_rule(blanked).select("selection_guid", "is_open_item")


@query("c11_real_menu_items", f"""
WITH {LINES} SELECT menu_name, menu_group, COUNT(*) AS n_lines FROM l
WHERE menu_name NOT IN ('P') AND menu_group NOT IN ('PROMO', 'SMALL') AND canonical_name <> 'red widget' GROUP BY 1, 2""")
def real_menu_items(spark, sf):
    lines = t.order_lines(spark, sf, "menu_name", "menu_group", "canonical_name")
    kept = filters.real_menu_items(lines, ["P"], ["PROMO", "SMALL"], ["red widget"])
    return kept.groupBy("menu_name", "menu_group").agg(F.count("*").alias("n_lines"))


def _category_rules(spark):
    return {
        "groups": rule_frame(spark, [("STANDARD", "Entrees", "Bowl"), ("MEDIUM", "Sides", None)],
                             "menu_group string, category string, sub_category string"),
        "items": rule_frame(spark, [("red widget", "Retail", "Sauce Bottle"), ("old rod", None, "Bread")],
                            "canonical_name string, category string, sub_category string"),
        "subs": rule_frame(spark, [("ECONOMY", "Sweets"), ("LARGE", "Kids Meal")], "sub_category string, category string"),
    }


def _item_lookup(spark, sf):
    """Lookup rows from parts: several per name, loaded at the part's number."""
    return t.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("raw_item_name"), F.col("p_name").alias("cleaned_item_name"),
        F.col("p_name").alias("category_1"), F.col("p_type").alias("category_2"), F.col("p_partkey").alias("loaded_at"),
    )


@query("c12_resolve_category", f"""
WITH {LINES}, look AS (SELECT p_name AS canonical_name, arg_max(p_type, p_partkey) AS category_2 FROM part GROUP BY 1),
c AS (SELECT canonical_name, menu_group, menu_name, line_total, look.category_2 FROM l LEFT JOIN look USING (canonical_name) WHERE {REPORT}),
r AS (SELECT CASE WHEN menu_name = 'P' THEN menu_group WHEN canonical_name = 'red widget' THEN 'Retail'
                  WHEN menu_group = 'STANDARD' THEN 'Entrees' WHEN menu_group = 'MEDIUM' THEN 'Sides'
                  WHEN category_2 = 'ECONOMY' THEN 'Sweets' WHEN category_2 = 'LARGE' THEN 'Kids Meal' END AS category,
             CASE WHEN menu_name = 'P' THEN NULL WHEN canonical_name = 'red widget' THEN 'Sauce Bottle'
                  WHEN canonical_name = 'old rod' THEN 'Bread' WHEN menu_group = 'STANDARD' THEN 'Bowl' ELSE category_2 END AS sub_category,
             line_total FROM c)
SELECT category, sub_category, COUNT(*) AS n_lines, {d("SUM(line_total)", "net_sales")} FROM r GROUP BY 1, 2""")
def resolve_category(spark, sf):
    lines = filters.filter_revenue(
        t.order_lines(spark, sf, "canonical_name", "menu_group", "menu_name", "line_total", "is_voided", "is_deferred"))
    lookup = filters.lookup_one_per_name(_item_lookup(spark, sf), [])
    out = filters.resolve_category(lines, _category_rules(spark), lookup, offsite_menu="P")
    return out.groupBy("category", "sub_category").agg(F.count("*").alias("n_lines"), F.sum("line_total").alias("net_sales"))


@query("c13_lookup_one_per_name", """
SELECT p_name AS cleaned_item_name, p_name AS category_1, arg_max(p_type, p_partkey) AS category_2
FROM part WHERE p_name <> 'red widget' GROUP BY p_name""")
def lookup_one_per_name(spark, sf):
    return filters.lookup_one_per_name(_item_lookup(spark, sf), ["red widget"])


@query("c14_normalise_external_name", """
SELECT p_partkey, CASE p_name WHEN 'red widget' THEN 'BYO red widget' WHEN 'old rod' THEN 'BYO old rod' ELSE p_name END AS canonical_name FROM part""")
def normalise_external_name(spark, sf):
    pairs = [("red widget", "BYO red widget"), ("old rod", "BYO old rod")]
    return t.table(spark, sf, "part").select("p_partkey", sc.normalise_external_name(F.col("p_name"), pairs).alias("canonical_name"))


# --- C15 to C20 ----------------------------------------------------------------
@query("c15_assign_period", f"""
WITH {CALENDAR} SELECT o_orderkey, CAST(o_orderdate AS DATE) AS business_date, COALESCE(period_label, 'Other') AS period_label
FROM orders LEFT JOIN cal ON CAST(o_orderdate AS DATE) BETWEEN period_start AND period_end""")
def assign_period(spark, sf):
    orders = t.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("business_date"))
    return cal.assign_period(orders, t.calendar(spark)).drop("period_key")


@query("c16_bucket_time", f"""
WITH {ORDERS} SELECT CAST(date_trunc('week', business_date) AS DATE) AS bucket, COUNT(*) AS orders FROM o GROUP BY 1""")
def bucket_time(spark, sf):
    return cal.bucket_time(t.orders(spark, sf, {"business_date"}), "weekly").groupBy("bucket").agg(F.count("*").alias("orders"))


PRESETS = {
    "last_week": ("last week", "DATE '1998-06-08'", "DATE '1998-06-14'"),
    "last_8_weeks": ("last 8 weeks", "DATE '1998-04-23'", "DATE '1998-06-17'"),
    "last_month": ("last month", "DATE '1998-05-01'", "DATE '1998-05-31'"),
    "quarter": ("q2", "DATE '1998-04-01'", "DATE '1998-06-30'"),
    "ytd": ("ytd", "DATE '1998-01-01'", "DATE '1998-06-17'"),
    "period": ("p6 1998", "DATE '1998-05-21'", "DATE '1998-06-17'"),
    "custom": ("1997-12-30..1998-01-02", "DATE '1997-12-30'", "DATE '1998-01-02'"),
}
TODAY = date(1998, 6, 17)


_PRESET_ROWS = ", ".join(f"('{name}', {a}, {b})" for name, (_, a, b) in PRESETS.items())


@query("c17_date_preset", f"""
WITH {ORDERS}, preset(preset, a, b) AS (VALUES {_PRESET_ROWS})
SELECT preset, COUNT(*) AS orders, {d("SUM(order_total)", "total")} FROM o JOIN preset ON business_date BETWEEN a AND b GROUP BY 1""")
def date_preset(spark, sf):
    """Orders in each named range, all ranges in one scan."""
    orders = t.orders(spark, sf, {"business_date", "order_total"})
    periods = [("P6 1998", 199806, date(1998, 5, 21), date(1998, 6, 17))]
    ranges = {name: cal.date_range(preset, TODAY, periods) for name, (preset, _, _) in PRESETS.items()}
    inside = [
        F.when(F.col("business_date").between(F.lit(first), F.lit(last)), name) for name, (first, last) in ranges.items()
    ]
    tagged = orders.select("order_total", F.explode(F.array_compact(F.array(*inside))).alias("preset"))
    return tagged.groupBy("preset").agg(F.count("*").alias("orders"), F.sum("order_total").alias("total"))


@query("c18_scope", f"""
WITH {LINES} SELECT location_code, channel_code, canonical_name, {d("SUM(line_total)", "net_sales")} FROM l
WHERE location_code IN ('ASIA', 'EUROPE') AND channel_code IN ('APP', 'TPD') AND menu_name IN ('F', 'O')
  AND canonical_name ILIKE '%WIDG%' GROUP BY 1, 2, 3""")
def scope(spark, sf):
    lines = t.order_lines(spark, sf, "location_code", "channel_code", "menu_name", "canonical_name", "line_total")
    kept = filters.scope(lines, ["ASIA", "EUROPE"], ["APP", "TPD"], ["F", "O"], "WIDG")
    return kept.groupBy("location_code", "channel_code", "canonical_name").agg(F.sum("line_total").alias("net_sales"))


@query("c19_split_name_check", f"""
WITH {LINES} SELECT raw_name AS canonical_name, COUNT(DISTINCT location_code) AS locations, {d("SUM(quantity)", "quantity")}
FROM l WHERE NOT is_voided AND raw_name ILIKE '%- %' GROUP BY 1 ORDER BY quantity DESC, 1 LIMIT 15""")
def split_name_check(spark, sf):
    lines = t.order_lines(spark, sf, "raw_name", "location_code", "quantity", "is_voided")
    return filters.split_name_check(lines.withColumnRenamed("raw_name", "canonical_name"))


@query("c20_day_of_week", f"""
WITH {LINES} SELECT CAST(isodow(business_date) AS INTEGER) AS weekday, COUNT(DISTINCT order_guid) AS orders, {d("SUM(line_total)", "net_sales")}
FROM l WHERE {REPORT} AND channel_code = 'CATERING' GROUP BY 1""")
def day_of_week(spark, sf):
    lines = t.order_lines(spark, sf, "business_date", "order_guid", "line_total", "channel_code", "is_voided", "is_deferred")
    return filters.day_of_week(filters.scope(filters.filter_revenue(lines), channels=["CATERING"]))


# --- D1 to D8 ------------------------------------------------------------------
def _staged_lines(spark, sf):
    """Lines in the shape of the staging table, with dates."""
    lines = t.order_lines(spark, sf, "selection_guid", "order_guid", "item_guid", "location_code", "raw_name", "canonical_name",
                          "menu_name", "menu_group", "sales_category", "business_date")
    return lines.withColumnsRenamed({"canonical_name": "clean_name", "menu_group": "menu_group_name"}).withColumn(
        "item_multi_loc_id", F.col("item_guid"))


@query("d1_attach_item_key", f"""
WITH {LINES}, k AS (SELECT *, COALESCE(NULLIF(item_guid, ''), location_code || '::' || raw_name) AS natural_key FROM l)
SELECT selection_guid, natural_key, natural_key IN (SELECT natural_key FROM k WHERE business_date < DATE '1998-01-01') AS has_key FROM k""")
def attach_item_key(spark, sf):
    lines = _staged_lines(spark, sf)
    dim = upsert.dim_item_rows(lines.filter(F.col("business_date") < F.lit(date(1998, 1, 1))))
    return joins.attach_item_key(lines, dim).select("selection_guid", "natural_key", F.col("item_key").isNotNull().alias("has_key"))


def _overrides(spark, sf):
    orders = t.orders(spark, sf, {"menu_name"})
    return orders.filter(F.col("menu_name") == "P").select("order_guid", F.lit("APP").alias("channel_code"))


@query("d2_attach_override", f"""
WITH {LINES} SELECT selection_guid, CASE WHEN menu_name = 'P' THEN 'APP' END AS override_channel FROM l""")
def attach_override(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "order_guid")
    return joins.attach_override(lines, _overrides(spark, sf)).select("selection_guid", "override_channel")


def _line_payments(spark, sf):
    """Several payments per order: one per line, named by shipping status."""
    line = t.table(spark, sf, "lineitem")
    return line.select(
        F.col("l_orderkey").cast("string").alias("order_guid"), t.selection_guid().alias("payment_guid"),
        F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", "l_linestatus")).alias("alt_payment_name"),
        F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"),
    )


LINE_PAYMENTS = """
pays AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_guid, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payment_guid,
                CASE WHEN l_returnflag <> 'R' THEN l_returnflag || l_linestatus END AS alt_payment_name,
                CASE WHEN l_linenumber < 7 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount FROM lineitem),
top AS (SELECT order_guid, alt_payment_name FROM (
          SELECT *, row_number() OVER (PARTITION BY order_guid ORDER BY amount DESC NULLS LAST, payment_guid) AS n
          FROM pays WHERE alt_payment_name IS NOT NULL) WHERE n = 1)"""


@query("d3_top_payment", f"""
WITH {LINE_PAYMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS order_guid, alt_payment_name
FROM orders LEFT JOIN top ON order_guid = CAST(o_orderkey AS VARCHAR)""")
def top_payment(spark, sf):
    return joins.top_payment(t.orders(spark, sf, set()).select("order_guid"), _line_payments(spark, sf))


@query("d4_vendor_per_order", f"WITH {LINE_PAYMENTS} SELECT order_guid, alt_payment_name FROM top")
def vendor_per_order(spark, sf):
    return joins.vendor_per_order(_line_payments(spark, sf))


@query("d5_attach_modifier_type", f"""
WITH {modifier_cte()} SELECT canonical_name, CASE WHEN mod_type LIKE 'Extra%' THEN NULL ELSE mod_type END AS mod_type, COUNT(*) AS n
FROM m WHERE NOT is_blocklisted GROUP BY 1, 2""")
def attach_modifier_type(spark, sf):
    dim = t.modifier_names(spark).filter(~F.coalesce(F.col("mod_type").like("Extra%"), F.lit(False)))
    mods = joins.attach_modifier_type(t.modifiers(spark, sf).drop("mod_type"), dim)
    return mods.groupBy("canonical_name", "mod_type").agg(F.count("*").alias("n"))


@query("d6_orphan_modifiers", f"""
WITH {modifier_cte()} SELECT modifier_guid, parent_selection FROM m
WHERE parent_selection IN (SELECT s FROM x WHERE l_linestatus = 'O')""")
def orphan_modifiers(spark, sf):
    lines = t.table(spark, sf, "lineitem").filter("l_linestatus <> 'O'").select(t.selection_guid().alias("selection_guid"))
    return joins.orphan_modifiers(t.modifiers(spark, sf), lines).select("modifier_guid", "parent_selection")


@query("d7_restrict_to", f"""
WITH {LINES} SELECT selection_guid, {d("line_total", "line_total")} FROM l WHERE business_date >= DATE '1999-01-01'""")
def restrict_to(spark, sf):
    staged = t.order_lines(spark, sf, "selection_guid", "business_date").filter(F.col("business_date") >= F.lit(date(1999, 1, 1)))
    return joins.restrict_to(t.order_lines(spark, sf, "selection_guid", "line_total"), staged)


@query("d8_compare_totals", f"""
WITH {LINES}, a AS (SELECT COUNT(*) AS c, SUM(line_total) FILTER (WHERE NOT is_voided) AS r FROM l WHERE menu_name = 'F'),
b AS (SELECT COUNT(*) AS c, SUM(line_total) FILTER (WHERE NOT is_voided) AS r FROM l)
SELECT a.c AS staged_lines, b.c AS public_lines, {d("a.r", "staged_revenue")}, {d("b.r", "public_revenue")} FROM a, b""")
def compare_totals(spark, sf):
    lines = t.order_lines(spark, sf, "line_total", "is_voided", "menu_name")
    return joins.compare_totals(lines.filter("menu_name = 'F'"), lines)


@query("d9_cost_lookup", f"""
WITH {LINES}, {CALENDAR},
cost AS (SELECT p_name AS canonical_name, CAST((1995 + p_partkey % 7) * 100 + p_size % 13 + 1 AS INTEGER) AS period_key,
                CASE WHEN p_size > 25 THEN (['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])[p_partkey % 5 + 1] END AS location_code,
                MIN(CAST(p_retailprice AS DECIMAL(12,4))) AS avg_cost FROM part GROUP BY 1, 2, 3),
i AS (SELECT canonical_name, location_code, period_key, SUM(quantity) AS quantity FROM l
      LEFT JOIN cal ON business_date BETWEEN period_start AND period_end WHERE {REPORT} GROUP BY 1, 2, 3),
newest AS (SELECT canonical_name, avg_cost FROM (SELECT *, row_number() OVER (PARTITION BY canonical_name
           ORDER BY period_key DESC, location_code IS NOT NULL, avg_cost) AS n FROM cost) WHERE n = 1),
j AS (SELECT i.*, c1.avg_cost AS a, c2.avg_cost AS b, newest.avg_cost AS c FROM i
      LEFT JOIN cost c1 ON c1.canonical_name = i.canonical_name AND c1.period_key = i.period_key AND c1.location_code = i.location_code
      LEFT JOIN cost c2 ON c2.canonical_name = i.canonical_name AND c2.period_key = i.period_key AND c2.location_code IS NULL
      LEFT JOIN newest ON newest.canonical_name = i.canonical_name)
SELECT canonical_name, location_code, period_key, {d("quantity", "quantity")}, {d("COALESCE(a, b, c)", "avg_cost")},
       CASE WHEN a IS NOT NULL THEN 'location' WHEN b IS NOT NULL THEN 'period' WHEN c IS NOT NULL THEN 'latest' END AS cost_source,
       COALESCE(a, b, c) IS NULL AND canonical_name NOT IN ('red widget') AS no_cost FROM j""")
def cost_lookup(spark, sf):
    lines = filters.filter_revenue(
        t.order_lines(spark, sf, "canonical_name", "location_code", "business_date", "quantity", "line_total", "is_voided", "is_deferred"))
    items = reports.period_sales(lines, t.calendar(spark), ["canonical_name", "location_code"])
    return joins.cost_lookup(items.drop("period_label", "net_sales"), t.item_costs(spark, sf), exempt=["red widget"])


@query("d11_modifiers_of_items", f"""
WITH {LINES}, {modifier_cte()}
SELECT l.canonical_name AS item_name, channel_code, mod_type, m.canonical_name, {d("SUM(m.quantity)", "quantity")}
FROM m JOIN l ON m.parent_selection = l.selection_guid GROUP BY 1, 2, 3, 4""")
def modifiers_of_items(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "order_guid", "canonical_name", "channel_code", "location_code", "business_date")
    joined = joins.modifiers_of_items(t.modifiers(spark, sf), lines)
    return joined.groupBy("item_name", "channel_code", "mod_type", "canonical_name").agg(F.sum("quantity").alias("quantity"))


# --- E1 to E9 ------------------------------------------------------------------
def _order_states(spark, sf):
    orders = t.table(spark, sf, "orders")
    row = ["o_orderkey", F.col("o_totalprice").cast(sc.MONEY).alias("line_total"), F.col("o_orderstatus").alias("menu_name"),
           F.col("o_orderpriority").alias("dining_option"), F.col("o_orderdate").cast("date").alias("last_seen")]
    old = orders.filter(F.col("o_orderstatus") != "P").select(*row)
    new = orders.filter(F.col("o_orderstatus") != "F").select(
        "o_orderkey", (F.col("o_totalprice").cast(sc.MONEY) + 1).cast(sc.MONEY).alias("line_total"),
        F.when(F.col("o_orderpriority") != "5-LOW", "new").alias("menu_name"), F.lit("changed").alias("dining_option"),
        F.date_sub(F.col("o_orderdate").cast("date"), 30).alias("last_seen"))
    return old, new


@query("e1_upsert", f"""
SELECT o_orderkey, CAST({TAKEN.replace("DECIMAL(18,2)", "DECIMAL(18,4)")} + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS DOUBLE) AS line_total,
       CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderpriority <> '5-LOW' THEN 'new' WHEN o_orderstatus = 'O' THEN 'O' END AS menu_name,
       CASE WHEN o_orderstatus = 'P' THEN 'changed' ELSE o_orderpriority END AS dining_option,
       CAST(CAST(o_orderdate AS DATE) - CASE WHEN o_orderstatus = 'P' THEN 30 ELSE 0 END AS DATE) AS last_seen
FROM orders""")
def upsert_rows(spark, sf):
    old, new = _order_states(spark, sf)
    return upsert.upsert(old, new, ["o_orderkey"], update=["line_total"], keep_if_null=["menu_name"], greatest=["last_seen"])


def _feed(spark, sf):
    """Feed versions: one per event, the user standing for the order; every
    event of type 'error' lost its modified date."""
    return t.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("order_guid"), F.col("ts").alias("modified_date"),
        F.col("props").alias("payload"), F.col("event_id").alias("arrival"), "event_type", "value")


@query("e2_upsert_latest", """
WITH a AS (SELECT user_id, arg_max(event_id, ts) AS e FROM events WHERE event_type IN ('view', 'signup', 'error') GROUP BY 1),
b AS (SELECT user_id, arg_max(event_id, ts) AS e FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1),
v AS (SELECT event_id, ts, props FROM events)
SELECT CAST(COALESCE(a.user_id, b.user_id) AS VARCHAR) AS order_guid,
       CASE WHEN vb.ts IS NOT NULL AND (va.ts IS NULL OR vb.ts >= va.ts) THEN vb.event_id ELSE va.event_id END AS arrival,
       CASE WHEN vb.ts IS NOT NULL AND (va.ts IS NULL OR vb.ts >= va.ts) THEN vb.ts ELSE va.ts END AS modified_date,
       CASE WHEN vb.ts IS NOT NULL AND (va.ts IS NULL OR vb.ts >= va.ts) THEN vb.props ELSE va.props END AS payload
FROM a FULL JOIN b ON a.user_id = b.user_id LEFT JOIN v va ON va.event_id = a.e LEFT JOIN v vb ON vb.event_id = b.e""")
def upsert_latest(spark, sf):
    feed = _feed(spark, sf)
    old, new = (
        upsert.latest_by(feed.filter(F.col("event_type").isin(kinds)).drop("event_type", "value"), ["order_guid"], ["modified_date"])
        for kinds in (["view", "signup", "error"], ["click", "purchase"]))
    return upsert.upsert_latest(old, new)


@query("e2_resolve_versions", """
WITH f AS (SELECT event_id, user_id, props, CASE WHEN event_type <> 'error' OR value < 20 THEN ts END AS modified_date FROM events),
cut AS (SELECT user_id, MAX(event_id) AS c FROM f WHERE modified_date IS NULL GROUP BY 1),
r AS (SELECT f.*, row_number() OVER (PARTITION BY f.user_id ORDER BY modified_date DESC NULLS LAST, event_id DESC) AS n
      FROM f LEFT JOIN cut ON cut.user_id = f.user_id WHERE c IS NULL OR event_id >= c)
SELECT CAST(user_id AS VARCHAR) AS order_guid, modified_date, props AS payload, event_id AS arrival FROM r WHERE n = 1""")
def resolve_versions(spark, sf):
    lost = (F.col("event_type") == "error") & (F.col("value") >= 20)
    feed = _feed(spark, sf).withColumn("modified_date", F.when(~lost, F.col("modified_date"))).drop("event_type", "value")
    return upsert.resolve_versions(feed)


@query("e3_insert_ignore", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'changed' ELSE o_orderpriority END AS dining_option FROM orders""")
def insert_ignore(spark, sf):
    old, new = _order_states(spark, sf)
    return upsert.insert_ignore(old, new, ["o_orderkey"]).select("o_orderkey", "dining_option")


@query("e4_append", """
SELECT o_orderkey, o_orderpriority AS dining_option FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderstatus <> 'F'""")
def append(spark, sf):
    return upsert.append(*_order_states(spark, sf)).select("o_orderkey", "dining_option")


@query("e4_append_repeatable", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'changed' END AS dining_option FROM orders""")
def append_repeatable(spark, sf):
    old, new = _order_states(spark, sf)
    once = upsert.append(old, new, ["o_orderkey"])
    return upsert.append(once, new, ["o_orderkey"]).select("o_orderkey", "dining_option")


@query("e5_dedupe_first", """
SELECT CAST(user_id AS VARCHAR) AS order_guid, event_type, MIN(event_id) AS arrival FROM events GROUP BY 1, 2""")
def dedupe_first(spark, sf):
    feed = _feed(spark, sf).select("order_guid", "event_type", "arrival", "payload")
    return upsert.dedupe_first(feed, ["order_guid", "event_type"], ["arrival"]).drop("payload")


DIM_ITEM = """
dim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY business_date DESC, selection_guid DESC) AS n FROM
   (SELECT *, COALESCE(NULLIF(item_guid, ''), location_code || '::' || raw_name) AS natural_key FROM l WHERE business_date {when})) WHERE n = 1)"""


@query("e6_upsert_dim_item", f"""
WITH {LINES}, {DIM_ITEM.format(when="< DATE '1999-01-01'")}, {DIM_ITEM.format(when=">= DATE '1998-07-01'").replace("dim AS", "fresh AS")}
SELECT natural_key, COALESCE(f.canonical_name, o.canonical_name) AS canonical_name, COALESCE(o.menu_name, f.menu_name) AS menu_name,
       COALESCE(f.menu_group, o.menu_group) AS menu_group, COALESCE(o.sales_category, f.sales_category) AS sales_category,
       COALESCE(o.business_date, f.business_date) AS first_seen, GREATEST(o.business_date, f.business_date) AS last_seen
FROM dim o FULL JOIN fresh f USING (natural_key)""")
def upsert_dim_item(spark, sf):
    lines = _staged_lines(spark, sf)
    day = F.col("business_date")
    old = upsert.upsert_dim_item(None, lines.filter(day < F.lit(date(1999, 1, 1))))
    out = upsert.upsert_dim_item(old, lines.filter(day >= F.lit(date(1998, 7, 1))))
    return out.select("natural_key", "canonical_name", "menu_name", "menu_group", "sales_category", "first_seen", "last_seen")


@query("e7_upsert_dim_modifier", f"""
WITH {ORDERS}, {modifier_cte()}, tags AS (
  SELECT canonical_name, MIN(business_date) AS first_seen, MAX(business_date) AS last_seen FROM m JOIN o USING (order_guid) GROUP BY 1)
SELECT canonical_name AS natural_key,
  CASE WHEN canonical_name IN ('Basmati Rice', 'Mixed Greens', '1/2 and 1/2 Base') THEN 'base'
       WHEN canonical_name IN ('Chicken Tikka', 'Tandoori Paneer', 'Organic Tandoori Paneer', 'Lamb Kebab') THEN 'main'
       WHEN canonical_name = 'Spiced Chickpeas' THEN 'veggie' END AS mod_type,
  canonical_name NOT IN ('Basmati Rice', 'Mixed Greens', '1/2 and 1/2 Base', 'Chicken Tikka', 'Tandoori Paneer',
                         'Organic Tandoori Paneer', 'Lamb Kebab', 'Spiced Chickpeas') AS needs_review, first_seen, last_seen
FROM tags""")
def upsert_dim_modifier(spark, sf):
    mods = t.modifiers(spark, sf).join(t.orders(spark, sf, {"business_date"}), "order_guid").withColumnRenamed("canonical_name", "clean_name")
    tags = default_rules(spark)["tags"]
    day = F.col("business_date")
    old = upsert.upsert_dim_modifier(None, mods.filter(day < F.lit(date(1999, 1, 1))), tags)
    out = upsert.upsert_dim_modifier(old, mods.filter(day >= F.lit(date(1998, 7, 1))), tags)
    return out.select("natural_key", "mod_type", "needs_review", "first_seen", "last_seen")


@query("e8_set_channel_override", f"""
WITH {LINES}, c AS (
  SELECT DISTINCT order_guid, CASE WHEN alt_payment_name = 'FURNITURE' THEN 'CATERING' WHEN alt_payment_name = 'MACHINERY' THEN 'OFFSITE'
              WHEN alt_payment_name = 'AUTOMOBILE' THEN 'TPD' END AS suggested FROM l WHERE menu_name = 'P')
SELECT order_guid, COALESCE(suggested, 'APP') AS channel_code FROM c
UNION SELECT CAST(o_orderkey AS VARCHAR), 'APP' FROM orders WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def set_channel_override(spark, sf):
    overrides = _overrides(spark, sf)
    lines = t.order_lines(spark, sf, "order_guid", "location_code", "business_date", "channel_code", "dining_option",
                          "alt_payment_name", "line_total")
    stored = joins.attach_override(lines, overrides).filter(F.col("override_channel").isNotNull())
    review = reports.needs_review(stored.withColumn("channel_code", F.col("override_channel")), t.PAYMENT_PATTERNS)
    suggestions = review.groupBy("order_guid").agg(F.min("suggested_channel").alias("channel_code"))
    return upsert.set_channel_override(overrides, suggestions)


@query("e9_dim_history", """
WITH dd AS (SELECT user_id, CAST(ts AS DATE) AS d, MAX(event_type) AS state FROM events GROUP BY 1, 2),
b AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY d) AS before FROM dd),
s AS (SELECT * FROM b WHERE before IS DISTINCT FROM state)
SELECT user_id, state, d AS valid_from, CAST(lead(d) OVER (PARTITION BY user_id ORDER BY d) - 1 AS DATE) AS valid_to,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) IS NULL AS is_current FROM s""")
def dim_history(spark, sf):
    changes = t.table(spark, sf, "events").select("user_id", F.col("event_type").alias("state"), F.col("ts").cast("date").alias("seen"))
    return upsert.dim_history(changes, "user_id", ["state"], "seen")


@query("e9_late_change", """
WITH early AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, event_id) AS state FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2),
eb AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY d) AS before FROM early),
es AS (SELECT user_id, d, state, NULL AS event_id FROM eb WHERE before IS DISTINCT FROM state),
lt AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type AS state, event_id FROM events WHERE event_id % 3 = 0),
w AS (SELECT user_id, d, arg_max(state, coalesce(event_id, -1)) AS state FROM (SELECT * FROM es UNION ALL SELECT * FROM lt) GROUP BY 1, 2),
wb AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY d) AS before FROM w),
ws AS (SELECT * FROM wb WHERE before IS DISTINCT FROM state)
SELECT user_id, state, d AS valid_from, CAST(lead(d) OVER (PARTITION BY user_id ORDER BY d) - 1 AS DATE) AS valid_to,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) IS NULL AS is_current FROM ws""")
def late_change(spark, sf):
    """Every third event arrives after the ranges of the others were stored."""
    changes = t.table(spark, sf, "events").select("user_id", F.col("event_type").alias("state"), F.col("ts").cast("date").alias("seen"), "event_id")
    late = F.col("event_id") % 3 == 0
    stored = upsert.dim_history(changes.filter(~late), "user_id", ["state"], "seen", "event_id")
    return upsert.merge_history(stored, changes.filter(late), "user_id", ["state"], "seen", "event_id")


@query("h2_latest_by", """
SELECT user_id, arg_max(event_type, ts) AS event_type, MAX(ts) AS ts FROM events GROUP BY 1""")
def latest_by(spark, sf):
    return upsert.latest_by(t.table(spark, sf, "events").select("user_id", "event_type", "ts"), ["user_id"], ["ts"])
