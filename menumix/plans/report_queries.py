"""Reports, shares and rankings over the test tables (F and H)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from menumix.operators import filters, reports, shares
from menumix.plans import driver_tables as t
from menumix.plans.catalogue import CALENDAR, LINES, ORDERS, REPORT, d, modifier_cte, q, query
from menumix.session import rule_frame

START, END = date(1997, 1, 1), date(1999, 12, 31)
SALES = f"COUNT(*) AS n_lines, {d('SUM(line_total)', 'net_sales')}, {d('SUM(quantity)', 'quantity')}"


# --- F1 to F4 ------------------------------------------------------------------
for _name, _keys in {
    "f1_revenue_by_channel": ["channel_code"],
    "f1_revenue_by_location": ["location_code"],
    "f1_revenue_by_item": ["canonical_name"],
    "f1_revenue_by_menu_and_group": ["menu_name", "menu_group"],
    "f1_revenue_by_payment": ["alt_payment_name"],
}.items():
    query(
        _name, f"WITH {LINES} SELECT {', '.join(_keys)}, {SALES} FROM l WHERE NOT is_voided GROUP BY {', '.join(_keys)}"
    )(lambda spark, sf, keys=_keys: reports.revenue_by(
        t.order_lines(spark, sf, *keys, "line_total", "quantity", "is_voided"), keys))


@query("f2_location_reconciliation", f"""
WITH {LINES}
SELECT location_code, COUNT(*) AS n_lines,
       {d("SUM(line_total) FILTER (WHERE NOT is_voided)", "net_item_sales")},
       {d("SUM(line_total) FILTER (WHERE is_voided)", "voided_amount")},
       COUNT(*) FILTER (WHERE channel_code = 'OTHER') AS unattributed
FROM l WHERE business_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' GROUP BY location_code""")
def location_reconciliation(spark, sf):
    lines = t.order_lines(spark, sf, "location_code", "business_date", "line_total", "is_voided", "channel_code")
    return reports.location_reconciliation(lines, START, END)


def _staged_and_public(spark, sf):
    staged = t.order_lines(spark, sf, "selection_guid", "line_total", "is_voided", "business_date")
    public = t.order_lines(spark, sf, "selection_guid", "line_total", "is_voided", "channel_code")
    return staged.filter(F.col("business_date") >= F.lit(START)), public


@query("f3_validate", f"""
WITH {LINES}, {modifier_cte()},
s AS (SELECT * FROM l WHERE business_date >= DATE '1997-01-01'),
live AS (SELECT * FROM l WHERE NOT is_voided)
SELECT 'staging lines' AS "check", {d("(SELECT COUNT(*) FROM s)", "value")}
UNION ALL SELECT 'public lines', {d("(SELECT COUNT(*) FROM live)", "value")}
UNION ALL SELECT 'staging revenue (non-void)', {d("(SELECT SUM(line_total) FROM s WHERE NOT is_voided)", "value")}
UNION ALL SELECT 'orphan modifiers',
  {d("(SELECT COUNT(*) FROM m WHERE parent_selection NOT IN (SELECT selection_guid FROM live))", "value")}
UNION ALL SELECT 'lines missing channel', {d("(SELECT COUNT(*) FROM live WHERE channel_code IS NULL)", "value")}""")
def validate(spark, sf):
    staged, public = _staged_and_public(spark, sf)
    return reports.validate(staged, filters.filter_revenue(public, "load"), t.modifiers(spark, sf))


@query("f4_drift", f"""
WITH {LINES}, s AS (SELECT * FROM l WHERE business_date >= DATE '1997-01-01'),
p AS (SELECT * FROM l WHERE selection_guid IN (SELECT selection_guid FROM s)),
a AS (SELECT COUNT(*) AS c, SUM(line_total) FILTER (WHERE NOT is_voided) AS r FROM s),
b AS (SELECT COUNT(*) AS c, SUM(line_total) FILTER (WHERE NOT is_voided) AS r FROM p)
SELECT a.c AS staged_lines, b.c AS public_lines, {d("a.r", "staged_revenue")}, {d("b.r", "public_revenue")},
       a.c = b.c AND abs(a.r - b.r) < 0.01 AS ok
FROM a, b""")
def drift(spark, sf):
    return reports.drift(*_staged_and_public(spark, sf))


# --- F5 to F8 ------------------------------------------------------------------
def priced_items(spark, sf):
    lines = filters.filter_revenue(
        t.order_lines(spark, sf, "canonical_name", "channel_code", "quantity", "line_total", "is_voided", "is_deferred")
    )
    items = reports.item_sales(lines)
    costs = t.base_costs(spark, sf).withColumnRenamed("base_cost", "avg_cost")
    return items.join(costs, "canonical_name", "left")


ITEMS = f"""{LINES},
base AS (SELECT p_name AS canonical_name, MIN(CAST(p_retailprice AS DECIMAL(12,4))) AS avg_cost FROM part GROUP BY 1),
sums AS (SELECT canonical_name, channel_code, SUM(quantity) AS quantity, SUM(line_total) AS net_sales, COUNT(*) AS n_lines
         FROM l WHERE {REPORT} GROUP BY 1, 2),
i AS (SELECT s.*, b.avg_cost, CAST(b.avg_cost * CAST(s.quantity AS DECIMAL(24,4)) AS DECIMAL(37,4)) AS total_cost
      FROM sums s LEFT JOIN base b USING (canonical_name)),
im AS (SELECT *, CAST(net_sales AS DOUBLE) / CAST(quantity AS DOUBLE) AS avg_price,
              CAST(total_cost AS DOUBLE) / CAST(net_sales AS DOUBLE) AS cogs_pct,
              1 - CAST(total_cost AS DOUBLE) / CAST(net_sales AS DOUBLE) AS margin_pct,
              CAST(net_sales AS DOUBLE) / CAST(quantity AS DOUBLE) - CAST(avg_cost AS DOUBLE) AS margin,
              net_sales - total_cost AS total_margin,
              CAST(quantity AS DOUBLE) / CAST(SUM(quantity) OVER () AS DOUBLE) AS menu_mix_pct,
              CAST(net_sales AS DOUBLE) / CAST(SUM(net_sales) OVER () AS DOUBLE) AS sls_pct
       FROM i)"""
METRIC_COLUMNS = (
    f"canonical_name, channel_code, {d('quantity', 'quantity')}, {d('net_sales', 'net_sales')}, n_lines, "
    f"{d('avg_cost', 'avg_cost')}, {d('total_cost', 'total_cost')}, avg_price, cogs_pct, margin_pct, margin, "
    f"{d('total_margin', 'total_margin')}, menu_mix_pct, sls_pct"
)


@query("f5_item_metrics", f"WITH {ITEMS} SELECT {METRIC_COLUMNS} FROM im")
def item_metrics(spark, sf):
    return reports.item_metrics(priced_items(spark, sf))


@query("f6_blended_metrics", f"""
WITH {ITEMS}
SELECT canonical_name, {d("SUM(quantity)", "quantity")}, {d("SUM(net_sales)", "net_sales")},
       {d("SUM(total_cost)", "total_cost")}, {q("SUM(net_sales)", "SUM(quantity)", "blended_avg_price")},
       {q("SUM(total_cost)", "SUM(quantity) FILTER (WHERE total_cost IS NOT NULL)", "blended_avg_cost")},
       1 - CAST(SUM(total_cost) AS DOUBLE) / CAST(SUM(net_sales) FILTER (WHERE total_cost IS NOT NULL) AS DOUBLE) AS blended_margin,
       {d("COALESCE(SUM(net_sales) FILTER (WHERE total_cost IS NULL), 0)", "unpriced_sales")}
FROM im GROUP BY canonical_name""")
def blended_metrics(spark, sf):
    return reports.blended_metrics(item_metrics(spark, sf))


@query("f7_kpi_summary", f"""
WITH {ITEMS}, p AS (SELECT canonical_name, SUM(net_sales) AS s, SUM(quantity) AS u FROM im GROUP BY 1),
top AS (SELECT * FROM p ORDER BY s DESC, canonical_name DESC LIMIT 1)
SELECT {d("SUM(quantity)", "items_sold")}, {d("SUM(net_sales)", "net_revenue")},
       {q("SUM(total_margin)", "SUM(net_sales) FILTER (WHERE total_margin IS NOT NULL)", "avg_margin_pct")},
       {d("COALESCE(SUM(net_sales) FILTER (WHERE total_margin IS NULL), 0)", "unpriced_sales")}, COUNT(DISTINCT canonical_name) AS unique_items,
       (SELECT canonical_name FROM top) AS top_item, {d("(SELECT s FROM top)", "top_item_sales")},
       {q("(SELECT u FROM top)", "SUM(quantity)", "top_item_mix_pct")}
FROM im""")
def kpi_summary(spark, sf):
    return reports.kpi_summary(item_metrics(spark, sf))


def _report_lines(spark, sf, *columns):
    wanted = dict.fromkeys([*columns, "line_total", "quantity", "is_voided", "is_deferred"])
    return filters.filter_revenue(t.order_lines(spark, sf, *wanted))


@query("f5_item_mix", f"""
WITH {LINES}, s AS (SELECT canonical_name, menu_group, SUM(quantity) AS u, SUM(line_total) AS s, COUNT(DISTINCT order_guid) AS orders
                    FROM l WHERE {REPORT} GROUP BY 1, 2)
SELECT canonical_name, menu_group, {d("u", "quantity")}, {d("s", "net_sales")}, orders, {q("s", "u", "avg_price")},
       CAST(u AS DOUBLE) / CAST(SUM(u) OVER () AS DOUBLE) AS menu_mix_pct FROM s""")
def item_mix(spark, sf):
    return reports.item_mix(_report_lines(spark, sf, "canonical_name", "menu_group", "order_guid"))


SUMS = f"{d('SUM(line_total)', 'net_sales')}, {d('SUM(quantity)', 'quantity')}"


@query("f8_trend_weekly", f"""
WITH {LINES} SELECT CAST(date_trunc('week', business_date) AS DATE) AS bucket, {SUMS}
FROM l WHERE {REPORT} GROUP BY 1""")
def trend_weekly(spark, sf):
    return reports.trend(_report_lines(spark, sf, "business_date"), "weekly")


@query("f8_trend_period_by_channel", f"""
WITH {LINES}, {CALENDAR}
SELECT COALESCE(period_label, 'Other') AS bucket, channel_code, {SUMS}
FROM l LEFT JOIN cal ON business_date BETWEEN period_start AND period_end WHERE {REPORT} GROUP BY 1, 2""")
def trend_period(spark, sf):
    lines = _report_lines(spark, sf, "business_date", "channel_code")
    return reports.trend(lines, "period", t.calendar(spark), ["channel_code"])


# --- F9 to F14 -----------------------------------------------------------------
@query("f9_category_mix", f"""
WITH {LINES}, s AS (SELECT location_code, menu_group AS category, SUM(line_total) AS s, SUM(quantity) AS u
                    FROM l WHERE {REPORT} GROUP BY 1, 2)
SELECT location_code, category, {d("s", "net_sales")}, {d("u", "quantity")},
       CAST(s AS DOUBLE) / CAST(SUM(s) OVER (PARTITION BY location_code) AS DOUBLE) AS category_mix_pct,
       7 AS category_position
FROM s""")
def category_mix(spark, sf):
    lines = _report_lines(spark, sf, "location_code", "menu_group").withColumnRenamed("menu_group", "category")
    return reports.category_mix(lines, ["location_code"])


CELLS = ", ".join(f"""CAST(SUM(line_total) FILTER (WHERE location_code = '{x}') AS DOUBLE) AS "{x}" """ for x in t.LOCATIONS)

OTHER_PLACES = f"""CAST(SUM(line_total) FILTER (WHERE location_code NOT IN ({", ".join(repr(x) for x in t.LOCATIONS)})) AS DOUBLE) AS other"""


@query("f10_location_matrix", f"""
WITH {LINES}, c AS (SELECT canonical_name, location_code, SUM(line_total) AS s FROM l WHERE {REPORT} GROUP BY 1, 2),
best AS (SELECT canonical_name, location_code AS best_location,
                row_number() OVER (PARTITION BY canonical_name ORDER BY s DESC, location_code) AS n,
                SUM(s) OVER (PARTITION BY canonical_name) AS total, COUNT(*) OVER (PARTITION BY canonical_name) AS k FROM c)
SELECT l.canonical_name, {CELLS}, {OTHER_PLACES}, {q("MAX(total)", "MAX(k)", "avg")}, MAX(best_location) AS best_location
FROM l JOIN best ON best.canonical_name = l.canonical_name AND best.n = 1
WHERE {REPORT} GROUP BY l.canonical_name ORDER BY avg DESC, l.canonical_name LIMIT 20""")
def location_matrix(spark, sf):
    lines = _report_lines(spark, sf, "canonical_name", "location_code")
    return reports.location_matrix(lines, t.LOCATIONS, "revenue", 20)


@query("f10_location_matrix_mix", f"""
WITH {LINES}, c AS (SELECT canonical_name, location_code, SUM(quantity) AS u FROM l WHERE {REPORT} GROUP BY 1, 2),
s AS (SELECT *, CAST(u AS DOUBLE) / CAST(SUM(u) OVER (PARTITION BY location_code) AS DOUBLE) AS v FROM c),
w AS (SELECT canonical_name, {", ".join(f'''MAX(v) FILTER (WHERE location_code = '{x}') AS "{x}"''' for x in t.LOCATIONS)},
             COUNT(*) AS k FROM s GROUP BY 1),
b AS (SELECT canonical_name, location_code AS best_location FROM
      (SELECT *, row_number() OVER (PARTITION BY canonical_name ORDER BY v DESC, location_code) AS n FROM s) WHERE n = 1)
SELECT w.canonical_name, {", ".join(f'"{x}"' for x in t.LOCATIONS)}, CAST(NULL AS DOUBLE) AS other,
       ({" + ".join(f'COALESCE("{x}", 0)' for x in t.LOCATIONS)}) / k AS avg, best_location
FROM w JOIN b USING (canonical_name)""")
def location_matrix_mix(spark, sf):
    lines = _report_lines(spark, sf, "canonical_name", "location_code")
    return reports.location_matrix(lines, t.LOCATIONS, "mix", None)


CHANNEL_CELLS = ", ".join(
    f"COALESCE(CAST(SUM(line_total) FILTER (WHERE channel_code = '{c}') AS DOUBLE), 0) AS {c.lower()}"
    for c in ("IN_HOUSE", "APP", "TPD", "CATERING", "OFFSITE", "OTHER")
)


@query("f11_channel_split", f"""
WITH {LINES} SELECT canonical_name, {CHANNEL_CELLS}, CAST(0 AS DOUBLE) AS unlisted, {d("SUM(line_total)", "total")}
FROM l WHERE {REPORT} GROUP BY canonical_name""")
def channel_split(spark, sf):
    return reports.channel_split(_report_lines(spark, sf, "canonical_name", "channel_code"))


@query("f12_location_cards", f"""
WITH {LINES}, s AS (SELECT location_code, SUM(line_total) AS s, SUM(quantity) AS u FROM l WHERE {REPORT} GROUP BY 1)
SELECT location_code, {d("s", "revenue")}, {d("u", "items_sold")},
       CAST(s AS DOUBLE) / CAST(SUM(s) OVER () AS DOUBLE) AS revenue_share,
       CAST(u AS DOUBLE) / CAST(SUM(u) OVER () AS DOUBLE) AS menu_mix_pct
FROM s""")
def location_cards(spark, sf):
    return reports.location_cards(_report_lines(spark, sf, "location_code"))


def _vendor_sql(channel: str, vendor: str) -> str:
    return f"""
WITH {LINES}, s AS (SELECT {vendor} AS vendor, COUNT(DISTINCT order_guid) AS orders, SUM(line_total) AS r
                    FROM l WHERE {REPORT} AND channel_code = '{channel}' GROUP BY 1)
SELECT vendor, orders, {d("r", "revenue")}, {q("r", "orders", "avg_order_value")},
       CAST(r AS DOUBLE) / CAST(SUM(r) OVER () AS DOUBLE) AS share FROM s"""


for _channel, _vendor in (("CATERING", "alt_payment_name"), ("OFFSITE", "menu_group"), ("TPD", "alt_payment_name")):
    query(f"f13_vendor_breakdown_{_channel.lower()}", _vendor_sql(_channel, _vendor))(
        lambda spark, sf, c=_channel: reports.vendor_breakdown(
            _report_lines(spark, sf, "channel_code", "order_guid", "alt_payment_name", "menu_group"), c))


@query("f13_channel_kpis", f"""
WITH {LINES}
SELECT {d("SUM(line_total) FILTER (WHERE channel_code = 'CATERING')", "revenue")},
       COUNT(DISTINCT order_guid) FILTER (WHERE channel_code = 'CATERING') AS orders,
       {q("SUM(line_total) FILTER (WHERE channel_code = 'CATERING')",
          "COUNT(DISTINCT order_guid) FILTER (WHERE channel_code = 'CATERING')", "avg_order_value")},
       {q("SUM(line_total) FILTER (WHERE channel_code = 'CATERING')", "SUM(line_total)", "share")}
FROM l WHERE {REPORT}""")
def channel_kpis(spark, sf):
    return reports.channel_kpis(_report_lines(spark, sf, "channel_code", "order_guid"), "CATERING")


PAYMENTS = f"""{ORDERS},
pay AS (SELECT order_guid || '-p' AS payment_guid, order_guid, location_code, business_date,
               CASE menu_name WHEN 'F' THEN 'CREDIT' WHEN 'O' THEN 'CASH' ELSE 'OTHER' END AS payment_type,
               CASE WHEN menu_name = 'P' THEN alt_payment_name END AS alt_payment_name, order_total AS amount FROM o)"""


def _payment_sql(keys: str) -> str:
    return f"""
WITH {PAYMENTS}, s AS (
  SELECT {keys}, COUNT(*) AS payments, SUM(amount) AS r
  FROM (SELECT *, COALESCE(alt_payment_name, payment_type) AS source FROM pay) GROUP BY {keys})
SELECT {keys}, payments, {d("r", "revenue")}, {q("r", "payments", "avg_ticket")},
       CAST(r AS DOUBLE) / CAST(SUM(r) OVER () AS DOUBLE) AS share FROM s"""


@query("f14_payment_mix", _payment_sql("source, payment_type"))
def payment_mix(spark, sf):
    return reports.payment_mix(t.payments(spark, sf))


@query("f14_payment_mix_by_location", _payment_sql("location_code, payment_type"))
def payment_mix_by_location(spark, sf):
    return reports.payment_mix(t.payments(spark, sf), ["location_code", "payment_type"])


@query("f15_byo_breakdown", f"""
WITH {LINES}, {modifier_cte()},
p AS (SELECT * FROM l WHERE {REPORT} AND channel_code IN ('IN_HOUSE', 'APP', 'TPD')),
s AS (SELECT COALESCE(m.mod_type, 'Untyped') AS mod_type, m.canonical_name, SUM(m.quantity) AS u, COUNT(DISTINCT p.order_guid) AS orders
      FROM m JOIN p ON m.parent_selection = p.selection_guid WHERE NOT m.is_voided GROUP BY 1, 2)
SELECT s.mod_type, s.canonical_name, {d("u", "quantity")}, orders,
       {q("orders", "(SELECT COUNT(DISTINCT order_guid) FROM p)", "order_share")},
       CAST(u AS DOUBLE) / CAST(SUM(u) OVER (PARTITION BY s.mod_type) AS DOUBLE) AS type_share
FROM s""")
def byo_breakdown(spark, sf):
    lines = t.order_lines(spark, sf, "selection_guid", "order_guid", "canonical_name", "channel_code",
                          "location_code", "business_date", "is_voided", "is_deferred")
    return reports.byo_breakdown(t.modifiers(spark, sf), lines, channels=["IN_HOUSE", "APP", "TPD"])


# --- F16 to F18 ----------------------------------------------------------------
@query("f16_renames_audit", f"""
WITH {LINES}
SELECT canonical_name, list_sort(list(DISTINCT raw_name)) AS raw_names,
       {d("SUM(quantity) FILTER (WHERE NOT is_voided)", "lifetime_quantity")},
       {d("SUM(line_total) FILTER (WHERE NOT is_voided)", "lifetime_sales")},
       COUNT(DISTINCT location_code) AS locations, MIN(business_date) AS first_seen,
       CAST(COUNT(DISTINCT raw_name) AS INTEGER) AS n_names
FROM l GROUP BY canonical_name HAVING COUNT(DISTINCT raw_name) > 1""")
def renames_audit(spark, sf):
    return reports.renames_audit(t.order_lines(
        spark, sf, "canonical_name", "raw_name", "location_code", "business_date", "quantity", "line_total", "is_voided"))


def _open_items(spark, sf):
    lines = t.order_lines(spark, sf, "canonical_name", "menu_group", "sales_category", "dining_option", "alt_payment_name",
                          "business_date", "quantity", "line_total", "is_voided", "is_deferred", "menu_name")
    blanked = lines.withColumn("menu_group", F.when(F.col("menu_group") != "SMALL", F.col("menu_group")))
    kept = filters.inclusion_rule(blanked).withColumn("channel_code", filters.line_channel(t.LINE_PATTERNS))
    part = t.table(spark, sf, "part")
    lookup = part.groupBy(F.col("p_name").alias("cleaned_item_name")).agg(F.max("p_type").alias("category_2"))
    listed = lookup.filter(~F.col("cleaned_item_name").startswith("hot "))
    known = rule_frame(spark, [("STANDARD",), ("MEDIUM",)], "sub_category string")
    costs = t.item_costs(spark, sf).filter(F.col("period_key") == 199901)
    return reports.open_items(kept, listed, known, costs, t.PAYMENT_PATTERNS)


OPEN = f"""{LINES},
k AS (SELECT canonical_name, sales_category, CASE WHEN menu_group <> 'SMALL' THEN menu_group END AS menu_group,
             quantity, line_total, business_date,
             CASE WHEN dining_option ILIKE '%urgent%' OR sales_category ILIKE '%#25%' THEN 'CATERING'
                  WHEN dining_option ILIKE '%low%' OR dining_option ILIKE '%not specified%' THEN 'APP'
                  ELSE 'IN_HOUSE' END AS channel_code,
             CASE WHEN alt_payment_name = 'FURNITURE' THEN 'CATERING' WHEN alt_payment_name = 'MACHINERY' THEN 'OFFSITE'
                  WHEN alt_payment_name = 'AUTOMOBILE' THEN 'TPD' END AS paid
      FROM l WHERE {REPORT}),
s AS (SELECT canonical_name, sales_category, menu_group, channel_code, SUM(quantity) AS u, SUM(line_total) AS r,
             MAX(business_date) AS last_seen, bool_or(COALESCE(paid <> channel_code, FALSE)) AS wrong
      FROM k GROUP BY 1, 2, 3, 4),
look AS (SELECT p_name AS canonical_name, MAX(p_type) AS category_2 FROM part WHERE p_name NOT LIKE 'hot %' GROUP BY 1),
priced AS (SELECT DISTINCT p_name AS canonical_name FROM part WHERE 1995 + p_partkey % 7 = 1999 AND p_size % 13 + 1 = 1),
f AS (SELECT s.*, look.category_2, look.canonical_name IS NOT NULL AS listed, priced.canonical_name IS NOT NULL AS has_cost,
             COALESCE(look.category_2 IN ('STANDARD', 'MEDIUM'), FALSE) AS mapped
      FROM s LEFT JOIN look USING (canonical_name) LEFT JOIN priced USING (canonical_name)),
oi AS (SELECT canonical_name, sales_category, menu_group, channel_code, {d("u", "quantity")}, {d("r", "net_sales")}, last_seen,
       CASE WHEN has_cost THEN CAST([] AS VARCHAR[]) ELSE ['NO COST'] END
       || CASE WHEN mapped THEN CAST([] AS VARCHAR[]) ELSE ['UNCATEGORIZED'] END
       || CASE WHEN menu_group IS NULL THEN ['MISSING MENU GROUP'] ELSE CAST([] AS VARCHAR[]) END
       || CASE WHEN wrong THEN ['WRONG CHANNEL'] ELSE CAST([] AS VARCHAR[]) END AS issues,
       CASE WHEN NOT listed THEN 'Add to item lookup: ' || canonical_name
            WHEN NOT mapped THEN 'Map sub-category: ' || category_2
            WHEN menu_group IS NULL THEN 'Assign menu group for: ' || canonical_name END AS suggested_fix
       FROM f WHERE menu_group IS NULL OR NOT mapped)"""


@query("f17_open_items", f"WITH {OPEN} SELECT * FROM oi")
def open_items(spark, sf):
    return _open_items(spark, sf)


@query("f17_open_items_no_cost", f"WITH {OPEN} SELECT * FROM oi WHERE list_contains(issues, 'NO COST')")
def open_items_no_cost(spark, sf):
    return reports.with_issue(_open_items(spark, sf), "NO COST")


@query("f17_open_item_totals", f"""
WITH {OPEN}
SELECT COUNT(DISTINCT canonical_name) AS open_items, {d("SUM(CAST(net_sales AS DECIMAL(28,4)))", "revenue_affected")},
       COUNT(DISTINCT canonical_name) FILTER (WHERE list_contains(issues, 'NO COST')) AS missing_cost,
       COUNT(DISTINCT canonical_name) FILTER (WHERE list_contains(issues, 'UNCATEGORIZED')) AS uncategorized
FROM oi""")
def open_item_totals(spark, sf):
    return reports.open_item_totals(_open_items(spark, sf))


@query("f18_needs_review", f"""
WITH {LINES}, c AS (
  SELECT *, CASE WHEN menu_name = 'P' THEN 'APP' ELSE channel_code END AS current_channel,
         CASE WHEN alt_payment_name = 'FURNITURE' THEN 'CATERING' WHEN alt_payment_name = 'MACHINERY' THEN 'OFFSITE'
              WHEN alt_payment_name = 'AUTOMOBILE' THEN 'TPD' END AS suggested_channel FROM l)
SELECT order_guid, location_code, business_date, current_channel AS channel_code, dining_option, alt_payment_name,
       suggested_channel, {d("SUM(line_total)", "amount")}, 'CHANNEL_CONFLICT' AS issue_type
FROM c WHERE suggested_channel <> current_channel GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def needs_review(spark, sf):
    lines = t.order_lines(spark, sf, "order_guid", "location_code", "business_date", "channel_code", "dining_option",
                          "alt_payment_name", "line_total", "menu_name")
    stored = lines.withColumn("channel_code", F.when(F.col("menu_name") == "P", "APP").otherwise(F.col("channel_code")))
    return reports.needs_review(stored, t.PAYMENT_PATTERNS)


# --- F21, F22 ------------------------------------------------------------------
@query("f21_verify_metrics", f"""
WITH {ITEMS} SELECT canonical_name, channel_code, TRUE AS price_ok, TRUE AS cost_ok, TRUE AS cogs_ok,
  TRUE AS margin_pct_ok, TRUE AS margin_ok FROM im""")
def verify_metrics(spark, sf):
    checked = reports.verify_metrics(item_metrics(spark, sf))
    return checked.select("canonical_name", "channel_code", "price_ok", "cost_ok", "cogs_ok", "margin_pct_ok", "margin_ok")


@query("f21_verify_blended_quantity", f"""
WITH {ITEMS} SELECT canonical_name, {d("SUM(quantity)", "quantity")}, TRUE AS blended_ok FROM im
WHERE channel_code IN ('IN_HOUSE', 'APP', 'TPD') GROUP BY 1""")
def verify_blended(spark, sf):
    items = item_metrics(spark, sf).filter(F.col("channel_code").isin("IN_HOUSE", "APP", "TPD"))
    wide = items.groupBy("canonical_name").pivot("channel_code", ["IN_HOUSE", "APP", "TPD"]).agg(F.sum("quantity"))
    wide = wide.withColumnsRenamed({"IN_HOUSE": "ih_quantity", "APP": "app_quantity", "TPD": "tpd_quantity"})
    both = reports.blended_metrics(items).join(wide, "canonical_name")
    sheet = both.withColumns({
        "avg_price": F.col("blended_avg_price"), "avg_cost": F.col("blended_avg_cost"),
        "cogs_pct": 1 - F.col("blended_margin"), "margin_pct": F.col("blended_margin"),
        "margin": F.col("blended_avg_price") - F.col("blended_avg_cost"),
    })
    return reports.verify_metrics(sheet).select("canonical_name", "quantity", "blended_ok")


@query("f22_freshness", "SELECT MAX(CAST(o_orderdate AS DATE)) AS last_business_date FROM orders")
def freshness(spark, sf):
    return reports.freshness(t.orders(spark, sf, {"business_date"}))


# --- H1 to H8 ------------------------------------------------------------------
@query("h1_share_of_scope", f"""
WITH {LINES}, s AS (SELECT canonical_name, SUM(line_total) AS s FROM l WHERE {REPORT} GROUP BY 1)
SELECT canonical_name, {d("s", "net_sales")}, CAST(s AS DOUBLE) / CAST(SUM(s) OVER () AS DOUBLE) AS sls_pct FROM s""")
def share_of_scope(spark, sf):
    sums = _report_lines(spark, sf, "canonical_name").groupBy("canonical_name").agg(F.sum("line_total").alias("net_sales"))
    return shares.share_of(sums, "net_sales", out="sls_pct")


@query("h1_share_within_location", f"""
WITH {LINES}, s AS (SELECT location_code, canonical_name, SUM(quantity) AS u FROM l WHERE {REPORT} GROUP BY 1, 2)
SELECT location_code, canonical_name, {d("u", "quantity")},
       CAST(u AS DOUBLE) / CAST(SUM(u) OVER (PARTITION BY location_code) AS DOUBLE) AS menu_mix_pct FROM s""")
def share_within_location(spark, sf):
    keys = ["location_code", "canonical_name"]
    sums = _report_lines(spark, sf, *keys).groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    return shares.share_of(sums, "quantity", ["location_code"], "menu_mix_pct")


@query("h3_mix_rank", f"""
WITH {LINES}, s AS (SELECT canonical_name, channel_code, SUM(quantity) AS u FROM l WHERE {REPORT} GROUP BY 1, 2)
SELECT canonical_name, channel_code, {d("u", "quantity")}, rank() OVER (ORDER BY u DESC) AS mix_rank FROM s""")
def mix_rank(spark, sf):
    keys = ["canonical_name", "channel_code"]
    sums = _report_lines(spark, sf, *keys).groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    return shares.mix_rank(sums)


@query("h3_order_rank", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_guid, {d("CAST(o_totalprice AS DECIMAL(18,4))", "order_total")},
       rank() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,4)) DESC) AS rank FROM orders""")
def order_rank(spark, sf):
    return shares.global_rank(t.orders(spark, sf, {"order_total"}).select("order_guid", "order_total"), "order_total")


@query("h4_vs_prior", f"""
WITH {LINES}, w AS (
  SELECT channel_code, SUM(line_total) FILTER (WHERE business_date >= DATE '1999-01-01') AS c,
         SUM(line_total) FILTER (WHERE business_date < DATE '1999-01-01') AS p
  FROM l WHERE {REPORT} AND business_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' GROUP BY 1),
s AS (SELECT *, CAST(c AS DOUBLE) / CAST(SUM(c) OVER () AS DOUBLE) AS cs, CAST(p AS DOUBLE) / CAST(SUM(p) OVER () AS DOUBLE) AS ps FROM w)
SELECT channel_code, {d("c", "current_value")}, {d("p", "prior_value")}, {d("COALESCE(c, 0) - COALESCE(p, 0)", "change")},
       {q("COALESCE(c, 0) - COALESCE(p, 0)", "p", "change_pct")}, cs AS current_share, ps AS prior_share,
       (COALESCE(cs, 0) - COALESCE(ps, 0)) * 100 AS share_change_pp
FROM s""")
def vs_prior(spark, sf):
    lines = _report_lines(spark, sf, "channel_code", "business_date")
    return shares.vs_prior(lines, date(1999, 1, 1), date(1999, 12, 31), ["channel_code"], share=True)


@query("h5_top_items", f"""
WITH {LINES} SELECT canonical_name, {d("SUM(quantity)", "quantity")}, {d("SUM(line_total)", "net_sales")}, COUNT(*) AS n_lines
FROM l WHERE NOT is_voided GROUP BY 1 ORDER BY net_sales DESC, canonical_name LIMIT 20""")
def top_items(spark, sf):
    lines = t.order_lines(spark, sf, "canonical_name", "quantity", "line_total", "is_voided")
    return shares.top_items(reports.item_sales(filters.filter_revenue(lines, "load"), ["canonical_name"]), 20)


@query("h5_top_items_per_channel", f"""
WITH {LINES}, s AS (SELECT canonical_name, channel_code, SUM(quantity) AS u, SUM(line_total) AS s, COUNT(*) AS n_lines
                    FROM l WHERE {REPORT} GROUP BY 1, 2)
SELECT canonical_name, channel_code, {d("u", "quantity")}, {d("s", "net_sales")}, n_lines, CAST(n AS INTEGER) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY channel_code ORDER BY s DESC, canonical_name) AS n FROM s) WHERE n <= 8""")
def top_items_per_channel(spark, sf):
    items = reports.item_sales(_report_lines(spark, sf, "canonical_name", "channel_code"))
    return shares.top_items(items, 8, per=["channel_code"])


@query("h6_page", f"""
WITH {LINES} SELECT canonical_name, {d("SUM(quantity)", "quantity")}, {d("SUM(line_total)", "net_sales")}, COUNT(*) AS n_lines
FROM l WHERE {REPORT} GROUP BY 1 ORDER BY net_sales DESC, canonical_name LIMIT 25 OFFSET 25""")
def page(spark, sf):
    items = reports.item_sales(_report_lines(spark, sf, "canonical_name"), ["canonical_name"])
    return shares.page(items, 2, [F.desc("net_sales"), "canonical_name"])


@query("h8_subtotals", f"""
WITH {LINES}
SELECT menu_group, sales_category, canonical_name, {d("SUM(line_total)", "net_sales")}, {d("SUM(quantity)", "quantity")},
       CAST(GROUPING(menu_group) + GROUPING(sales_category) + GROUPING(canonical_name) AS INTEGER) AS level
FROM l WHERE {REPORT} GROUP BY ROLLUP (menu_group, sales_category, canonical_name)""")
def subtotals(spark, sf):
    levels = ["menu_group", "sales_category", "canonical_name"]
    return shares.subtotals(
        _report_lines(spark, sf, *levels), levels, {"net_sales": "line_total", "quantity": "quantity"})
