"""Costs and menu engineering over the test tables (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from menumix.functions.calendar import calendar_days
from menumix.functions.scalars import meal_bucket, normalise_modifier_type
from menumix.operators import costing, engineering, filters
from menumix.plans import driver_tables as t
from menumix.plans.catalogue import CALENDAR, LINES, REPORT, d, modifier_cte, q, query
from menumix.plans.menu_report import menu_report
from menumix.plans.report_queries import ITEMS, item_metrics
from menumix.session import rule_frame, scratch_path
from menumix.sources import files

COSTS = """
unit AS (SELECT canonical_name AS cost_name, CAST(s_suppkey % 13 + 1 AS INTEGER) AS period_key,
                MIN(CAST(abs(CAST(s_acctbal AS DECIMAL(12,2))) AS DECIMAL(12,4))) AS unit_cost
         FROM supplier JOIN names ON pick = s_suppkey % 20 WHERE pick NOT IN (1, 2, 3, 6, 14, 18) GROUP BY 1, 2),
rules AS (SELECT DISTINCT canonical_name,
            CASE WHEN canonical_name LIKE '% - Pick 2 Combo' THEN trim(left(canonical_name, length(canonical_name) - 15))
                 WHEN canonical_name LIKE 'Organic %' THEN substr(canonical_name, 9)
                 WHEN canonical_name LIKE '1/2 %' THEN regexp_replace(substr(canonical_name, 5), '^and ', '')
                 WHEN canonical_name LIKE 'Extra %' THEN substr(canonical_name, 7) END AS base_name,
            CASE WHEN canonical_name LIKE '1/2 %' THEN 0.5 ELSE 1.0 END AS part,
            regexp_matches(canonical_name, '(?i)^skip|^no |utensil|plastic bag|bag|disposable') AS is_zero FROM names)"""

MODS = f"""{LINES}, {CALENDAR}, {modifier_cte()}, {COSTS},
mq AS (SELECT l.canonical_name AS item_name, channel_code, CAST(period_no AS INTEGER) AS period_key,
              CASE m.mod_type WHEN 'Sides' THEN 'Make it a Meal' WHEN 'Drinks' THEN 'Make it a Meal' ELSE COALESCE(m.mod_type, 'Untyped') END AS mod_type,
              m.canonical_name, SUM(m.quantity) AS quantity
       FROM m JOIN l ON m.parent_selection = l.selection_guid LEFT JOIN cal ON business_date BETWEEN period_start AND period_end
       WHERE NOT m.is_voided AND NOT l.is_voided AND NOT l.is_deferred GROUP BY 1, 2, 3, 4, 5),
named AS (SELECT DISTINCT canonical_name, period_key FROM mq),
uc AS (SELECT n.canonical_name, n.period_key, is_zero, own.unit_cost AS own_cost, CAST(made.unit_cost * CAST(part AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS derived
       FROM named n JOIN rules USING (canonical_name)
       LEFT JOIN unit own ON own.cost_name = n.canonical_name AND own.period_key = n.period_key
       LEFT JOIN unit made ON made.cost_name = base_name AND made.period_key = n.period_key),
halves AS (SELECT item_name, channel_code, mq.period_key, mod_type,
                  SUM(CAST(quantity AS DECIMAL(20,4)) * unit_cost) AS half_amount, SUM(quantity) AS half_quantity
           FROM mq LEFT JOIN unit ON cost_name = substr(canonical_name, 5) AND unit.period_key = mq.period_key
           WHERE canonical_name LIKE '1/2 %' AND canonical_name NOT LIKE '1/2 and 1/2 %' GROUP BY 1, 2, 3, 4),
typed AS (
  SELECT mq.item_name, mq.channel_code, mq.period_key, mq.mod_type, mq.quantity,
         CASE WHEN mq.mod_type = 'Untyped' THEN NULL WHEN mq.canonical_name LIKE '1/2 and 1/2 %'
              THEN CAST(CAST(mq.quantity AS DOUBLE) * (CAST(half_amount AS DOUBLE) / CAST(half_quantity AS DOUBLE)) AS DECIMAL(24,4))
              ELSE CAST(mq.quantity * CASE WHEN is_zero THEN 0 ELSE COALESCE(derived, own_cost) END AS DECIMAL(24,4)) END AS cost
  FROM mq LEFT JOIN uc ON uc.canonical_name = mq.canonical_name AND uc.period_key IS NOT DISTINCT FROM mq.period_key
  LEFT JOIN halves h ON h.item_name = mq.item_name AND h.channel_code = mq.channel_code
       AND h.period_key = mq.period_key AND h.mod_type = mq.mod_type),
tc AS (SELECT item_name, channel_code, period_key, mod_type, SUM(cost) AS type_cost, SUM(quantity) AS modifier_quantity,
              COALESCE(SUM(quantity) FILTER (WHERE cost IS NULL), 0) AS unpriced_quantity FROM typed GROUP BY 1, 2, 3, 4)"""


def _unit_costs(spark, sf):
    return costing.modifier_unit_costs(t.modifier_costs(spark, sf))


def _quantities(spark, sf):
    """Modifier quantities per item, channel and period number, untyped ones as a type of their own."""
    lines = t.order_lines(spark, sf, "selection_guid", "order_guid", "canonical_name", "channel_code", "location_code",
                          "business_date", "is_voided", "is_deferred")
    days = calendar_days(t.calendar(spark)).select("business_date", (F.col("period_key") % 100).alias("period_key"))
    return costing.modifier_quantities(t.modifiers(spark, sf), lines, days)


# --- G1 to G6 ------------------------------------------------------------------
@query("g1_derive_modifier_cost", f"""
WITH {modifier_cte()}, {COSTS}, n AS (SELECT DISTINCT canonical_name, period_key FROM m, (SELECT DISTINCT period_key FROM unit))
SELECT n.canonical_name, n.period_key,
       CAST(CASE WHEN is_zero THEN 0 ELSE COALESCE(CAST(made.unit_cost * CAST(part AS DECIMAL(2,1)) AS DECIMAL(12,4)), own.unit_cost) END AS DOUBLE) AS unit_cost,
       CASE WHEN is_zero THEN 'zero' WHEN made.unit_cost IS NOT NULL THEN 'derived' WHEN own.unit_cost IS NOT NULL THEN 'listed' ELSE 'missing' END AS cost_rule
FROM n JOIN rules USING (canonical_name) LEFT JOIN unit own ON own.cost_name = n.canonical_name AND own.period_key = n.period_key
LEFT JOIN unit made ON made.cost_name = base_name AND made.period_key = n.period_key""")
def derive_modifier_cost(spark, sf):
    """Every modifier name that was sold, in every period that has costs."""
    costs = _unit_costs(spark, sf)
    periods = costs.agg(F.collect_set("period_key").alias("periods"))
    sold = t.modifiers(spark, sf).select("canonical_name").distinct()
    names = sold.withColumn("period_key", F.explode(periods.scalar()))
    return costing.derive_modifier_cost(names, costs)


@query("g2_half_and_half_cost", f"""
WITH {MODS} SELECT item_name, channel_code, period_key, mod_type, {d("half_amount", "half_amount")}, {d("half_quantity", "half_quantity")},
       {q("half_amount", "half_quantity", "half_cost")} FROM halves""")
def half_and_half_cost(spark, sf):
    return costing.half_and_half_cost(_quantities(spark, sf), _unit_costs(spark, sf))


TYPE_COLUMNS = f"item_name, channel_code, period_key, mod_type, {d('type_cost', 'type_cost')}, {d('modifier_quantity', 'modifier_quantity')}, {d('unpriced_quantity', 'unpriced_quantity')}"


@query("g3_modifier_cost_by_type", f"WITH {MODS} SELECT {TYPE_COLUMNS} FROM tc")
def modifier_cost_by_type(spark, sf):
    return costing.modifier_cost_by_type(_quantities(spark, sf), _unit_costs(spark, sf))


SCOPED = "channel_code IN ('APP', 'TPD') OR mod_type IN ('Main', 'Extra Main', 'Make it a Meal', 'Untyped')"


@query("g4_channel_modifier_scope", f"""
WITH {MODS} SELECT channel_code, mod_type, {d("SUM(quantity)", "quantity")} FROM mq
WHERE {SCOPED} GROUP BY 1, 2""")
def channel_modifier_scope(spark, sf):
    kept = costing.channel_modifier_scope(_quantities(spark, sf))
    return kept.groupBy("channel_code", "mod_type").agg(F.sum("quantity").alias("quantity"))


def _with_sub_category(df):
    """Items called plate take the plate sub-category."""
    return df.withColumn("sub_category", F.when(F.col("item_name").endswith("plate"), "Plates"))


@query("g5_plates_rule", f"""
WITH {MODS} SELECT item_name, mod_type, {d("SUM(quantity)", "quantity")} FROM mq
WHERE NOT (item_name LIKE '%plate' AND mod_type IN ('Main', 'Extra Main')) GROUP BY 1, 2""")
def plates_rule(spark, sf):
    kept = costing.plates_rule(_with_sub_category(_quantities(spark, sf)))
    return kept.groupBy("item_name", "mod_type").agg(F.sum("quantity").alias("quantity"))


@query("g6_meal_bucket", f"""
WITH {modifier_cte()}
SELECT CASE WHEN mod_type IN ('Sides', 'Drinks', 'Sweets') THEN 'Make it a Meal' ELSE mod_type END AS mod_type, {d("SUM(quantity)", "quantity")}
FROM m GROUP BY 1""")
def meal(spark, sf):
    mods = t.modifiers(spark, sf).withColumn("mod_type", meal_bucket(F.col("mod_type")))
    return mods.groupBy("mod_type").agg(F.sum("quantity").alias("quantity"))


@query("g6_normalise_modifier_type", f"""
WITH {modifier_cte()}
SELECT modifier_guid, CASE WHEN mod_type IN ('Sides', 'Drinks') THEN 'Make it a Meal' ELSE mod_type END AS mod_type FROM m WHERE mod_type IS NOT NULL""")
def normalise_types(spark, sf):
    """Labels written in several ways come back to one set."""
    written = F.when(F.col("depth") == 1, F.upper("mod_type")).when(F.col("mod_type").isin("Sides", "Drinks"), F.col("mod_type")).otherwise(
        F.concat(F.lit(" "), F.lower("mod_type")))
    mods = t.modifiers(spark, sf).filter(F.col("mod_type").isNotNull())
    return mods.select("modifier_guid", normalise_modifier_type(written).alias("mod_type"))


# --- G7 to G11 -----------------------------------------------------------------
def _type_costs(spark, sf):
    scoped = costing.channel_modifier_scope(_quantities(spark, sf))
    return costing.modifier_cost_by_type(costing.plates_rule(_with_sub_category(scoped)).drop("sub_category"), _unit_costs(spark, sf))


def costed_items(spark, sf):
    """Items per channel and period number with base cost and category."""
    lines = filters.filter_revenue(t.order_lines(
        spark, sf, "canonical_name", "channel_code", "business_date", "quantity", "line_total", "is_voided", "is_deferred"))
    days = calendar_days(t.calendar(spark)).select("business_date", (F.col("period_key") % 100).alias("period_key"))
    items = lines.join(days, "business_date", "left").groupBy("canonical_name", "channel_code", "period_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("net_sales"))
    category = F.when(F.col("canonical_name").endswith("rod"), "Sides").otherwise("Entrees")
    return items.join(t.base_costs(spark, sf), "canonical_name", "left").withColumn("category", category)


SCOPED_MODS = MODS.replace("tc AS (SELECT", f"""kept AS (SELECT * FROM typed WHERE ({SCOPED})
  AND NOT (item_name LIKE '%plate' AND mod_type IN ('Main', 'Extra Main'))),
tc AS (SELECT""").replace("FROM typed GROUP BY 1, 2, 3, 4)", "FROM kept GROUP BY 1, 2, 3, 4)")
COSTED = f"""{SCOPED_MODS},
base AS (SELECT p_name AS canonical_name, MIN(CAST(p_retailprice AS DECIMAL(12,4))) AS base_cost FROM part GROUP BY 1),
it AS (SELECT canonical_name, channel_code, CAST(period_no AS INTEGER) AS period_key, SUM(quantity) AS quantity, SUM(line_total) AS net_sales
       FROM l LEFT JOIN cal ON business_date BETWEEN period_start AND period_end WHERE {REPORT} GROUP BY 1, 2, 3),
mt AS (SELECT item_name, channel_code AS ch, period_key AS pk, SUM(type_cost) AS mc, SUM(unpriced_quantity) AS uq FROM tc GROUP BY 1, 2, 3),
ci AS (SELECT it.*, base_cost, CASE WHEN canonical_name LIKE '%rod' THEN 'Sides' ELSE 'Entrees' END AS category,
              CAST(CASE WHEN canonical_name LIKE '%rod' THEN 0
                   ELSE CAST(COALESCE(mc, 0) AS DECIMAL(24,4)) * CAST(CASE channel_code WHEN 'TPD' THEN 1.18 ELSE 1 END AS DECIMAL(3,2)) END AS DECIMAL(28,4)) AS total_modifier_cost,
              CAST(base_cost * CAST(quantity AS DECIMAL(20,4)) AS DECIMAL(28,4)) AS total_base_cost,
              CASE WHEN canonical_name LIKE '%rod' THEN 0 ELSE COALESCE(uq, 0) END AS unpriced_quantity
       FROM it JOIN base USING (canonical_name) LEFT JOIN mt ON mt.item_name = canonical_name AND ch = channel_code AND pk IS NOT DISTINCT FROM period_key),
ct AS (SELECT *, total_base_cost + total_modifier_cost AS total_cost FROM ci)"""


@query("g7_avg_cost_with_modifiers", f"""
WITH {COSTED} SELECT canonical_name, channel_code, period_key, category, {d("quantity", "quantity")}, {d("net_sales", "net_sales")},
  {d("base_cost", "base_cost")}, {d("total_modifier_cost", "total_modifier_cost")}, {d("total_base_cost", "total_base_cost")},
  {d("total_cost", "total_cost")}, {q("total_cost", "quantity", "avg_cost")}, {d("unpriced_quantity", "unpriced_quantity")} FROM ct""")
def avg_cost_with_modifiers(spark, sf):
    return costing.avg_cost_with_modifiers(costed_items(spark, sf), _type_costs(spark, sf))


def _engineering_sql(strict: bool, by_channel: bool) -> str:
    op = ">" if strict else ">="
    keys = "GROUP BY channel_code" if by_channel else ""
    join = "JOIN th USING (channel_code)" if by_channel else ", th"
    key = "channel_code, " if by_channel else ""
    return f"""{ITEMS},
cat AS (SELECT *, CASE WHEN canonical_name NOT LIKE 'old %' THEN 'Entrees' END AS category FROM im),
scoped AS (SELECT * FROM cat WHERE channel_code IN ('IN_HOUSE', 'APP', 'TPD') AND category IS NOT NULL AND quantity > 0 AND avg_cost > 0),
th AS (SELECT {key}COUNT(*) AS n_items, CAST(SUM(total_margin) AS DOUBLE) / CAST(SUM(net_sales) AS DOUBLE) AS margin_threshold,
              1 / CAST(COUNT(*) AS DOUBLE) * CAST(0.7 AS DOUBLE) AS mix_threshold FROM scoped {keys}),
cl AS (SELECT s.*, n_items, margin_threshold, mix_threshold,
              CASE WHEN margin_pct {op} margin_threshold THEN 'High' ELSE 'Low' END AS margin_class,
              CASE WHEN menu_mix_pct {op} mix_threshold THEN 'High' ELSE 'Low' END AS mix_class FROM scoped s {join}),
me AS (SELECT *, CASE margin_class || mix_class WHEN 'HighHigh' THEN 'Star' WHEN 'HighLow' THEN 'Puzzle'
                 WHEN 'LowHigh' THEN 'Plow Horse' ELSE 'Dog' END AS quadrant FROM cl)"""


def _categorised(spark, sf):
    items = item_metrics(spark, sf)
    return items.withColumn("category", F.when(~F.col("canonical_name").startswith("old "), "Entrees"))


@query("g8_menu_engineering", f"""
WITH {_engineering_sql(True, False)}
SELECT cat.canonical_name, cat.channel_code, {d("cat.net_sales", "net_sales")}, cat.margin_pct, cat.menu_mix_pct,
       (SELECT n_items FROM th) AS n_items, (SELECT margin_threshold FROM th) AS margin_threshold,
       (SELECT mix_threshold FROM th) AS mix_threshold, margin_class, mix_class, quadrant
FROM cat LEFT JOIN me USING (canonical_name, channel_code)""")
def menu_engineering(spark, sf):
    return engineering.menu_engineering(_categorised(spark, sf)).select(
        "canonical_name", "channel_code", "net_sales", "margin_pct", "menu_mix_pct", "n_items", "margin_threshold",
        "mix_threshold", "margin_class", "mix_class", "quadrant")


@query("g8_menu_engineering_by_channel", f"""
WITH {_engineering_sql(False, True)}
SELECT canonical_name, channel_code, n_items, margin_threshold, mix_threshold, quadrant FROM me""")
def menu_engineering_by_channel(spark, sf):
    out = engineering.menu_engineering(_categorised(spark, sf), strict=False, by=["channel_code"])
    return out.filter(F.col("quadrant").isNotNull()).select(
        "canonical_name", "channel_code", "n_items", "margin_threshold", "mix_threshold", "quadrant")


@query("g9_quadrant_summary", f"""
WITH {_engineering_sql(True, False)}, s AS (SELECT quadrant, COUNT(*) AS n_items, SUM(net_sales) AS s FROM me GROUP BY 1)
SELECT quadrant, n_items, {d("s", "net_sales")}, CAST(s AS DOUBLE) / CAST(SUM(s) OVER () AS DOUBLE) AS revenue_share FROM s""")
def quadrant_summary(spark, sf):
    return engineering.quadrant_summary(engineering.menu_engineering(_categorised(spark, sf)))


@query("g10_overall_from_channels", f"""
WITH {_engineering_sql(True, True)},
b AS (SELECT *, row_number() OVER (PARTITION BY canonical_name ORDER BY net_sales DESC, channel_code DESC) AS n,
             SUM(net_sales) OVER (PARTITION BY canonical_name) AS total FROM me)
SELECT canonical_name, quadrant AS overall_quadrant, channel_code AS from_channel, {d("total", "net_sales")} FROM b WHERE n = 1""")
def overall_from_channels(spark, sf):
    classified = engineering.menu_engineering(_categorised(spark, sf), by=["channel_code"])
    return engineering.overall_from_channels(classified)


@query("g11_contribution", f"""
WITH {ITEMS} SELECT canonical_name, channel_code, {d("net_sales - total_cost", "contribution")}, {q("net_sales", "quantity", "avg_price")} FROM im""")
def contribution(spark, sf):
    return engineering.contribution(item_metrics(spark, sf)).select("canonical_name", "channel_code", "contribution", "avg_price")


# --- the whole chain -------------------------------------------------------------
REPORT_CHAIN = COSTED.replace(
    "JOIN base USING (canonical_name) LEFT", "LEFT JOIN (SELECT * FROM base WHERE canonical_name <> 'hot ring') USING (canonical_name) LEFT") + """,
mr AS (SELECT canonical_name, channel_code, canonical_name LIKE '%gear' AS is_open_item, SUM(quantity) AS quantity, SUM(net_sales) AS net_sales,
              CASE WHEN canonical_name LIKE 'old %' AND canonical_name NOT LIKE '%rod' THEN NULL ELSE MAX(category) END AS category,
              CASE WHEN canonical_name LIKE '%plate' THEN 'Plates' END AS sub_category,
              SUM(total_cost) AS total_cost, SUM(unpriced_quantity) AS unpriced_quantity
       FROM ct WHERE canonical_name <> 'red widget' GROUP BY 1, 2),
mm AS (SELECT *, CAST(total_cost AS DOUBLE) / CAST(quantity AS DOUBLE) AS avg_cost, 1 - CAST(total_cost AS DOUBLE) / CAST(net_sales AS DOUBLE) AS margin_pct,
              net_sales - total_cost AS total_margin, CAST(quantity AS DOUBLE) / CAST(SUM(quantity) OVER () AS DOUBLE) AS menu_mix_pct FROM mr),
ok AS (SELECT * FROM mm WHERE channel_code IN ('IN_HOUSE', 'APP', 'TPD') AND category IS NOT NULL AND quantity > 0 AND avg_cost > 0 AND NOT is_open_item),
lim AS (SELECT CAST(SUM(total_margin) AS DOUBLE) / CAST(SUM(net_sales) AS DOUBLE) AS margin_threshold, 1 / CAST(COUNT(*) AS DOUBLE) * CAST(0.7 AS DOUBLE) AS mix_threshold FROM ok),
qd AS (SELECT canonical_name, channel_code, CASE WHEN margin_pct > margin_threshold THEN CASE WHEN menu_mix_pct > mix_threshold THEN 'Star' ELSE 'Puzzle' END
              WHEN menu_mix_pct > mix_threshold THEN 'Plow Horse' ELSE 'Dog' END AS quadrant FROM ok, lim)"""


def menu_report_items(spark, sf):
    """The chain over the test tables: gears are open items, old things have no
    category, hot rings no cost, red widgets are excluded, plates carry no mains."""
    name = F.col("canonical_name")
    lines = t.order_lines(spark, sf, "canonical_name", "channel_code", "business_date", "quantity", "line_total", "is_voided", "is_deferred",
                          "menu_name", "menu_group", "sales_category").withColumn("menu_group", F.when(~name.endswith("gear"), F.col("menu_group")))
    names = t.table(spark, sf, "part").select(F.col("p_name").alias("canonical_name")).distinct()
    category = F.when(name.endswith("rod"), "Sides").when(~name.startswith("old "), "Entrees")
    empty = {"groups": "menu_group string, category string, sub_category string", "subs": "sub_category string, category string"}
    rules = {k: rule_frame(spark, [], v) for k, v in empty.items()}
    rules["items"] = names.withColumn("category", category).withColumn("sub_category", F.when(name.endswith("plate"), "Plates"))
    costs = t.base_costs(spark, sf).filter("canonical_name <> 'hot ring'").select(F.col("canonical_name").alias("item_name"), F.lit(1).alias("period_key"), F.col("base_cost").alias("avg_cost"))
    days = calendar_days(t.calendar(spark)).select("business_date", (F.col("period_key") % 100).alias("period_key"))
    return menu_report(lines, _type_costs(spark, sf), costs, days, rules, rule_frame(spark, [("red widget", "")], "key string, value string"))


REPORT_COLUMNS = f"""canonical_name, channel_code, category, sub_category, {d("quantity", "quantity")}, {d("net_sales", "net_sales")}, {d("total_cost", "total_cost")},
       margin_pct, menu_mix_pct, quadrant"""


@query("g8_menu_report", f"""
WITH {REPORT_CHAIN}
SELECT {REPORT_COLUMNS}, is_open_item, {d("unpriced_quantity", "unpriced_quantity")}, total_cost IS NULL AS no_cost
FROM mm LEFT JOIN qd USING (canonical_name, channel_code)""")
def menu_report_query(spark, sf):
    return menu_report_items(spark, sf).select(
        "canonical_name", "channel_code", "category", "sub_category", "quantity", "net_sales", "total_cost", "margin_pct", "menu_mix_pct", "quadrant",
        "is_open_item", "unpriced_quantity", "no_cost")


@query("a14_all_items", f"WITH {REPORT_CHAIN} SELECT {REPORT_COLUMNS} FROM mm LEFT JOIN qd USING (canonical_name, channel_code)")
def all_items(spark, sf):
    """The all-items report, written as CSV and read again."""
    path = scratch_path(spark, "all-items")
    kinds = {"quantity": "decimal(28,4)", "net_sales": "decimal(28,4)", "total_cost": "decimal(38,4)", "margin_pct": "double", "menu_mix_pct": "double"}
    names = ["canonical_name", "channel_code", "category", "sub_category", "quantity", "net_sales", "total_cost", "margin_pct", "menu_mix_pct", "quadrant"]
    files.export_items_csv(menu_report_items(spark, sf).select(*names), path)
    return spark.read.schema(", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)).option("header", True).csv(path)
