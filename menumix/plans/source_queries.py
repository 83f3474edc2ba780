"""Sources, sinks and nested documents over the test tables (A and B)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from menumix.functions.calendar import assign_period
from menumix.operators import filters, joins, nested, reports, shares
from menumix.operators.upsert import upsert
from menumix.plans import driver_tables as t
from menumix.plans.catalogue import CALENDAR, LINES, ORDERS, REPORT, d, query
from menumix.session import materialise, scratch_path
from menumix.sources import documents, files

# Documents of the SQL side: the same derivations, without the nesting.
DOCS = """
docs AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS g,
         r_name AS location_code, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS business_date, *
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
live AS (SELECT *, l_returnflag = 'R' OR l_discount >= 0.1 AS check_void,
                l_linestatus = 'O' AND l_tax >= 0.07 AS own_void FROM docs WHERE l_tax > 0 OR l_discount > 0)"""


def _orders(spark, sf):
    return t.landed_orders(spark, sf)


# --- A1 to A3, A12 ---------------------------------------------------------------
@query("a1_read_orders", f"""
WITH {DOCS} SELECT location_code, CASE WHEN l_tax > 0 OR l_discount > 0 THEN g END AS order_guid, business_date FROM docs""")
def read_orders(spark, sf):
    path = scratch_path(spark, "orders")
    # Documents repeat the same keys and names: compressed they take a tenth of the disk.
    for texts in t.document_parts(spark, sf):
        texts.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "SIX").partitionBy("location_code").text(path)
    return documents.read_orders(spark, path).select("location_code", "order_guid", "business_date")


@query("a2_latest_config", """
SELECT p_type AS location_code, p_brand AS config_type, MAX(p_partkey) AS pull_run_id, arg_max(p_name, p_partkey) AS payload
FROM part GROUP BY 1, 2""")
def latest_config(spark, sf):
    return documents.latest_config(t.table(spark, sf, "part").select(
        F.col("p_type").alias("location_code"), F.col("p_brand").alias("config_type"),
        F.col("p_partkey").alias("pull_run_id"), F.col("p_name").alias("payload")))


@query("a3_require_nonempty", """
SELECT n_name AS location_code FROM nation
WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)""")
def require_nonempty(spark, sf):
    nations = t.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("location_code"))
    rich = t.table(spark, sf, "customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    lookup = nations.join(rich, "n_nationkey").select("location_code")
    return documents.require_nonempty(nations.select("location_code"), lookup, "customers", mode="skip")


@query("a12_read_window", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS business_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') AND (o_orderstatus = 'P' OR o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1998-12-31')""")
def read_window(spark, sf):
    head = t.orders(spark, sf, {"business_date", "menu_name", "location_code"})
    number = F.when(F.col("menu_name") != "P", F.date_format("business_date", "yyyyMMdd").cast("int"))
    raw = head.withColumn("business_date", number)
    return documents.read_window(raw, date(1997, 1, 1), date(1998, 12, 31), ["ASIA", "EUROPE"]).select("o_orderkey", "business_date")


# --- A4 to A7 --------------------------------------------------------------------
@query("a4_read_rules", """
SELECT lower(p_name || ' ' || p_partkey) AS key, p_brand AS value FROM part WHERE p_size > 10""")
def read_rules(spark, sf):
    """Rule file with padded, upper-cased keys and blank values, read back."""
    path = scratch_path(spark, "rules")
    rows = t.table(spark, sf, "part").select(
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("raw_name"),
        F.when(F.col("p_size") > 10, F.concat("p_brand", F.lit(" "))).otherwise("  ").alias("canonical_name"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_rules(spark, path, "raw_name", "canonical_name")


def _retention_rows(spark, sf):
    """Retention figures per period and item from the lines, as extract columns."""
    lines = t.order_lines(spark, sf, "business_date", "canonical_name", "order_guid", "line_total", "quantity", "menu_name", "is_voided")
    days = t.calendar(spark)
    dated = assign_period(lines, days).filter(F.col("period_key").isNotNull())
    n = F.count("*")
    sums = dated.groupBy("period_key", "canonical_name").agg(
        F.sum("line_total").cast("decimal(12,2)").alias("revenue"), F.sum("quantity").cast("decimal(10,0)").alias("volume"),
        F.countDistinct("order_guid").alias("guests"),
        F.floor(F.count_if(F.col("is_voided")) * 10000 / n).alias("ret"),
        F.floor(F.count_if(F.col("menu_name") == "F") * 10000 / n).alias("reo"))
    return sums, days


RETENTION = f"""{LINES}, {CALENDAR},
r AS (SELECT CAST(period_key // 100 AS INTEGER) AS fiscal_year, CAST(period_key % 100 AS INTEGER) AS period, period_start, canonical_name AS item_name,
             SUM(line_total) AS revenue, SUM(quantity) AS volume, COUNT(DISTINCT order_guid) AS guests,
             COUNT(*) FILTER (WHERE is_voided) * 10000 // COUNT(*) AS ret, COUNT(*) FILTER (WHERE menu_name = 'F') * 10000 // COUNT(*) AS reo
      FROM l JOIN cal ON business_date BETWEEN period_start AND period_end GROUP BY 1, 2, 3, 4)"""


def _write_retention(spark, sf, suffix):
    """Retention extracts as CSV, one folder per period file."""
    sums, days = _retention_rows(spark, sf)
    spans = days.select("period_key", "period_start")
    year, period = F.expr("period_key div 100"), F.col("period_key") % 100

    def ratio_text(name):
        return (F.col(name).cast("decimal(10,4)") / 10000).cast("decimal(8,4)")

    # Items whose name starts with 'hot' carry a stale previous range.
    stale = F.col("canonical_name").startswith("hot ")
    end = F.when(stale, F.date_sub("period_start", 30)).otherwise(F.date_sub("period_start", 1))
    rows = sums.join(spans, "period_key").select(
        F.concat(F.lit("P"), F.lpad(period.cast("string"), 2, "0"), year.cast("string"), F.lit(suffix), F.lit(".csv")).alias("file"),
        F.lit("ignored").alias("Item revenue absolute difference"),
        F.when(F.col("guests") > 0, F.col("canonical_name")).alias("Item"),
        F.md5("canonical_name").alias("Item id"),
        F.col("revenue").alias("Item revenue"),
        F.lit("").alias("Item aov"),
        F.col("volume").alias("Item volume"),
        F.col("guests").alias("Item guests"),
        ratio_text("ret").alias("N day item return rate"),
        ratio_text("reo").alias("N day item reorder rate"),
        F.date_sub(end, 27).alias("Business date previous start"),
        end.alias("Business date previous end"),
        F.lit("#ERROR!").alias("Item revenue previous"),
        ratio_text("reo").alias("N day item return rate previous"),
        ratio_text("ret").alias("N day item reorder rate previous"),
    )
    path = scratch_path(spark, "retention")
    rows.write.option("header", True).partitionBy("file").csv(path)
    return path


def _retention(spark, sf, suffix="IS"):
    pattern = files.INSTORE_FILE if suffix == "IS" else files.DELIVERY_FILE
    return files.read_retention(spark, f"{_write_retention(spark, sf, suffix)}/*/*.csv", pattern)


RATES = "CAST(ret AS DOUBLE) / 10000 AS return_rate, CAST(reo AS DOUBLE) / 10000 AS reorder_rate"


@query("a5_read_retention", f"""
WITH {RETENTION}
SELECT fiscal_year, period, item_name, md5(item_name) AS item_id, {d("revenue", "revenue")}, {d("volume", "volume")},
       {d("guests", "guests")}, {RATES},
       CAST(period_start - CASE WHEN item_name LIKE 'hot %' THEN 30 ELSE 1 END AS DATE) AS prev_period_end, CAST(NULL AS DOUBLE) AS revenue_prev,
       CAST(NULL AS DOUBLE) AS aov, CAST(NULL AS DOUBLE) AS volume_pct, CAST(reo AS DOUBLE) / 10000 AS return_rate_prev
FROM r""")
def read_retention(spark, sf):
    return _retention(spark, sf).select(
        "fiscal_year", "period", "item_name", "item_id", "revenue", "volume", "guests", "return_rate", "reorder_rate",
        "prev_period_end", "revenue_prev", "aov", "volume_pct", "return_rate_prev")


@query("a6_period_from_filename", """
SELECT p_partkey, CAST(p_size % 13 + 1 AS INTEGER) AS period, CAST(1995 + p_partkey % 7 AS INTEGER) AS fiscal_year
FROM part WHERE p_size <= 40""")
def period_from_filename(spark, sf):
    names = t.part_rows(spark, sf, {0: F.col("p_partkey"), 1: F.col("p_size")}, "is_final").withColumn(
        "name", F.when(F.col("_c1").cast("int") > 40, F.concat(F.lit("x"), "_file")).otherwise(F.col("_file")))
    broken = F.when(F.col("_c1").cast("int") > 40, F.replace("name", F.lit("/P"), F.lit("/Q"))).otherwise(F.col("name"))
    period, year = files.period_from_filename(broken, files.INSTORE_FILE)
    out = names.select(F.col("_at").alias("p_partkey"), period.alias("period"), year.alias("fiscal_year"))
    return out.filter(F.col("period").isNotNull())


@query("a7_coerce_columns", """
SELECT o_orderkey, o_orderpriority AS item_name, CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS revenue,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS prev_period_end
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def coerce_columns(spark, sf):
    status = F.col("o_orderstatus")
    texts = t.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("item_name"),
        F.when(status == "F", F.col("o_totalprice").cast("decimal(12,2)").cast("string")).when(status == "O", "#ERROR!").otherwise("").alias("revenue"),
        F.when(status == "P", "not a date").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("prev_period_end"))
    kinds = {"item_name": "string", "revenue": "decimal(12,2)", "prev_period_end": "date"}
    return files.coerce_columns(texts, kinds, "item_name")


# --- A8 to A11 -------------------------------------------------------------------
def _lookup_sheet(spark, sf):
    size, name = F.col("p_size"), F.col("p_name")
    return t.part_sheet(spark, sf, {
        0: F.concat(F.lit(" "), name, F.when(size > 25, " - Catering").otherwise("")), 1: F.concat(name, F.lit(" ")),
        3: F.when(size > 5, name), 4: F.when(size > 5, F.col("p_type")),
        5: name, 6: F.when(size > 2, F.col("p_type")), 7: F.col("p_brand"),
        9: F.col("p_brand"), 10: F.when(size != 7, F.col("p_type")),
    }, by_period=False)


@query("a8_load_modifier_types", """
SELECT p_name AS modifier_name, p_type AS item_type, arg_max(p_brand, p_partkey) AS modifier_type FROM part WHERE p_size > 2 GROUP BY 1, 2""")
def load_modifier_types(spark, sf):
    return files.load_modifier_types(_lookup_sheet(spark, sf))


@query("a8_load_parent_types", "SELECT DISTINCT p_brand AS parent_item, p_type AS item_type FROM part WHERE p_size <> 7")
def load_parent_types(spark, sf):
    sheet = _lookup_sheet(spark, sf)
    known = files.load_parent_types(sheet.filter(F.col("_c9") == "Brand#1"))
    return files.load_parent_types(sheet, known)


@query("a9_build_item_lookup", """
WITH raw AS (SELECT DISTINCT p_name || CASE WHEN p_size > 25 THEN ' - Catering' ELSE '' END AS raw_item_name, p_name AS cleaned_item_name
             FROM part WHERE p_name NOT LIKE 'old %'),
c1 AS (SELECT p_name AS cleaned_item_name, arg_max(p_type, p_partkey) AS category_1 FROM part WHERE p_size > 5 GROUP BY 1),
c2 AS (SELECT p_type AS category_1, arg_max(p_brand, p_partkey) AS category_2 FROM part WHERE p_type <> 'PROMO' GROUP BY 1),
a AS (SELECT * FROM raw UNION ALL SELECT cleaned_item_name, cleaned_item_name FROM c1 WHERE cleaned_item_name NOT IN (SELECT cleaned_item_name FROM raw))
SELECT raw_item_name, cleaned_item_name, category_1, category_2 FROM a LEFT JOIN c1 USING (cleaned_item_name) LEFT JOIN c2 USING (category_1)""")
def build_item_lookup(spark, sf):
    """The first two blocks come from the written sheet; categories of the types are put beside them."""
    sheet = _lookup_sheet(spark, sf)
    old = F.col("_c1").startswith("old ")
    sheet = sheet.withColumn("_c0", F.when(~old, F.col("_c0"))).withColumns({"_c6": F.col("_c4"), "_c7": F.col("_c9")})
    types = t.table(spark, sf, "part").filter("p_type <> 'PROMO'").select(F.col("p_type").alias("_c6"), F.col("p_brand").alias("_c7"), F.col("p_partkey").alias("_at"))
    return files.build_item_lookup(files._pairs(sheet, 0, 1), files._pairs(sheet, 3, 4), files._pairs(types, 6, 7))


def _cost_label(period: str = "p_size % 13 + 1", year: str = "1995 + p_partkey % 7") -> str:
    return f"'P' || lpad(CAST({period} AS VARCHAR), 2, '0') || '-' || ({year})"


@query("a10_load_modifier_cost", f"""
WITH s AS (SELECT *, {_cost_label()} AS period, row_number() OVER (PARTITION BY {_cost_label()}, p_name ORDER BY p_partkey) AS n FROM part)
SELECT period, p_name AS recipe_name, p_type AS clean_name, CASE WHEN p_size <> 13 THEN 'OZ' END AS portion_unit, CAST(NULL AS VARCHAR) AS cogs_account,
       CASE WHEN p_size > 25 THEN CAST(CAST(p_retailprice AS DECIMAL(12,4)) AS DOUBLE) END AS total_cost,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) AS DOUBLE) AS cost_per_portion
FROM s WHERE n = 1""")
def load_modifier_cost(spark, sf):
    size, price = F.col("p_size"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    sheet = t.part_sheet(spark, sf, {
        0: F.concat("p_name", F.lit("  ")), 1: F.col("p_type"), 14: F.when(size != 13, "OZ").otherwise(" "),
        25: F.when(size > 25, price).otherwise("#ERROR!"), 26: price}, "ModifierCost")
    return files.load_modifier_cost(sheet)


@query("a11_load_item_cost", f"""
WITH s AS (SELECT *, {_cost_label()} AS period, row_number() OVER (PARTITION BY {_cost_label()}, p_type, p_name ORDER BY p_partkey DESC) AS n FROM part WHERE p_size <> 3)
SELECT period, p_type AS menu, p_name AS item_name, p_name AS item_name_updated, p_brand AS menu_group, CAST(NULL AS VARCHAR) AS category_1,
       p_type AS category_2, CASE WHEN p_size <= 45 THEN CAST(CAST(p_retailprice AS DECIMAL(10,4)) AS DOUBLE) END AS avg_cost
FROM s WHERE n = 1""")
def load_item_cost(spark, sf):
    size, price = F.col("p_size"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    sheet = t.part_sheet(spark, sf, {
        0: F.when(size != 3, F.col("p_type")), 1: F.col("p_brand"), 2: F.col("p_name"), 3: F.col("p_name"), 5: F.col("p_type"),
        6: F.when(size <= 45, F.concat(F.lit(" $"), price)).otherwise("n/a")}, "ItemCost")
    return files.load_item_cost(sheet)


# --- A13 to A15 ------------------------------------------------------------------
@query("a13_write_table", f"""
WITH {LINES} SELECT selection_guid, location_code, {d("line_total", "line_total")} FROM l""")
def write_table(spark, sf):
    path = scratch_path(spark, "lines")
    lines = t.order_lines(spark, sf, "selection_guid", "line_total", "location_code")
    files.write_table(lines, path, "location_code")
    return spark.read.parquet(path)


@query("a13_merge_into", f"""
WITH {LINES} SELECT selection_guid, {d("CASE WHEN menu_name = 'P' THEN line_total + 1 ELSE line_total END", "line_total")}, is_voided, location_code FROM l""")
def merge_into(spark, sf):
    """Orders of status P are edited after the table was written."""
    path = scratch_path(spark, "merged-lines")
    lines = t.order_lines(spark, sf, "selection_guid", "line_total", "is_voided", "location_code", "menu_name")
    files.write_table(lines.drop("menu_name"), path, "location_code")
    edited = lines.filter("menu_name = 'P'").drop("menu_name").withColumn("line_total", (F.col("line_total") + 1).cast("decimal(18,4)"))
    files.merge_into(
        spark, path, edited, ["selection_guid"], lambda old, new: upsert(old, new, ["selection_guid"], update=["line_total"]), "location_code")
    return spark.read.parquet(path)


@query("a13_merge_moves_partition", f"""
WITH {LINES} SELECT selection_guid, {d("line_total", "line_total")}, is_voided, CASE location_code WHEN 'AFRICA' THEN 'ASIA' ELSE location_code END AS location_code FROM l""")
def merge_moves_partition(spark, sf):
    """All lines of one location move to another: its partition must go."""
    path = scratch_path(spark, "moved-lines")
    lines = t.order_lines(spark, sf, "selection_guid", "line_total", "is_voided", "location_code")
    files.write_table(lines, path, "location_code")
    moved = lines.filter("location_code = 'AFRICA'").withColumn("location_code", F.lit("ASIA"))
    files.merge_into(
        spark, path, moved, ["selection_guid"], lambda old, new: upsert(old, new, ["selection_guid"], update=["location_code"]), "location_code")
    return spark.read.parquet(path)


@query("a14_export_items_csv", f"""
WITH {LINES} SELECT canonical_name, channel_code, CAST(SUM(quantity) AS DOUBLE) AS quantity, CAST(SUM(line_total) AS DOUBLE) AS net_sales
FROM l WHERE {REPORT} GROUP BY 1, 2""")
def export_items_csv(spark, sf):
    path = scratch_path(spark, "items")
    lines = filters.filter_revenue(t.order_lines(spark, sf, "canonical_name", "channel_code", "quantity", "line_total", "is_voided", "is_deferred"))
    files.export_items_csv(reports.item_sales(lines).drop("n_lines"), path)
    schema = "canonical_name string, channel_code string, quantity decimal(28,4), net_sales decimal(28,4)"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("a15_seed_dimension", """
SELECT 'L' || COALESCE(n_nationkey, s_nationkey) AS location_code, COALESCE('n' || n_nationkey, 's' || s_nationkey) AS source_guid,
       COALESCE(n_name, 'known') AS display_name
FROM (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal < 5000) FULL JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = s_nationkey""")
def seed_dimension(spark, sf):
    def code(col):
        return F.concat(F.lit("L"), F.col(col).cast("string")).alias("location_code")

    known = t.table(spark, sf, "supplier").filter("s_acctbal < 5000").select("s_nationkey").distinct().select(
        code("s_nationkey"), F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("source_guid"), F.lit("known").alias("display_name"))
    configured = t.table(spark, sf, "nation").filter("n_regionkey <> 2").select(
        code("n_nationkey"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("source_guid"), F.col("n_name").alias("display_name"))
    return files.seed_dimension(known, configured, "location_code", ["source_guid", "display_name"])


# --- D10, F19, F20, H7 (they read the extracts) ------------------------------------
SOLD = f"""{RETENTION},
s AS (SELECT canonical_name, CAST(period_key // 100 AS INTEGER) AS fiscal_year, CAST(period_key % 100 AS INTEGER) AS period,
             SUM(line_total) AS net_sales, SUM(quantity) AS quantity
      FROM l LEFT JOIN cal ON business_date BETWEEN period_start AND period_end WHERE {REPORT} GROUP BY 1, 2, 3),
f AS (SELECT s.*, guests, ret, reo FROM s LEFT JOIN r ON item_name = canonical_name AND r.fiscal_year = s.fiscal_year AND r.period = s.period)"""


@query("d10_attach_retention", f"""
WITH {SOLD}
SELECT canonical_name, fiscal_year, period, {d("net_sales", "net_sales")}, {d("quantity", "quantity")}, {d("guests", "guests")}, {RATES} FROM f""")
def attach_retention(spark, sf):
    return _with_retention(spark, sf).select(
        "canonical_name", "fiscal_year", "period", "net_sales", "quantity", "guests", "return_rate", "reorder_rate")


def _with_retention(spark, sf):
    """Items of every fiscal period with the retention of that period."""
    lines = filters.filter_revenue(t.order_lines(spark, sf, "canonical_name", "business_date", "quantity", "line_total", "is_voided", "is_deferred"))
    dated = assign_period(lines, t.calendar(spark)).withColumns({
        "fiscal_year": F.expr("cast(period_key div 100 as int)"), "period": (F.col("period_key") % 100).cast("int")})
    items = reports.item_sales(dated, ["canonical_name", "fiscal_year", "period"])
    return joins.attach_retention(items, _retention(spark, sf))


@query("f19_retention_report", f"""
WITH {SOLD}
SELECT canonical_name, fiscal_year, period, {RATES}, CAST(ret - reo AS DOUBLE) / 10000 AS return_delta, CAST(reo - ret AS DOUBLE) / 10000 AS reorder_delta,
       CASE WHEN ret >= 2800 THEN 'green' WHEN ret >= 1500 THEN 'amber' WHEN ret IS NOT NULL THEN 'red' END AS band
FROM f""")
def retention_report(spark, sf):
    return reports.retention_report(_with_retention(spark, sf)).select(
        "canonical_name", "fiscal_year", "period", "return_rate", "reorder_rate", "return_delta", "reorder_delta", "band")


@query("f19_retention_kpis", f"""
WITH {SOLD}
SELECT CAST(CAST(SUM(ret) AS DOUBLE) / 10000 AS DOUBLE) / CAST(COUNT(ret) AS DOUBLE) AS avg_return_rate,
       CAST(CAST(SUM(reo) AS DOUBLE) / 10000 AS DOUBLE) / CAST(COUNT(reo) AS DOUBLE) AS avg_reorder_rate,
       (SELECT canonical_name FROM f WHERE ret IS NOT NULL ORDER BY ret DESC, canonical_name DESC LIMIT 1) AS best_item,
       (SELECT canonical_name FROM f WHERE ret IS NOT NULL ORDER BY ret, canonical_name LIMIT 1) AS worst_item FROM f""")
def retention_kpis(spark, sf):
    return reports.retention_kpis(reports.retention_report(_with_retention(spark, sf)))


@query("f20_period_guard", f"""
WITH {RETENTION} SELECT fiscal_year, period, item_name, item_name LIKE 'hot %' AS is_stale FROM r""")
def period_guard(spark, sf):
    flagged = reports.period_guard(_retention(spark, sf), t.calendar(spark))
    return flagged.select("fiscal_year", "period", "item_name", "is_stale")


@query("h7_union_retention", f"""
WITH {RETENTION}, b AS (SELECT fiscal_year, period, item_name, {d("guests", "guests")} FROM r)
SELECT *, 'IN_STORE' AS source_channel FROM b UNION ALL SELECT *, 'DELIVERY' FROM b""")
def union_retention(spark, sf):
    both = shares.union_retention(_retention(spark, sf, "IS"), _retention(spark, sf, "Del"))
    return both.select("fiscal_year", "period", "item_name", "guests", "source_channel")


# --- B1 to B6 --------------------------------------------------------------------
@query("b1_explode_checks", f"""
WITH {DOCS}
SELECT g || '-c1' AS check_guid, g AS order_guid, location_code, business_date, check_void AS is_voided,
       {d("CAST(l_tax AS DECIMAL(18,4))", "tax_amount")}, {d("CAST(l_extendedprice AS DECIMAL(18,4))", "total_amount")} FROM live
UNION ALL SELECT g || '-c2', g, location_code, business_date, FALSE, NULL, NULL FROM live""")
def explode_checks(spark, sf):
    return nested.explode_checks(_orders(spark, sf))


def _lookups(spark, sf):
    return {**nested.build_lookups(t.config_documents(spark, sf)), **files.default_rules(spark)}


PAYMENT_COLUMNS = f"""g || '-p' AS payment_guid, g || '-c1' AS check_guid, g AS order_guid, location_code, business_date,
       CASE WHEN o_orderstatus = 'P' THEN 'OTHER' ELSE 'CREDIT' END AS payment_type,
       CASE WHEN o_orderstatus = 'P' THEN c_mktsegment END AS alt_payment_name,
       CASE WHEN l_linenumber < 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) END AS amount,
       {d("CAST(l_tax AS DECIMAL(18,4))", "tip_amount")}"""


@query("b2_explode_payments", f"WITH {DOCS} SELECT {PAYMENT_COLUMNS} FROM live")
def explode_payments(spark, sf):
    alt = materialise(nested.config_lookup(t.config_documents(spark, sf), "alt_payment_types"), "alt-pay")
    return nested.explode_payments(_orders(spark, sf), alt)


GROUPS = "grp AS (SELECT p_brand AS gb, MIN(p_type) AS gt FROM part GROUP BY 1)"
LINE_SQL = f"""
SELECT g AS selection_guid, g AS order_guid, g || '-c1' AS check_guid, location_code, business_date,
       CASE WHEN p_size > 5 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS item_guid, CAST(l_suppkey AS VARCHAR) AS item_multi_loc_id,
       CASE WHEN p_size > 40 THEN p_name WHEN p_size > 25 THEN p_name || ' - Catering' ELSE p_name END AS raw_name, p_name AS clean_name,
       CAST(NULL AS VARCHAR) AS menu_guid, CASE WHEN l_linenumber % 2 = 0 THEN gt END AS menu_name,
       CASE WHEN l_linenumber % 2 = 0 THEN gb END AS menu_group_name, p_brand AS sales_category, o_orderpriority AS dining_option,
       CASE WHEN l_quantity <> 7 THEN CAST(l_quantity AS DOUBLE) ELSE 0 END AS quantity,
       {d("CAST(l_extendedprice AS DECIMAL(18,4))", "line_total")},
       CASE WHEN l_discount > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) END AS pre_discount,
       own_void OR check_void AS is_voided, l_shipdate > TIMESTAMP '2000-01-01' AS is_deferred
FROM live JOIN grp ON gb = p_brand"""


@query("b3_explode_selections", f"WITH {DOCS}, {GROUPS} {LINE_SQL}")
def explode_selections(spark, sf):
    return nested.explode_selections(_orders(spark, sf), _lookups(spark, sf))


def _modifier_sql() -> str:
    names = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(t.MODIFIER_NAMES))
    def level(tag, pick, depth, qty, where):
        return (f"SELECT g, location_code, business_date, '{tag}' AS tag, {pick} % {len(t.MODIFIER_NAMES)} AS pick, {depth} AS depth, "
                f"{qty} AS qty, l_linenumber, l_tax, l_discount >= 0.09 OR own_void OR check_void AS void FROM live WHERE {where}")
    union = " UNION ALL ".join([
        level("-m1", "l_suppkey", 1, "CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_linenumber % 3 END", "TRUE"),
        level("-m2", "l_partkey", 2, "1", "l_linenumber >= 3"),
        level("-m3", "l_orderkey", 3, "2", "l_linenumber >= 5"),
        level("-m4", "(l_partkey + l_suppkey)", 1, "1", "l_returnflag = 'A'")])
    return f"""
WITH {DOCS}, names(pick, raw_name) AS (VALUES {names}), u AS ({union})
SELECT g || tag AS modifier_guid, g AS parent_selection, g AS order_guid, location_code, business_date, raw_name, raw_name AS clean_name,
       CAST(depth AS INTEGER) AS depth, CAST(qty AS DOUBLE) AS quantity,
       CASE WHEN l_linenumber > 3 THEN CAST(CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE) ELSE 0 END AS price,
       raw_name = 'Napkins' AS is_blocklisted, void AS is_voided
FROM u JOIN names USING (pick)"""


@query("b4_walk_modifiers", _modifier_sql())
def walk_modifiers(spark, sf):
    rules = files.default_rules(spark)
    return nested.walk_modifiers(_orders(spark, sf), {"names": rules["names"], "blocklist": rules["blocklist"]})


@query("b5_extract_adjustments", f"""
WITH {DOCS}
SELECT g AS order_guid, g || '-c1' AS check_guid, g AS selection_guid, location_code, business_date, 'VOID' AS kind, p_name AS name,
       {d("CAST(l_extendedprice AS DECIMAL(18,4))", "amount")} FROM live WHERE own_void
UNION ALL SELECT g, g || '-c1', NULL, location_code, business_date, 'REFUND', CASE WHEN o_orderstatus = 'P' THEN 'OTHER' ELSE 'CREDIT' END,
       CAST(CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE) FROM live WHERE l_returnflag = 'A'""")
def extract_adjustments(spark, sf):
    return nested.extract_adjustments(_orders(spark, sf), files.default_rules(spark)["names"])


@query("b6_parse_orders", f"""
WITH {DOCS}, n AS (SELECT COUNT(*) AS n FROM live)
SELECT 'order_lines' AS table_name, n AS n_rows FROM n UNION ALL SELECT 'checks', 2 * n FROM n UNION ALL SELECT 'payments', n FROM n
UNION ALL SELECT 'modifiers', SUM(1 + (l_linenumber >= 3)::BIGINT + (l_linenumber >= 5)::BIGINT + (l_returnflag = 'A')::BIGINT)::BIGINT FROM live
UNION ALL SELECT 'adjustments', SUM(own_void::BIGINT + (l_returnflag = 'A')::BIGINT)::BIGINT FROM live""")
def parse_orders(spark, sf):
    parsed = nested.parse_orders(_orders(spark, sf), _lookups(spark, sf))
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in parsed.items()]
    out = counts[0]
    for frame in counts[1:]:
        out = out.unionByName(frame)
    return out


# --- B7 to B9 --------------------------------------------------------------------
@query("b7_flatten_menus", """
SELECT 'item' AS kind, p_type AS location_code, 'i-' || p_partkey AS guid, p_type AS menu_name, CASE WHEN p_size > 25 THEN 'Late' ELSE p_brand END AS menu_group_name FROM part
UNION ALL SELECT 'item', p_type, x || p_partkey, p_type, p_brand FROM part, (VALUES ('j-'), ('z-')) v(x)
UNION ALL SELECT 'group', p_type, x || p_partkey, p_type, p_brand FROM part, (VALUES ('g-'), ('h-'), ('k-')) v(x)
UNION ALL SELECT 'group', p_type, 'l-' || p_partkey, p_type, 'Late' FROM part WHERE p_size > 25""")
def flatten_menus(spark, sf):
    flat = nested.flatten_menus(t.menu_documents(spark, sf))
    return flat["menu_item"].select(F.lit("item").alias("kind"), "*").unionByName(flat["menu_group"].select(F.lit("group").alias("kind"), "*"))


@query("b8_config_lookup", f"""
WITH {ORDERS} SELECT DISTINCT location_code, 'd-' || dining_option AS guid, dining_option AS name FROM o
UNION ALL SELECT DISTINCT location_code, 'a-' || alt_payment_name, alt_payment_name FROM o
UNION ALL SELECT r_name, 's-' || p_brand, p_brand FROM region, (SELECT DISTINCT p_brand FROM part)""")
def config_lookup(spark, sf):
    config = t.config_documents(spark, sf)
    kinds = ["dining_options", "alt_payment_types", "sales_categories"]
    first, second, third = (nested.config_lookup(config, kind) for kind in kinds)
    return first.unionByName(second).unionByName(third)


@query("b9_resolve_menu", """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS selection_guid, p_type AS menu_name,
       CASE WHEN l_linenumber > 3 THEN p_brand WHEN p_size > 25 THEN 'Late' ELSE p_brand END AS menu_group_name
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def resolve_menu(spark, sf):
    flat = nested.flatten_menus(t.menu_documents(spark, sf))
    lookups = {k: materialise(v, f"menu-{k}") for k, v in flat.items()}
    part = t.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("location_code"))
    key = F.col("l_partkey").cast("string")
    lines = t.table(spark, sf, "lineitem").join(part, "l_partkey").select(
        t.selection_guid().alias("selection_guid"), "location_code", F.concat(F.lit("i-"), key).alias("item_guid"),
        F.when(F.col("l_linenumber") > 3, F.concat(F.lit("g-"), key)).alias("item_group_guid"))
    return nested.resolve_menu(lines, lookups["menu_group"], lookups["menu_item"]).select("selection_guid", "menu_name", "menu_group_name")
