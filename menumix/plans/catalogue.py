"""Registry of the queries over the test tables and their ANSI SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; decimals leave as doubles, as in the SQL."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: as_doubles(build(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return build

    return register


def as_doubles(df: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.col(f"`{n}`").cast("double").alias(n) if isinstance(t, DecimalType) else F.col(f"`{n}`")
        for n, t in kinds.items()
    ])


def d(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def q(expression: str, by: str, name: str) -> str:
    """A quotient of two exact values as double."""
    return f"CAST({expression} AS DOUBLE) / NULLIF(CAST({by} AS DOUBLE), 0) AS {name}"


# Order and line views of the SQL side, matching ``driver_tables``.
ORDERS = """
o AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_guid, CAST(o_orderdate AS DATE) AS business_date,
         o_orderpriority AS dining_option, o_orderstatus AS menu_name,
         CAST(o_totalprice AS DECIMAL(18,4)) AS order_total,
         c_mktsegment AS alt_payment_name, r_name AS location_code
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CHANNEL = """
CASE WHEN alt_payment_name ILIKE '%furniture%' THEN 'CATERING'
     WHEN alt_payment_name ILIKE '%machinery%' THEN 'OFFSITE'
     WHEN alt_payment_name ILIKE '%automobile%' THEN 'TPD'
     WHEN dining_option ILIKE '%urgent%' OR sales_category ILIKE '%#25%' THEN 'CATERING'
     WHEN dining_option ILIKE '%low%' OR dining_option ILIKE '%not specified%' THEN 'APP'
     ELSE 'IN_HOUSE' END"""

LINES = ORDERS + """,
raw_lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS selection_guid,
         o.*, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_discount, l_tax,
         concat(l_orderkey, '-', l_linenumber % 2) AS check_guid,
         p_name AS canonical_name, p_type AS menu_group, p_brand AS sales_category, p_size,
         p_name || CASE WHEN p_size > 25 THEN ' - Catering' ELSE '' END AS raw_name,
         CASE WHEN p_size > 5 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS item_guid,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS line_total,
         l_returnflag = 'R' AS is_voided, (l_linestatus = 'O' AND l_returnflag = 'N') AS is_deferred
  FROM lineitem JOIN o ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
l AS (SELECT *, """ + CHANNEL + """ AS channel_code FROM raw_lines)"""

REPORT = "NOT is_voided AND NOT is_deferred"

MODIFIER_VALUES = """
names(pick, canonical_name, mod_type) AS (VALUES {rows}),
m AS (
  SELECT parent_selection, order_guid, is_voided, modifier_guid, depth, quantity, canonical_name, mod_type,
         canonical_name = 'Napkins' AS is_blocklisted
  FROM (
    SELECT s AS parent_selection, g AS order_guid, v AS is_voided, s || '-m1' AS modifier_guid, l_suppkey % 20 AS pick,
           1 AS depth, CAST(GREATEST(l_linenumber % 3, 1) AS DECIMAL(18,4)) AS quantity FROM x
    UNION ALL SELECT s, g, v, s || '-m2', l_partkey % 20, 2, 1 FROM x WHERE l_linenumber >= 3
    UNION ALL SELECT s, g, v, s || '-m3', l_orderkey % 20, 3, 2 FROM x WHERE l_linenumber >= 5
    UNION ALL SELECT s, g, v, s || '-m4', (l_partkey + l_suppkey) % 20, 1, 1 FROM x WHERE l_returnflag = 'A') u
  JOIN names USING (pick))"""

X = """
x AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS s, CAST(l_orderkey AS VARCHAR) AS g,
             l_returnflag = 'R' AS v, * FROM lineitem)"""

CALENDAR = """
cal AS (
  SELECT 'P' || p || ' ' || y AS period_label, y * 100 + p AS period_key, p AS period_no,
         CAST(make_date(y, 1, 1) + (p - 1) * 28 AS DATE) AS period_start,
         CAST(make_date(y, 1, 1) + (p - 1) * 28 + 27 AS DATE) AS period_end
  FROM (SELECT CAST(unnest(range(1995, 2003)) AS INTEGER) AS y), (SELECT CAST(unnest(range(1, 14)) AS INTEGER) AS p))"""


def modifier_cte() -> str:
    from menumix.plans.driver_tables import MODIFIER_NAMES

    rows = ", ".join(
        f"({i}, '{name}', " + ("NULL" if kind is None else f"'{kind}'") + ")"
        for i, (name, kind) in enumerate(MODIFIER_NAMES)
    )
    return X + "," + MODIFIER_VALUES.format(rows=rows)
