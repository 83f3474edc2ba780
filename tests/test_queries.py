"""Registered queries against their SQL twins; all of them with --all-queries."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from menumix.plans import registry

DATA = os.environ.get("MENUMIX_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registry.QUERIES, registry.SQL
QUICK = ["f1_revenue_by_channel", "f5_item_metrics", "f10_location_matrix", "f16_renames_audit", "h1_share_within_location",
         "h3_order_rank", "h4_vs_prior", "h8_subtotals", "c2_clean_names", "c12_resolve_category", "d3_top_payment", "d9_cost_lookup",
         "e6_upsert_dim_item", "g7_avg_cost_with_modifiers", "g8_menu_engineering", "b4_walk_modifiers"]
# Line keys repeat at the smallest scale, where these differ by the repeats.
NEED_UNIQUE_LINES = {"d6_orphan_modifiers", "i2_stream_to_star", "i3_merge_run", "i3_merge_stored", "i4_reparse"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def names(config):
    if not config.getoption("--all-queries"):
        return QUICK
    return [n for n in SQL if n not in NEED_UNIQUE_LINES or not DATA.endswith("sf0.001")]


def pytest_generate_tests(metafunc):
    if "query_name" in metafunc.fixturenames:
        metafunc.parametrize("query_name", names(metafunc.config))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    return str(list(value)) if isinstance(value, (list, tuple)) else str(value)


def test_query_matches_sql(spark, duck, query_name):
    df = QUERIES[query_name](spark, DATA)
    cursor = duck.execute(SQL[query_name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(tuple(plain(v) for v in row) for row in cursor.fetchall())
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert got == want


@pytest.mark.parametrize("name", ["f5_item_metrics", "f9_category_mix", "f15_byo_breakdown", "d3_top_payment", "d9_cost_lookup", "e5_dedupe_first",
                                  "e6_upsert_dim_item", "g3_modifier_cost_by_type", "g8_menu_engineering", "c15_assign_period"])
def test_plans_hold_no_cross_join_and_no_row_window(spark, name):
    """Raw rows of a key never meet in one task: no product, no window, no range join."""
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert operator not in plan


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
