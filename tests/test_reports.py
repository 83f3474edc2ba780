"""Reports, shares, ranks and review lists."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from menumix.functions.calendar import default_calendar
from menumix.operators import reports, shares

LINES = ("selection_guid string, order_guid string, canonical_name string, raw_name string, location_code string, channel_code string, "
         "category string, business_date date, quantity decimal(18,4), line_total decimal(18,4), is_voided boolean, is_deferred boolean")


@pytest.fixture(scope="module")
def lines(spark):
    def line(i, order, name, loc, channel, day, qty, total, void=False, deferred=False, raw=None):
        return (f"s{i}", order, name, raw or name, loc, channel, "Sides" if name == "Naan" else "Entrees", date(2026, 3, day),
                Decimal(qty), Decimal(total), void, deferred)

    return spark.createDataFrame([
        line(1, "o1", "Bowl", "L1", "APP", 2, 2, 20), line(2, "o1", "Naan", "L1", "APP", 2, 1, 3),
        line(3, "o2", "Bowl", "L2", "TPD", 9, 1, 12, raw="Bowl - Side"), line(4, "o3", "Bowl", "L1", "CATERING", 9, 10, 100, void=True),
        line(5, "o4", "Naan", "L2", "CATERING", 10, 4, 12, deferred=True),
    ], LINES)


def test_revenue_and_reconciliation(lines, rows):
    got = rows(reports.revenue_by(lines, ["channel_code"]))
    assert got == [("APP", 2, 23, 3), ("CATERING", 1, 12, 4), ("TPD", 1, 12, 1)]
    got = rows(reports.location_reconciliation(lines, date(2026, 3, 1), date(2026, 3, 9)))
    assert got == [("L1", 3, 23, 100, 0), ("L2", 1, 12, None, 0)]


def test_drift(lines):
    staged = lines.filter("selection_guid in ('s1', 's4')")
    assert reports.drift(staged, lines).first().ok
    lost = lines.filter("selection_guid <> 's1'")
    row = reports.drift(staged, lost).first()
    assert not row.ok and (row.staged_lines, row.public_lines, row.public_revenue) == (2, 1, 0)


def test_location_matrix(lines):
    got = {r.canonical_name: r for r in reports.location_matrix(lines.filter("not is_voided"), ["L1", "L2", "L3"]).collect()}
    assert (got["Bowl"].L1, got["Bowl"].L2, got["Bowl"].L3) == (20, 12, None)
    assert got["Bowl"].avg == 16.0 and got["Bowl"].best_location == "L1" and got["Naan"].best_location == "L2"


def test_channel_split_totals(lines):
    row = reports.channel_split(lines.filter("canonical_name = 'Naan'")).first()
    assert (row.app, row.catering, row.tpd, row.total) == (3, 12, 0, 15)


def test_renames(lines):
    row = reports.renames_audit(lines).collect()
    assert len(row) == 1 and row[0].raw_names == ["Bowl", "Bowl - Side"]
    assert (row[0].lifetime_quantity, row[0].lifetime_sales, row[0].locations, row[0].first_seen) == (3, 32, 2, date(2026, 3, 2))


def test_byo(lines, frame, rows):
    mods = frame([("m1", "s1", "Rice", "Base", Decimal(2), False), ("m2", "s1", "Greens", "Base", Decimal(2), False),
                  ("m3", "s3", "Rice", "Base", Decimal(1), False), ("m4", "s4", "Rice", "Base", Decimal(9), False),
                  ("m5", "s1", "Rice", "Base", Decimal(9), True)],
                 "modifier_guid string, parent_selection string, canonical_name string, mod_type string, quantity decimal(18,4), is_voided boolean")
    got = rows(reports.byo_breakdown(mods, lines, items=["Bowl"]), "canonical_name", "quantity", "orders", "order_share", "type_share")
    assert got == [("Greens", 2, 1, 0.5, 0.4), ("Rice", 3, 2, 1.0, 0.6)]


def test_vs_prior_and_trend(lines, spark):
    got = {r.channel_code: r for r in shares.vs_prior(lines, date(2026, 3, 8), date(2026, 3, 14), ["channel_code"], share=True).collect()}
    assert (got["APP"].current_value, got["APP"].prior_value, got["APP"].change) == (None, 23, -23)
    assert got["TPD"].prior_value is None and got["TPD"].change_pct is None
    assert got["APP"].share_change_pp == -100.0
    trend = {r.bucket: r.net_sales for r in reports.trend(lines, "period", default_calendar(spark)).collect()}
    assert trend == {"P3 2026": 147}


def test_needs_review(lines, frame):
    paid = lines.withColumn("alt_payment_name", F.when(F.col("order_guid") == "o2", "EzCater").when(F.col("order_guid") == "o4", "Hungry"))
    review = reports.needs_review(paid.withColumn("dining_option", F.lit(None).cast("string"))).collect()
    assert [(r.order_guid, r.channel_code, r.suggested_channel, r.amount) for r in review] == [("o2", "TPD", "CATERING", 12)]


def test_open_items(frame):
    lines = frame([("Bowl", "Food", "BOWLS", "APP", None, date(2026, 3, 1)), ("Custom", "Food", None, "IN_HOUSE", "Uber", date(2026, 3, 2)),
                   ("Odd", "Food", "X", "APP", None, date(2026, 3, 3))],
                  "canonical_name string, sales_category string, menu_group string, channel_code string, alt_payment_name string, business_date date")
    lines = lines.withColumns({"quantity": F.lit(1), "line_total": F.lit(5)})
    lookup = frame([("Bowl", "Bowls"), ("Odd", "Odd")], "cleaned_item_name string, category_2 string")
    subs = frame([("Bowls",)], "sub_category string")
    out = reports.open_items(lines, lookup, subs, frame([("Bowl",), ("Odd",)], "item_name string"))
    got = {r.canonical_name: (r.issues, r.suggested_fix) for r in out.collect()}
    assert got == {"Custom": (["NO COST", "UNCATEGORIZED", "MISSING MENU GROUP", "WRONG CHANNEL"], "Add to item lookup: Custom"),
                   "Odd": (["UNCATEGORIZED"], "Map sub-category: Odd")}
    totals = reports.open_item_totals(out).first()
    assert tuple(totals) == (2, 10, 1, 2)
    assert reports.with_issue(out, "NO COST").count() == 1 and reports.with_issue(out).count() == 2


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.decimals(min_value=-50, max_value=5000, places=2), st.sampled_from([Decimal(7), Decimal(0)])),
                min_size=1, max_size=40))
def test_global_rank_equals_sorting(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v decimal(18,2)")
    got = {r.i: r["rank"] for r in shares.global_rank(df, "v").collect()}
    known = [v for v in values if v is not None]
    want = {i: 1 + (len(known) if v is None else sum(x > v for x in known)) for i, v in enumerate(values)}
    assert got == want


def test_rank_of_small_negative_values(frame):
    df = frame([(0.0,), (-0.5,), (-0.01,), (0.01,), (-3.0,), (None,)], "v double")
    got = {r.v: r["rank"] for r in shares.global_rank(df, "v").collect()}
    assert got == {0.01: 1, 0.0: 2, -0.01: 3, -0.5: 4, -3.0: 5, None: 6}


def test_rank_within_groups(frame):
    df = frame([("a", 5), ("a", 5), ("a", 1), ("b", 2)], "g string, v int")
    assert sorted((r.g, r.v, r["rank"]) for r in shares.global_rank(df, "v", by=["g"]).collect()) == [
        ("a", 1, 3), ("a", 5, 1), ("a", 5, 1), ("b", 2, 1)]


def test_top_page_and_subtotals(frame, rows):
    df = frame([(f"i{n:02d}", "ab"[n % 2], n) for n in range(60)], "canonical_name string, menu_group string, net_sales int")
    assert [r.net_sales for r in shares.top_items(df, 3).collect()] == [59, 58, 57]
    per = shares.top_items(df, 1, per=["menu_group"])
    assert rows(per, "menu_group", "net_sales") == [("a", 58), ("b", 59)]
    assert [r.net_sales for r in shares.page(df, 3, [F.desc("net_sales")]).collect()] == list(range(9, -1, -1))
    sums = shares.subtotals(df, ["menu_group", "canonical_name"], {"net_sales": "net_sales"})
    assert rows(sums.filter("level > 0"), "menu_group", "level", "net_sales") == [(None, 2, 1770), ("a", 1, 870), ("b", 1, 900)]


def test_share_of_zero_total_is_null(frame):
    assert shares.share_of(frame([("a", 0)], "k string, v int"), "v").first().share is None


def test_payment_mix(frame, rows):
    pays = frame([("OTHER", "EzCater", Decimal(30)), ("CASH", None, Decimal(10)), ("OTHER", "EzCater", Decimal(10)), ("CASH", None, None)],
                 "payment_type string, alt_payment_name string, amount decimal(18,4)")
    assert rows(reports.payment_mix(pays)) == [("CASH", "CASH", 2, 10, 5.0, 0.2), ("EzCater", "OTHER", 2, 40, 20.0, 0.8)]
