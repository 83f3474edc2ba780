"""Channels, inclusion, categories, periods and date ranges."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions import calendar as cal
from menumix.operators import filters

CHANNEL_CASES = [
    # override, alt payment, dining option, sales category, channel
    ("OTHER", "EzCater", None, None, "OTHER"),
    (None, "EzCater", "Open App", None, "CATERING"),
    (None, "ZeroCater Fooda", None, None, "CATERING"),  # catering patterns come first
    (None, "Aramark cafe", "Catering", None, "OFFSITE"),
    (None, "UBER eats", None, "Catering", "TPD"),
    (None, "House account", "Catering pickup", None, "CATERING"),
    (None, None, "Dine In", "Catering food", "CATERING"),
    (None, None, "My Open App order", None, "APP"),
    (None, None, "Online Ordering - Takeout", "Food", "APP"),
    (None, None, "Dine In", "Food", "IN_HOUSE"),
    (None, None, None, None, "IN_HOUSE"),
]


def test_channel_precedence(frame):
    df = frame([(i, *c[:4]) for i, c in enumerate(CHANNEL_CASES)],
               "i int, manual string, alt_payment_name string, dining_option string, sales_category string")
    got = {r.i: r.channel_code for r in filters.attribute_channel(df, override="manual").collect()}
    assert got == {i: c[4] for i, c in enumerate(CHANNEL_CASES)}


def test_revenue_modes_and_inclusion(frame, rows):
    df = frame([("live", False, False, "G", None), ("void", True, False, "G", None), ("later", False, True, "G", None),
                ("open", False, False, "", "Food"), ("ghost", False, False, None, ""), ("open2", False, False, None, "Food")],
               "n string, is_voided boolean, is_deferred boolean, menu_group string, sales_category string")
    assert {r.n for r in filters.filter_revenue(df, "load").collect()} == {"live", "later", "open", "ghost", "open2"}
    got = rows(filters.inclusion_rule(df), "n", "is_open_item")
    assert got == [("live", False), ("open", True), ("open2", True)]
    with pytest.raises(ValueError):
        filters.filter_revenue(df, "other")


def test_real_menu_items_keeps_unknown_groups(frame):
    df = frame([("FOOD", None, "A"), (None, "Fooda", "B"), ("CATERING", "BOWLS", "C"), (None, None, "Utensils"), ("FOOD", "BOWLS", "D")],
               "menu_name string, menu_group string, canonical_name string")
    assert {r.canonical_name for r in filters.real_menu_items(df).collect()} == {"A", "D"}


CATEGORY_CASES = [
    ("Any Bowl", "BOWLS", "FOOD", "Entrees", "Bowl"),
    ("That Fire Hot Sauce (Bottle)", "SIDES", "FOOD", "Retail", "Sauce Bottle"),  # item override first
    ("Mango Lassi", "DRINKS", "FOOD", "NA Drinks", "Lassi"),
    ("BYO Indian Burrito", "BYO", "FOOD", "Entrees", "Burrito"),
    ("Looked Up", "", "FOOD", "Sweets", "Yogurt"),
    ("Looked Odd", None, "FOOD", None, "Looked Odd"),
    ("Unknown", None, "FOOD", None, None),
    ("Any Bowl", "Fooda", "OFFSITE POP-UPS", "Fooda", None),
    ("Kingfisher", "Beer", "FOOD", "Alc Drinks", "Beer"),
    ("Plain Side", "SIDES", None, "Sides", None),
]


def test_categories(spark, frame):
    df = frame([(i, *c[:3]) for i, c in enumerate(CATEGORY_CASES)],
               "i int, canonical_name string, menu_group string, menu_name string")
    lookup = frame([("r1", "Looked Up", "x", "Bowls", 1), ("r2", "Looked Up", "x", "Yogurt", 2),
                    ("r3", "Looked Odd", "x", "Looked Odd", 1), ("r4", "Utensils", "x", "Bowls", 1)],
                   "raw_item_name string, cleaned_item_name string, category_1 string, category_2 string, loaded_at int")
    one = filters.lookup_one_per_name(lookup)
    assert {r.cleaned_item_name for r in one.collect()} == {"Looked Up", "Looked Odd"}
    out = filters.resolve_category(df, filters.category_rules(spark), one)
    got = {r.i: (r.category, r.sub_category) for r in out.collect()}
    assert got == {i: c[3:] for i, c in enumerate(CATEGORY_CASES)}


def test_rule_keys_are_unique():
    for table in (fv.GROUP_CATEGORIES, fv.ITEM_CATEGORIES, fv.SUBCATEGORY_CATEGORIES, fv.EXTERNAL_ITEM_NAMES, fv.MODIFIER_TYPE_NAMES):
        names = [row[0] for row in table]
        assert len(names) == len(set(names))


def test_default_periods_are_gapless(spark, frame):
    days = [(date(2025, 12, 30),), (date(2025, 12, 31),), (date(2026, 3, 25),), (date(2026, 4, 22),), (date(2026, 8, 12),), (date(2026, 8, 13),)]
    out = cal.assign_period(frame(days, "business_date date"), cal.default_calendar(spark))
    got = {str(r.business_date): (r.period_label, r.period_key) for r in out.collect()}
    assert got == {"2025-12-30": ("Other", None), "2025-12-31": ("P1 2026", 202601), "2026-03-25": ("P4 2026", 202604),
                   "2026-04-22": ("P4 2026", 202604), "2026-08-12": ("P8 2026", 202608), "2026-08-13": ("Other", None)}
    assert cal.calendar_days(cal.default_calendar(spark)).count() == 225


def test_weekly_bucket_starts_monday(frame):
    df = frame([(date(2026, 3, 1),), (date(2026, 3, 2),)], "business_date date")
    got = [str(r.bucket) for r in cal.bucket_time(df, "weekly").orderBy("business_date").collect()]
    assert got == ["2026-02-23", "2026-03-02"]
    with pytest.raises(ValueError):
        cal.bucket_time(df, "hourly")


@pytest.mark.parametrize("name, first, last", [
    ("Today", "2026-03-04", "2026-03-04"), ("yesterday", "2026-03-03", "2026-03-03"), ("This Week", "2026-03-02", "2026-03-08"),
    ("Last Week", "2026-02-23", "2026-03-01"), ("Last 4 Weeks", "2026-02-05", "2026-03-04"), ("last 8 weeks", "2026-01-08", "2026-03-04"),
    ("This Month", "2026-03-01", "2026-03-31"), ("Last Month", "2026-02-01", "2026-02-28"), ("Q4 2026", "2026-10-01", "2026-12-31"),
    ("Q1", "2026-01-01", "2026-03-31"), ("YTD", "2026-01-01", "2026-03-04"), ("P4 2026", "2026-03-25", "2026-04-22"),
    ("2026-01-05..2026-01-09", "2026-01-05", "2026-01-09"),
])
def test_date_ranges(name, first, last):
    assert tuple(str(x) for x in cal.date_range(name, date(2026, 3, 4))) == (first, last)


def test_date_preset_filters(frame):
    df = frame([(date(2026, 3, d),) for d in range(1, 9)], "business_date date")
    assert cal.date_preset(df, "this week", date(2026, 3, 4)).count() == 7
    assert cal.prior_range(date(2026, 3, 2), date(2026, 3, 8)) == (date(2026, 2, 23), date(2026, 3, 1))
    with pytest.raises(ValueError):
        cal.date_range("someday", date(2026, 3, 4))


def test_scope_search_is_literal(frame):
    df = frame([("100% Juice", "L1", "APP", "M"), ("100 Juice", "L1", "APP", "M"), ("a_b", "L2", "TPD", "M"), ("acb", "L2", "TPD", "M")],
               "canonical_name string, location_code string, channel_code string, menu_name string")
    assert [r[0] for r in filters.scope(df, search="100%").collect()] == ["100% Juice"]
    assert [r[0] for r in filters.scope(df, search="A_B").collect()] == ["a_b"]
    assert filters.scope(df, locations=["L2"], channels=["TPD"], menus=["M"]).count() == 2
    assert filters.scope(df).count() == 4


def test_category_order(frame):
    df = frame([("Sides",), ("Alc Drinks",), (None,), ("Entrees",)], "category string")
    got = {r.category: r.p for r in df.select("category", filters.category_position(F.col("category")).alias("p")).collect()}
    assert got == {"Entrees": 0, "Sides": 1, "Alc Drinks": 6, None: 7}
