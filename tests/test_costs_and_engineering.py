"""Modifier costs, cost fallback, quadrants and metric identities."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from menumix.operators import costing, engineering, joins, reports

COSTS = [("Chicken Tikka", "2"), ("Basmati Rice", "0.5"), ("Mixed Greens", "0.7"), ("Mint Chutney", "0.3"), ("Paneer", "3"), ("Extra Ghee", "9")]
RULES = [
    ("Chicken Tikka", "2", "listed"), ("Extra Chicken Tikka", "2", "derived"), ("1/2 Basmati Rice", "0.25", "derived"),
    ("1/2 and Mixed Greens", "0.35", "derived"), ("Mint Chutney - Side", "0.3", "derived"), ("Organic Paneer", "3", "derived"),
    ("Paneer - Pick 2 Combo", "3", "derived"), ("Skip Rice", "0", "zero"), ("No Paneer", "0", "zero"), ("Add Plastic Bag", "0", "zero"),
    ("Utensils", "0", "zero"), ("Nothing Known", None, "missing"), ("Extra Ghee", "9", "listed"), ("Extra Unknown", None, "missing"),
    ("Casino Paneer", None, "missing"),
]


@pytest.fixture(scope="module")
def unit_costs(spark):
    df = spark.createDataFrame([(n, 202603, Decimal(c)) for n, c in COSTS], "clean_name string, period_key int, cost_per_portion decimal(12,4)")
    return costing.modifier_unit_costs(df)


def test_name_rules(frame, unit_costs):
    names = frame([(n, 202603) for n, _, _ in RULES], "canonical_name string, period_key int")
    got = {r.canonical_name: (r.unit_cost, r.cost_rule) for r in costing.derive_modifier_cost(names, unit_costs).collect()}
    assert got == {n: (None if c is None else Decimal(c), rule) for n, c, rule in RULES}


QUANTITIES = "item_name string, channel_code string, period_key int, mod_type string, canonical_name string, quantity decimal(28,4)"


def test_half_and_half_uses_full_costs(frame, unit_costs):
    def q(item, name, n, kind="Base"):
        return (item, "APP", 202603, kind, name, Decimal(n))

    df = frame([q("Bowl", "1/2 and 1/2 Base", 4), q("Bowl", "1/2 Basmati Rice", 3), q("Bowl", "1/2 Mixed Greens", 1),
                q("Bowl", "Chicken Tikka", 2, "Main"), q("Plate", "1/2 and 1/2 Base", 1)], QUANTITIES)
    got = {(r.item_name, r.mod_type): (r.type_cost, r.unpriced_quantity) for r in costing.modifier_cost_by_type(df, unit_costs).collect()}
    # half cost = (3 * 0.5 + 1 * 0.7) / 4 = 0.55; with 4 choices 2.20, plus the halves themselves 3 * 0.25 + 0.35
    assert got == {("Bowl", "Base"): (Decimal("3.3"), 0), ("Bowl", "Main"): (4, 0), ("Plate", "Base"): (None, 1)}


def test_scope_and_plates(frame, rows):
    df = frame([("APP", "Sauce", "Bowl"), ("IN_HOUSE", "Sauce", "Bowl"), ("IN_HOUSE", "Main", "Plates"), ("CATERING", "Make it a Meal", "Plates"),
                ("TPD", "Extra Main", "Plates"), ("TPD", "Main", None)], "channel_code string, mod_type string, sub_category string")
    scoped = costing.channel_modifier_scope(df)
    assert scoped.count() == 5
    assert rows(costing.plates_rule(scoped), "channel_code", "mod_type") == [
        ("APP", "Sauce"), ("CATERING", "Make it a Meal"), ("TPD", "Main")]


def test_untyped_modifiers_show_as_unpriced(frame, unit_costs):
    lines = frame([("s1", "o1", "Bowl", "IN_HOUSE", "L1", date(2026, 3, 2), False, False)],
                  "selection_guid string, order_guid string, canonical_name string, channel_code string, location_code string, "
                  "business_date date, is_voided boolean, is_deferred boolean")
    mods = frame([("s1", "o1", "Main", "Chicken Tikka", 2.0, False), ("s1", "o1", None, "Chicken Tikka", 3.0, False), ("s1", "o1", None, "Unknown", 4.0, False)],
                 "parent_selection string, order_guid string, mod_type string, canonical_name string, quantity double, is_voided boolean")
    days = frame([(date(2026, 3, 2), 202603)], "business_date date, period_key int")
    quantities = costing.modifier_quantities(mods.withColumn("quantity", F.col("quantity").cast("decimal(28,4)")), lines, days)
    kept = costing.plates_rule(costing.channel_modifier_scope(quantities).withColumn("sub_category", F.lit("Plates"))).drop("sub_category")
    assert {r.mod_type for r in kept.collect()} == {"Untyped"}  # a plate comes with its main
    costs = costing.modifier_cost_by_type(costing.channel_modifier_scope(quantities), unit_costs)
    got = {r.mod_type: (r.type_cost, r.modifier_quantity, r.unpriced_quantity) for r in costs.collect()}
    assert got == {"Main": (4, 2, 0), "Untyped": (None, 7, 7)}
    items = frame([("Bowl", "IN_HOUSE", 202603, Decimal(1), Decimal(2), "Entrees")],
                  "canonical_name string, channel_code string, period_key int, quantity decimal(28,4), base_cost decimal(12,4), category string")
    row = costing.avg_cost_with_modifiers(items, costs).first()
    assert (row.total_modifier_cost, row.unpriced_quantity) == (4, 7)


def test_cost_with_modifiers(frame):
    items = frame([("Bowl", "APP", 1, Decimal(10), Decimal(2), "Entrees"), ("Bowl", "TPD", 1, Decimal(10), Decimal(2), "Entrees"),
                   ("Naan", "TPD", 1, Decimal(10), Decimal(1), "Sides"), ("New", "APP", 1, Decimal(4), None, "Entrees")],
                  "canonical_name string, channel_code string, period_key int, quantity decimal(28,4), base_cost decimal(12,4), category string")
    types = frame([("Bowl", "APP", 1, "Main", Decimal(15)), ("Bowl", "APP", 1, "Base", Decimal(5)), ("Bowl", "TPD", 1, "Main", Decimal(20)),
                   ("Naan", "TPD", 1, "Main", Decimal(50))],
                  "item_name string, channel_code string, period_key int, mod_type string, type_cost decimal(24,4)")
    got = {(r.canonical_name, r.channel_code): r.avg_cost for r in costing.avg_cost_with_modifiers(items, types).collect()}
    assert got == {("Bowl", "APP"): 4.0, ("Bowl", "TPD"): pytest.approx(2 + 2 * 1.18), ("Naan", "TPD"): 1.0, ("New", "APP"): None}


def test_cost_fallback_chain(frame):
    cost = frame([("A", 202603, "L1", Decimal(1)), ("A", 202603, None, Decimal(2)), ("A", 202605, None, Decimal(5)), ("B", 202601, None, Decimal(7)),
                  ("B", 202602, None, None)], "item_name string, period_key int, location_code string, avg_cost decimal(10,4)")
    items = frame([("A", 202603, "L1"), ("A", 202603, "L2"), ("A", 202604, "L1"), ("B", 202602, "L1"), ("C", 202603, "L1"), ("Side of Main", 202603, "L1")],
                  "canonical_name string, period_key int, location_code string")
    got = {(r.canonical_name, r.period_key, r.location_code): (r.avg_cost, r.cost_source, r.no_cost) for r in joins.cost_lookup(items, cost).collect()}
    assert got == {
        ("A", 202603, "L1"): (1, "location", False), ("A", 202603, "L2"): (2, "period", False), ("A", 202604, "L1"): (5, "latest", False),
        ("B", 202602, "L1"): (7, "latest", False), ("C", 202603, "L1"): (None, None, True), ("Side of Main", 202603, "L1"): (None, None, False)}
    plain = joins.cost_lookup(items, cost.filter("location_code is null").drop("location_code"))
    assert {r.cost_source for r in plain.collect()} == {"period", "latest", None}


ITEMS = "canonical_name string, channel_code string, category string, quantity decimal(28,4), net_sales decimal(28,4), avg_cost decimal(12,4)"


def metrics(frame, rows):
    data = [(n, c, cat, Decimal(q), Decimal(s), None if k is None else Decimal(k)) for n, c, cat, q, s, k in rows]
    return reports.item_metrics(frame(data, ITEMS))


def test_quadrants_and_strictness(frame):
    # A and B sit exactly on the margin threshold of 0.5.
    items = metrics(frame, [("A", "APP", "E", 50, 100, 1), ("B", "APP", "E", 50, 100, 1), ("C", "CATERING", "E", 900, 900, "0.1"),
                            ("D", "APP", None, 10, 10, 1), ("E", "APP", "E", 5, 5, None), ("F", "APP", "E", 0, 0, 1)])
    strict = {r.canonical_name: r for r in engineering.menu_engineering(items).collect()}
    loose = {r.canonical_name: r for r in engineering.menu_engineering(items, strict=False).collect()}
    assert strict["A"].n_items == 2 and strict["A"].margin_threshold == 0.5 and strict["A"].mix_threshold == pytest.approx(0.35)
    assert (strict["A"].margin_class, loose["A"].margin_class) == ("Low", "High")
    assert (strict["A"].quadrant, loose["A"].quadrant) == ("Dog", "Puzzle")
    assert all(strict[x].quadrant is None for x in "CDEF")


def test_all_four_quadrants(frame, rows):
    items = metrics(frame, [("Star", "APP", "E", 45, 450, 2), ("Plow", "APP", "E", 45, 90, "1.9"), ("Puzzle", "APP", "E", 5, 100, 1), ("Dog", "APP", "E", 5, 10, "1.9")])
    out = engineering.menu_engineering(items)
    assert {r.canonical_name: r.quadrant for r in out.collect()} == {
        "Star": "Star", "Plow": "Plow Horse", "Puzzle": "Puzzle", "Dog": "Dog"}
    shares = {r.quadrant: (r.n_items, r.revenue_share) for r in engineering.quadrant_summary(out).collect()}
    assert shares["Star"] == (1, pytest.approx(450 / 650)) and sum(s for _, s in shares.values()) == pytest.approx(1)


def test_empty_scope(frame):
    out = engineering.menu_engineering(metrics(frame, [("A", "CATERING", "E", 5, 5, 1)])).first()
    assert out.quadrant is None and out.margin_threshold is None


def test_overall_inherits_best_channel(frame):
    items = metrics(frame, [("A", "APP", "E", 10, 100, 1), ("A", "TPD", "E", 10, 300, 29), ("B", "APP", "E", 10, 100, 5), ("B", "TPD", "E", 1, 9, 1)])
    classified = engineering.menu_engineering(items, by=["channel_code"])
    got = {r.canonical_name: r.from_channel for r in engineering.overall_from_channels(classified).collect()}
    assert got == {"A": "TPD", "B": "APP"}


amounts = st.decimals(min_value="0.01", max_value="9999", places=2)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["APP", "TPD"]), amounts, amounts, amounts), min_size=1, max_size=12,
                unique_by=lambda r: r[:2]))
def test_metric_identities_hold(spark, data):
    rows = [(n, c, "E", q, s, k) for n, c, q, s, k in data]
    items = reports.item_metrics(spark.createDataFrame(rows, ITEMS))
    checked = reports.verify_metrics(items)
    flags = [c for c in checked.columns if c.endswith("_ok")]
    assert checked.filter(~F.expr(" and ".join(flags))).count() == 0
    totals = items.agg(F.sum("menu_mix_pct").alias("m"), F.sum("sls_pct").alias("s")).first()
    assert totals.m == pytest.approx(1) and totals.s == pytest.approx(1)


def test_broken_identity_is_reported(frame):
    items = metrics(frame, [("A", "APP", "E", 10, 100, 1)]).withColumn("avg_price", F.lit(11.0))
    row = reports.verify_metrics(items).first()
    assert not row.price_ok and row.cogs_ok and not row.margin_ok
