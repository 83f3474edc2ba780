"""Merge semantics."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from menumix.operators import joins, upsert


def test_upsert_column_rules(frame, rows):
    schema = "k int, upd string, keep string, first string, big int"
    old = frame([(1, "a", "a", "a", 5), (2, "b", "b", "b", 5)], schema)
    new = frame([(1, "x", None, "x", 3), (3, "z", None, "z", 1)], schema)
    got = rows(upsert.upsert(old, new, ["k"], update=["upd"], keep_if_null=["keep"], greatest=["big"]))
    assert got == [(1, "x", "a", "a", 5), (2, "b", "b", "b", 5), (3, "z", None, "z", 1)]


def test_update_may_write_null(frame, rows):
    old, new = frame([(1, "a")], "k int, v string"), frame([(1, None)], "k int, v string")
    assert rows(upsert.upsert(old, new, ["k"], update=["v"])) == [(1, None)]


@pytest.mark.parametrize("old, new, wins", [(5, 6, True), (5, 5, True), (6, 5, False), (None, 1, True), (9, None, True)])
def test_upsert_latest(frame, old, new, wins):
    raw = frame([("o", old, "old")], "order_guid string, modified_date int, payload string")
    batch = frame([("o", new, "new")], "order_guid string, modified_date int, payload string")
    assert upsert.upsert_latest(raw, batch).first().payload == ("new" if wins else "old")


def fold(versions):
    """The landing rule applied one arrival at a time."""
    state = None
    for modified, arrival in versions:
        if state is None or modified is None or state[0] is None or modified >= state[0]:
            state = (modified, arrival)
    return state


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=9), min_size=1, max_size=30))
def test_resolve_versions_equals_sequential_upserts(spark, logs):
    data = [(str(k), m, i) for k, log in enumerate(logs) for i, m in enumerate(log)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "order_guid string, modified_date int, arrival int")
    got = {r.order_guid: (r.modified_date, r.arrival) for r in upsert.resolve_versions(df).collect()}
    assert got == {str(k): fold([(m, i) for i, m in enumerate(log)]) for k, log in enumerate(logs)}


def test_dedupe_keeps_first_arrival(frame, rows):
    df = frame([("a", 2, "late"), ("a", 1, None), ("b", 1, "only")], "k string, at int, v string")
    assert rows(upsert.dedupe_first(df, ["k"], ["at"])) == [("a", 1, None), ("b", 1, "only")]


def test_insert_ignore_and_append(frame, rows):
    old, new = frame([(1, "a")], "k int, v string"), frame([(1, "x"), (2, "y")], "k int, v string")
    assert rows(upsert.insert_ignore(old, new, ["k"])) == [(1, "a"), (2, "y")]
    assert rows(upsert.append(old, new)) == [(1, "a"), (1, "x"), (2, "y")]
    once = upsert.append(old, new, ["k"])
    assert rows(upsert.append(once, new, ["k"])) == rows(once) == [(1, "x"), (2, "y")]


def test_dim_item(frame, rows):
    schema = ("selection_guid string, item_guid string, location_code string, raw_name string, clean_name string, "
              "item_multi_loc_id string, menu_name string, menu_group_name string, sales_category string, business_date date")
    from datetime import date

    def line(sel, guid, name, group, day):
        return (sel, guid, "L1", "Raw", name, "", "M" + sel, group, "C" + sel, date(2026, 3, day))

    first = upsert.upsert_dim_item(None, frame([line("1", "i", "Old", "G1", 1), line("2", "", "Open", None, 2), line("3", "i", "New", None, 5)], schema))
    again = upsert.upsert_dim_item(first, frame([line("4", "i", "Newest", "G2", 3)], schema))
    got = rows(again, "natural_key", "canonical_name", "menu_name", "menu_group", "sales_category", "first_seen", "last_seen")
    assert got == [("L1::Raw", "Open", "M2", None, "C2", date(2026, 3, 2), date(2026, 3, 2)),
                   ("i", "Newest", "M3", "G2", "C3", date(2026, 3, 5), date(2026, 3, 5))]
    assert again.select("item_key").distinct().count() == 2
    assert rows(first, "natural_key", "item_key") == rows(again, "natural_key", "item_key")


def test_dim_modifier_needs_review(frame, rules, rows):
    from datetime import date
    mods = frame([("Basmati Rice", date(2026, 1, 2)), ("Basmati Rice", date(2026, 1, 1)), ("New Thing", date(2026, 1, 3))],
                 "clean_name string, business_date date")
    got = rows(upsert.upsert_dim_modifier(None, mods, rules["tags"]), "natural_key", "mod_type", "needs_review", "first_seen", "last_seen")
    assert got == [("Basmati Rice", "base", False, date(2026, 1, 1), date(2026, 1, 2)),
                   ("New Thing", None, True, date(2026, 1, 3), date(2026, 1, 3))]


def test_history_ranges(frame, rows):
    from datetime import date
    seen = [("i", "A", 1), ("i", "A", 2), ("i", "B", 5), ("i", "A", 9), ("j", "C", 3)]
    df = frame([(k, v, date(2026, 1, n)) for k, v, n in seen], "key string, name string, at date")
    got = rows(upsert.dim_history(df, "key", ["name"], "at"))
    assert got == [("i", "A", date(2026, 1, 1), date(2026, 1, 4), False), ("i", "A", date(2026, 1, 9), None, True),
                   ("i", "B", date(2026, 1, 5), date(2026, 1, 8), False), ("j", "C", date(2026, 1, 3), None, True)]


def test_top_payment_order(frame, rows):
    pays = frame([("o1", "p1", "A", 5), ("o1", "p2", "B", None), ("o1", "p3", None, 99), ("o2", "p5", "Y", 3), ("o2", "p4", "X", 3),
                  ("o3", "p6", None, 1), ("o4", "p7", "Z", None)],
                 "order_guid string, payment_guid string, alt_payment_name string, amount int")
    lines = frame([("o1",), ("o2",), ("o3",), ("o4",), ("o5",)], "order_guid string")
    assert rows(joins.top_payment(lines, pays)) == [("o1", "A"), ("o2", "X"), ("o3", None), ("o4", "Z"), ("o5", None)]


def test_late_changes_split_and_join_ranges(frame, rows):
    from datetime import date
    kind = "key string, name string, at date, arrival int"
    early = [("i", "A", 1, 0), ("i", "B", 10, 1), ("i", "A", 20, 2), ("j", "C", 3, 3), ("k", "X", 5, 4)]
    # splits A's first range, turns B into A so that three ranges become one, wins its day by arrival, comes before all ranges
    late = [("i", "Z", 5, 9), ("i", "A", 10, 8), ("j", "B", 3, 7), ("j", "D", 1, 6), ("new", "N", 2, 5)]
    early, late = ([(k, v, date(2026, 1, n), a) for k, v, n, a in part] for part in (early, late))
    stored = upsert.dim_history(frame(early, kind), "key", ["name"], "at", "arrival")
    got = rows(upsert.merge_history(stored, frame(late, kind), "key", ["name"], "at", "arrival"))
    assert got == rows(upsert.dim_history(frame(early + late, kind), "key", ["name"], "at", "arrival"))
    assert [(r[1], r[2].day) for r in got if r[0] == "i"] == [("A", 1), ("A", 10), ("Z", 5)]
    assert [(r[1], r[2].day) for r in got if r[0] == "j"] == [("B", 3), ("D", 1)]


def test_of_two_changes_on_a_day_the_later_one_stands(frame, rows):
    df = frame([("i", "Z", 1, 1), ("i", "A", 1, 2)], "key string, name string, at int, arrival int").selectExpr("key", "name", "date_add(date'2026-01-01', at) as at", "arrival")
    assert [r[1] for r in rows(upsert.dim_history(df, "key", ["name"], "at", "arrival"))] == ["A"]
