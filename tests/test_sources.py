"""Retention extracts, sheets, cost files, writers."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.calendar import default_calendar
from menumix.operators import joins, reports, shares
from menumix.operators.upsert import upsert
from menumix.sources import files

IGNORED = [f"Item column {i} absolute difference" for i in range(20)]
HEADER = [name for name, _, _ in fv.RETENTION_COLUMNS] + IGNORED


def extract(path, records, columns=HEADER, bom=True):
    text = [",".join(columns)]
    for record in records:
        text.append(",".join(str(record.get(c, "")) for c in columns))
    path.write_text(("﻿" if bom else "") + "\n".join(text) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def retention(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("instore")
    extract(folder / "P042026IS.csv", [
        {"Item": "Naan", "Item id": "x", "Item revenue": "10.50", "Item volume": "3", "N day item return rate": "0.3000",
         "N day item return rate previous": "0.2500", "Business date previous start": "2026-02-25", "Business date previous end": "2026-03-24"},
        {"Item": " Naan ", "Item revenue": "11.25", "N day item return rate": "0.2900", "N day item return rate previous": "0.2500",
         "Business date previous end": "2026-03-24"},
        {"Item": "", "Item revenue": "5"},
        {"Item": "Grain Bowl", "Item revenue": "#ERROR!", "Business date previous end": "2024-12-29", "N day item return rate": "0.1"},
        {"Item": '"Rice, plain"', "Item guests": "7"},
    ])
    # another column order, no byte order mark, lower-case name
    extract(folder / "p052026is.csv", [{"Item": "Naan", "Item revenue": "20", "Item volume": "4"}], list(reversed(HEADER)), bom=False)
    extract(folder / "PxIS.csv", [{"Item": "Skipped"}])
    return files.read_retention(spark, f"{folder}/*.csv", files.INSTORE_FILE)


def test_retention_extracts(retention, rows):
    assert len(retention.columns) == 26
    got = rows(retention, "fiscal_year", "period", "item_name", "revenue", "volume", "guests", "return_rate")
    assert got == [
        (2026, 4, "Grain Bowl", None, None, None, Decimal("0.1")), (2026, 4, "Naan", Decimal("11.25"), None, None, Decimal("0.29")),
        (2026, 4, "Rice, plain", None, None, 7, None), (2026, 5, "Naan", 20, 4, None, None)]
    kinds = dict(retention.dtypes)
    assert (kinds["revenue"], kinds["return_rate"], kinds["prev_period_end"]) == ("decimal(12,2)", "decimal(8,6)", "date")


def test_period_guard(retention, spark, rows):
    flagged = reports.period_guard(retention, default_calendar(spark))
    assert rows(flagged.filter("is_stale"), "item_name") == [("Grain Bowl",)]
    with pytest.raises(ValueError, match="do not fit"):
        reports.period_guard(retention, default_calendar(spark), mode="raise")


def test_retention_report(retention, frame):
    items = frame([("Naan", 5), ("BYO Grain Bowl", 7), ("Never Seen", 1)], "canonical_name string, quantity int")
    report = reports.retention_report(joins.attach_retention(items, retention.filter("period = 4")))
    got = {r.canonical_name: (r.return_rate, r.return_delta, r.band) for r in report.collect()}
    assert got == {"Naan": (Decimal("0.29"), Decimal("0.04"), "green"), "BYO Grain Bowl": (Decimal("0.1"), None, "red"),
                   "Never Seen": (None, None, None)}
    kpis = reports.retention_kpis(report).first()
    assert (kpis.best_item, kpis.worst_item, kpis.avg_return_rate) == ("Naan", "BYO Grain Bowl", pytest.approx(0.195))


def test_retention_of_several_periods(frame, rows):
    extracts = frame([("Samosa", 1998, 4, 0.3), ("Samosa", 1998, 5, 0.1), ("Samosa", 1999, 5, 0.2)],
                     "item_name string, fiscal_year int, period int, return_rate double")
    items = frame([("Samosa", 1998, 4), ("Samosa", 1998, 5), ("Samosa", 1999, 5), ("Samosa", 1999, 6)],
                  "canonical_name string, fiscal_year int, period int")
    got = rows(joins.attach_retention(items, extracts), "fiscal_year", "period", "return_rate")
    assert got == [(1998, 4, 0.3), (1998, 5, 0.1), (1999, 5, 0.2), (1999, 6, None)]


def test_retention_upsert_and_union(retention, rows):
    newer = retention.filter("period = 5").withColumn("revenue", F.lit(None).cast("decimal(12,2)"))
    merged = files.upsert_retention(retention, newer)
    assert rows(merged.filter("period = 5"), "item_name", "revenue") == [("Naan", None)]
    assert shares.union_retention(retention, newer).groupBy("source_channel").count().count() == 2


def sheet_file(path, cells, skip=0):
    lines = [",".join(["head"] * 27)] * skip
    for row in cells:
        lines.append(",".join(str(row.get(i, "")) for i in range(27)))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_lookup_sheets(spark, tmp_path, rows):
    path = tmp_path / "lookup.csv"
    sheet_file(path, [{5: "Rice", 6: "Bowl", 7: "Base", 9: "Bowl", 10: "BYO"}, {5: " Rice ", 6: "Bowl", 7: "Bases"},
                      {5: "Tikka", 6: ""}, {5: "Dal", 6: "Bowl", 9: "Bowl", 10: "BYO"}], skip=2)
    sheet = files.read_sheet(spark, str(path), skip_rows=2)
    assert rows(files.load_modifier_types(sheet)) == [("Dal", "Bowl", None), ("Rice", "Bowl", "Bases")]
    assert rows(files.load_parent_types(sheet)) == [("Bowl", "BYO")]


def test_item_lookup(spark, tmp_path, rows):
    path = tmp_path / "menu.csv"
    sheet_file(path, [{0: "Naan - Side", 1: "Naan", 3: "Naan", 4: "Bread", 6: "Bread", 7: "Sides"},
                      {0: "Naan", 1: "Naan", 3: "Lassi", 4: "Drink"}, {0: "Odd", 1: "Unlisted"}])
    assert rows(files.load_item_lookup(files.read_sheet(spark, str(path)))) == [
        ("Lassi", "Lassi", "Drink", None), ("Naan", "Naan", "Bread", "Sides"), ("Naan - Side", "Naan", "Bread", "Sides"),
        ("Odd", "Unlisted", None, None)]


def test_cost_files(spark, tmp_path, rows):
    mods = tmp_path / "P032026ModifierCost.csv"
    sheet_file(mods, [{0: "R1", 1: "Rice", 14: "OZ", 25: "4.5", 26: "0.55555"}, {0: "R1 ", 1: "Other", 26: "9"}, {0: "R2", 25: "#ERROR!", 26: ""}, {1: "no recipe"}], skip=1)
    got = files.load_modifier_cost(files.read_sheet(spark, str(mods), 1))
    assert rows(got, "period", "recipe_name", "clean_name", "total_cost", "cost_per_portion") == [
        ("P03-2026", "R1", "Rice", Decimal("4.5"), Decimal("0.5556")), ("P03-2026", "R2", None, None, None)]
    items = tmp_path / "P032026ItemCost.csv"
    sheet_file(items, [{0: "FOOD", 2: "Naan", 6: "$1.25"}, {0: "FOOD", 2: "Naan", 6: " $$1.50 "}, {0: "APP", 2: "Naan", 6: "n/a"}, {2: "No menu", 6: "3"}], skip=1)
    got = files.load_item_cost(files.read_sheet(spark, str(items), 1))
    assert rows(got, "menu", "item_name", "avg_cost") == [("APP", "Naan", None), ("FOOD", "Naan", Decimal("1.5"))]


def test_write_replaces_only_present_partitions(frame, spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "business_date date, v int"
    files.write_table(frame([(date(2026, 1, 1), 1), (date(2026, 1, 2), 2)], schema), path)
    files.write_table(frame([(date(2026, 1, 2), 9)], schema), path)
    assert rows(spark.read.parquet(path), "business_date", "v") == [(date(2026, 1, 1), 1), (date(2026, 1, 2), 9)]


def test_merge_rewrites_touched_partitions_only(frame, spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, v string, business_date date"
    days = [date(2026, 1, d) for d in (1, 2, 3)]
    files.write_table(frame([(1, "a", days[0]), (2, "b", days[0]), (3, "c", days[1])], schema), path)
    kept = sorted(p.name for p in (tmp_path / "t" / "business_date=2026-01-02").iterdir())
    # key 1 now claims another day: its row stays in the partition that holds it
    batch = frame([(1, "x", days[2]), (4, "d", days[2])], schema)
    for _ in range(2):
        files.merge_into(spark, path, batch, ["k"], lambda old, new: upsert(old, new, ["k"], update=["v"]))
        assert rows(spark.read.parquet(path), "k", "v", "business_date") == [
            (1, "x", days[0]), (2, "b", days[0]), (3, "c", days[1]), (4, "d", days[2])]
    assert kept == sorted(p.name for p in (tmp_path / "t" / "business_date=2026-01-02").iterdir())


def test_export_and_dimensions(frame, spark, tmp_path, rows):
    files.export_items_csv(frame([("Rice, \"plain\"", 2)], "item string, n int"), str(tmp_path / "out"))
    assert rows(spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "out"))) == [('Rice, "plain"', "2")]
    assert files.channel_dimension(spark).count() == 6
    old = frame([("L1", "g", "Old"), ("L9", "h", "Kept")], "location_code string, source_guid string, display_name string")
    new = frame([("L1", "g2", "New"), ("L2", "i", "Added")], "location_code string, source_guid string, display_name string")
    assert rows(files.seed_dimension(old, new, "location_code", ["source_guid", "display_name"])) == [
        ("L1", "g2", "New"), ("L2", "i", "Added"), ("L9", "h", "Kept")]
