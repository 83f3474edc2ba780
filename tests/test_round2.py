"""Nothing is lost or doubled: wide extracts, narrow sheets, unlisted values, emptied partitions, white space, unknown costs."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.scalars import blank_to_null
from menumix.operators import clean, costing, engineering, reports, shares
from menumix.operators.upsert import upsert
from menumix.sources import files


def test_an_extract_wider_than_any_limit_is_read(spark, tmp_path, rows):
    names = [f"Extra {i}" for i in range(90)] + ["Item", "Item revenue"]
    (tmp_path / "P042026IS.csv").write_text(",".join(names) + "\n" + ",".join(["x"] * 90 + ["Naan", "3.50"]) + "\n")
    got = files.read_retention(spark, f"{tmp_path}/*.csv", files.INSTORE_FILE)
    assert rows(got, "item_name", "revenue") == [("Naan", Decimal("3.50"))]


def test_an_extract_without_its_item_column_fails(spark, tmp_path):
    (tmp_path / "P042026IS.csv").write_text("Other,Item revenue\nNaan,3\n")
    with pytest.raises(PySparkException, match="no column"):
        files.read_retention(spark, f"{tmp_path}/*.csv", files.INSTORE_FILE).collect()


def test_records_over_several_lines(spark, tmp_path, rows):
    extract = tmp_path / "P042026IS.csv"
    extract.write_text('\ufeffItem,Item revenue\n"Na\n\nan ""x""",3\nRoti,4\n"a,b",5\n')
    got = files.read_retention(spark, str(extract), files.INSTORE_FILE)
    assert rows(got, "item_name", "revenue") == [('Na\n\nan "x"', 3), ("Roti", 4), ("a,b", 5)]
    rules = tmp_path / "rules.csv"
    rules.write_text('raw,clean\n"Soup\nof the day",Soup\nNaan,Bread\n"Soup\nof the day",Broth\n')
    assert rows(files.read_rules(spark, str(rules), "raw", "clean")) == [("naan", "Bread"), ("soup\nof the day", "Broth")]
    sheet = tmp_path / "P042026ItemCost.csv"
    sheet.write_text('head\n"Lunch\r\nmenu",Bowls,"Rice\nBowl",Rice,,Entrees,$4.50\nLunch,Bowls,Dal,,,,"$1,5"\n')
    got = files.load_item_cost(files.read_sheet(spark, str(sheet), 1))
    assert rows(got, "menu", "item_name", "avg_cost") == [("Lunch", "Dal", None), ("Lunch\r\nmenu", "Rice\nBowl", Decimal("4.5"))]


@pytest.mark.parametrize("name, load, needs", [
    ("P042026ItemCost", files.load_item_cost, 7), ("P042026ModifierCost", files.load_modifier_cost, 27), ("lookup", files.load_modifier_types, 11),
    ("lookup", files.load_parent_types, 11), ("menu", files.load_item_lookup, 8)])
def test_a_narrow_sheet_fails_in_its_loader(spark, tmp_path, name, load, needs):
    (tmp_path / f"{name}.csv").write_text('a,b,"c,c,c,c,c,c,c"\n1,2,3\n')
    with pytest.raises(ValueError, match=f"3 columns, {needs} are read"):
        load(files.read_sheet(spark, str(tmp_path)))


def test_merge_removes_emptied_partitions(spark, frame, tmp_path, rows):
    path = str(tmp_path / "t")
    files.write_table(frame([("s1", 1, "A"), ("s2", 2, "B"), ("s3", 3, None)], "k string, v int, part string"), path, "part")
    batch = frame([("s1", 5, "B"), ("s3", 6, "C")], "k string, v int, part string")
    files.merge_into(spark, path, batch, ["k"], lambda old, new: upsert(old, new, ["k"], update=["v", "part"]), "part")
    assert rows(spark.read.parquet(path), "k", "v", "part") == [("s1", 5, "B"), ("s2", 2, "B"), ("s3", 6, "C")]


def test_all_kinds_of_white_space_are_trimmed(frame, rows):
    names = frame([("Napkins\t",), (" Napkins",), ("Nap kins",), (" ",)], "n string")
    rule = frame([("napkins", "")], "key string, value string")
    assert [r.is_blocklisted for r in clean.flag_blocklisted(names, "n", rule).orderBy("n").collect()].count(True) == 2
    assert names.filter(blank_to_null(F.col("n")).isNull()).count() == 1


def test_unlisted_locations_and_channels_stay_in_view(frame):
    lines = frame([("A", "L1", "APP", 1, 1), ("A", "LX", "NEW", 5, 2)], "canonical_name string, location_code string, channel_code string, line_total int, quantity int")
    row = reports.location_matrix(lines, ["L1"]).first()
    assert (row.L1, row.other, row.best_location) == (1, 5, "L1")
    row = reports.channel_split(lines, ["APP"]).first()
    assert (row.app, row.unlisted, row.total) == (1, 5, 6)


def test_margins_speak_of_priced_sales_only(frame):
    items = frame([("A", 1, 100.0, 40.0, 60.0), ("A", 1, 100.0, None, None)], "canonical_name string, quantity int, net_sales double, total_cost double, total_margin double")
    blended, kpi = reports.blended_metrics(items).first(), reports.kpi_summary(items).first()
    assert blended.blended_margin == pytest.approx(0.6) and blended.unpriced_sales == 100 and blended.blended_avg_cost == 40
    assert kpi.avg_margin_pct == pytest.approx(0.6) and kpi.unpriced_sales == 100


def test_open_excluded_and_blank_items_are_not_classified(frame):
    schema = "canonical_name string, category string, is_open_item boolean, is_excluded boolean"
    items = frame([("A", "E", False, None), ("B", "E", True, False), ("C", "E", False, True), ("D", " ", False, False)], schema).withColumns({
        "channel_code": F.lit("APP"), "quantity": F.lit(5), "avg_cost": F.lit(1.0), "net_sales": F.lit(10.0), "total_margin": F.lit(5.0),
        "margin_pct": F.lit(0.5), "menu_mix_pct": F.lit(0.25)})
    got = {r.canonical_name: (r.quadrant, r.n_items) for r in engineering.menu_engineering(items).collect()}
    assert got["A"][0] and got["A"][1] == 1 and [got[x][0] for x in "BCD"] == [None] * 3


def test_unpriced_modifiers_are_carried(frame):
    items = frame([("A", "APP", None, 2, "1.5", "Entrees")], "canonical_name string, channel_code string, period_key int, quantity int, base_cost string, category string")
    items = items.withColumn("base_cost", F.col("base_cost").cast("decimal(12,4)"))
    costs = frame([("A", "APP", None, "Main", 3, 4)], "item_name string, channel_code string, period_key int, mod_type string, type_cost int, unpriced_quantity int")
    row = costing.avg_cost_with_modifiers(items, costs).first()
    assert (row.total_cost, row.unpriced_quantity) == (6, 4)


def test_named_plates_and_fixed_rows(frame):
    mods = frame([("Saag Paneer", "Main", None), ("Saag Paneer", "Sauce", None), ("Bowl", "Main", None)], "item_name string, mod_type string, sub_category string")
    assert costing.plates_rule(mods).count() == 2
    assert len(fv.MIX_EXCLUSIONS) == 10


def test_ranks_of_close_and_special_values(spark):
    df = spark.range(20000).select((F.lit(10.0) + F.col("id") / 1e6).alias("v"))
    plan = shares.global_rank(df, "v")
    assert plan.filter(F.col("rank") != F.lit(20000) - F.round((F.col("v") - 10) * 1e6)).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (1.0,), (float("-inf"),), (None,)], "v double")
    assert sorted(r.rank for r in shares.global_rank(odd, "v").collect()) == [1, 2, 3, 3, 5, 6]
