"""Name cleaning and rule tables."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from menumix.functions import scalars as sc
from menumix.operators import clean
from menumix.sources import files

GOLDEN = [
    ("Grain Bowl - Club Feast - Gameday", "Grain Bowl"),  # stacked suffix, then mapping
    ("grain  bowl", "Grain Bowl"),  # mapping ignores case, spaces collapse
    ("Spindrift - Lemon", "Spindrift - Lemon"),  # a generic dash stays
    ("Olipop - Cola - IN HOUSE", "Olipop - Cola"),
    ("Hot Sauce - Side", "Hot Sauce"),  # mapped before the suffix goes
    ("Burrito - ezcater", "BYO Indian Burrito"),  # mapped after the suffix went
    ("  Samosa  \t Chaat  ", "Samosa Chaat"),
    ("Chefâ€™s Bowl", "Chef's Bowl"),
    ("CafÃ© â€œXâ€\u009d", 'Café "X"'),
    ("Café", "Café"),
    ("Additonal", "Additional"),
    ("Naan-in-house", "Naan"),
    ("Sideways - Sidecar", "Sideways - Sidecar"),
    ("", ""),
    ("   ", ""),
    (None, ""),
]


def test_golden_names(frame, rules):
    df = frame([(i, raw) for i, (raw, _) in enumerate(GOLDEN)], "i int, raw string")
    got = {r.i: r.clean_name for r in clean.clean_names(df, "raw", rules["names"]).collect()}
    assert got == {i: want for i, (_, want) in enumerate(GOLDEN)}


def test_cleaning_keeps_every_row(frame, rules):
    df = frame([("Naan",)] * 50 + [("x - Side",)] * 50, "raw string")
    out = clean.clean_names(df, "raw", rules["names"])
    assert out.count() == 100
    assert {r.clean_name for r in out.collect()} == {"Naan", "x"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aé éññ-Å̊", max_size=12), min_size=1, max_size=20))
def test_nfc_matches_the_standard_library(spark, texts):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string")
    got = {r.i: r.s for r in df.select("i", sc.repair_encoding(F.col("s")).alias("s")).collect()}
    assert got == {i: unicodedata.normalize("NFC", x) for i, x in enumerate(texts)}


def test_flags_tags_and_exclusions(frame, rules, rows):
    df = frame([("Napkins",), (" napkins ",), ("Basmati Rice",), ("Gift Card",), ("Other",)], "name string")
    assert rows(clean.flag_blocklisted(df, "name", rules["blocklist"])) == [
        (" napkins ", True), ("Basmati Rice", False), ("Gift Card", False), ("Napkins", True), ("Other", False)]
    tagged = {r.name: r.mod_type for r in clean.tag_modifier_type(df, "name", rules["tags"]).collect()}
    assert tagged["Basmati Rice"] == "base" and tagged["Other"] is None
    left = {r.name for r in clean.exclude_from_mix(df, "name", rules["mix_exclusions"]).collect()}
    assert left == {"Napkins", " napkins ", "Basmati Rice", "Other"}


def test_rule_file_last_duplicate_wins(spark, tmp_path, rows):
    path = tmp_path / "names.csv"
    path.write_text('raw_name,canonical_name\n A ,first\nb,\n,nothing\n"C, d",kept\na,second\n', encoding="utf-8")
    assert rows(files.read_rules(spark, str(path), "raw_name", "canonical_name")) == [("a", "second"), ("c, d", "kept")]


def test_scalar_rules(frame, rows):
    df = frame([("", "L1", "Raw"), ("g", "L1", "Raw"), (None, "L2", "Raw")], "g string, l string, r string")
    keys = df.select(sc.natural_key(F.col("g"), F.col("l"), F.col("r")).alias("k"))
    assert rows(keys) == [("L1::Raw",), ("L2::Raw",), ("g",)]
    labels = frame([("P03-2026",), ("P5 2026",), ("Other",), (None,)], "p string")
    assert rows(labels.select(sc.period_key(F.col("p")).alias("k"))) == [(None,), (None,), (202603,), (202605,)]
    dates = frame([(20260229,), (20260301,), (0,), (None,)], "d int")
    assert [str(r[0]) for r in dates.select(sc.to_business_date(F.col("d"))).collect()] == ["None", "2026-03-01", "None", "None"]


@pytest.mark.parametrize("label, want", [("bases", "Base"), ("Extra Mains", "Extra Main"), ("Sweets", "Make it a Meal"),
                                         ("chutney", "Chutney and Dressings"), ("Unknown", "Unknown")])
def test_modifier_type_names(frame, label, want):
    df = frame([(label,)], "t string")
    assert df.select(sc.normalise_modifier_type(F.col("t"))).first()[0] == want
