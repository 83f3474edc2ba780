"""Whole runs: idempotence, late edits, reparse and stream against batch."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from menumix.operators import reports, upsert
from menumix.plans import star
from menumix.sources import documents
from menumix.streaming import ingest

DINING = [{"guid": "d1", "name": "Dine In"}, {"guid": "d2", "name": "Open App"}]


def order(guid, day, modified, price, dining="d1", voided=False, alt=None, name="Naan - Side"):
    return {"guid": guid, "businessDate": 20260300 + day, "modifiedDate": modified, "diningOption": {"guid": dining}, "checks": [{
        "guid": f"{guid}-c", "payments": [{"guid": f"{guid}-p", "type": "OTHER", "amount": price, "otherPayment": {"guid": alt}}],
        "selections": [{"guid": f"{guid}-s", "displayName": name, "price": price, "quantity": 1, "voided": voided,
                        "modifiers": [{"guid": f"{guid}-m", "displayName": "Basmati Rice"}, {"guid": f"{guid}-n", "displayName": "Napkins"}]}]}]}


def feed(spark, orders, location="L1"):
    return documents.order_feed(spark.createDataFrame([(location, json.dumps(o)) for o in orders], "location_code string, value string"))


@pytest.fixture(scope="module")
def config(spark):
    docs = [("L1", "dining_options", 1, json.dumps([{"guid": "d1", "name": "Stale"}])), ("L1", "dining_options", 2, json.dumps(DINING)),
            ("L1", "alt_payment_types", 1, json.dumps({"alternatePaymentTypes": [{"guid": "a1", "name": "DoorDash"}]})),
            ("L2", "menus", 1, "[]")]
    df = spark.createDataFrame(docs, "location_code string, config_type string, pull_run_id int, t string")
    return df.withColumn("payload", F.parse_json("t")).drop("t")


def run(raw, config, rules, tables=None, **options):
    return star.reparse(raw, config, rules, date(2026, 3, 1), date(2026, 3, 31), tables, **options)


COLUMNS = ["selection_guid", "canonical_name", "channel_code", "dining_option", "line_total", "is_voided", "pull_run_id"]


def test_first_run_and_skipped_location(spark, config, rules, rows):
    raw = feed(spark, [order("o1", 5, "2026-03-05T00:00:00", 3), order("o2", 6, "2026-03-06T00:00:00", 4, dining="d2"),
                       order("o3", 7, None, 5, dining="d2", alt="a1")]).unionByName(feed(spark, [order("o9", 5, None, 9)], "L2"))
    overrides = spark.createDataFrame([("o1", "CATERING")], "order_guid string, channel_code string")
    tables = run(raw, config, rules, overrides=overrides)
    assert rows(tables["fact_order_lines"], *COLUMNS[:4]) == [
        ("o1-s", "Naan", "CATERING", "Dine In"), ("o2-s", "Naan", "APP", "Open App"), ("o3-s", "Naan", "TPD", "Open App")]
    assert tables["fact_order_lines"].join(tables["dim_item"], "item_key", "left_anti").isEmpty()
    assert tables["fact_modifiers"].count() == 3  # blocklisted ones stay in staging
    assert rows(tables["fact_modifiers"].select("mod_type").distinct()) == [("base",)]
    checks = {r.check: r.value for r in reports.validate(tables["staging.order_lines"], tables["fact_order_lines"], tables["fact_modifiers"]).collect()}
    assert checks == {"staging lines": 3, "public lines": 3, "staging revenue (non-void)": 12, "orphan modifiers": 0, "lines missing channel": 0}
    assert reports.drift(tables["staging.order_lines"], tables["fact_order_lines"]).first().ok


def test_merging_twice_changes_nothing(spark, config, rules, rows):
    raw = feed(spark, [order("o1", 5, None, 3, voided=True), order("o2", 6, None, 4)])
    once = run(raw, config, rules)
    twice = run(raw, config, rules, once, repeatable=True)
    for name in ("fact_order_lines", "fact_modifiers", "fact_checks", "br_order_payment", "fact_adjustments", "dim_item", "dim_modifier"):
        assert rows(once[name]) == rows(twice[name]), name
    again = run(raw, config, rules, once)
    assert again["fact_adjustments"].count() == 2 * once["fact_adjustments"].count() == 2


def test_late_edit_updates_listed_columns_only(spark, config, rules):
    first = run(feed(spark, [order("o1", 5, None, 3)]), config, rules)
    edited = order("o1", 8, None, 7, dining="d2", voided=True, name="Roti")
    edited["checks"][0]["selections"][0]["quantity"] = 9
    line = run(feed(spark, [edited]), config, rules, first, run_id=2)["fact_order_lines"].first()
    assert (line.canonical_name, line.line_total, line.is_voided, line.channel_code) == ("Roti", 7, True, "APP")
    assert (line.quantity, line.business_date, line.pull_run_id) == (1, date(2026, 3, 5), 1)


def test_landing_ignores_older_versions(spark):
    raw = feed(spark, [order("o1", 5, "2026-03-07T00:00:00", 3)])
    older = feed(spark, [order("o1", 5, "2026-03-06T00:00:00", 99), order("o2", 5, "2026-03-06T00:00:00", 1)])
    merged = upsert.upsert_latest(raw, older)
    total = merged.select(F.expr("try_variant_get(payload, '$.checks[0].selections[0].price', 'int')").alias("p"), "order_guid")
    assert {r.order_guid: r.p for r in total.collect()} == {"o1": 3, "o2": 1}


def test_padded_window():
    assert ingest.padded_window(date(2026, 3, 10)) == (date(2026, 3, 8), date(2026, 3, 10))
    assert ingest.padded_window(date(2026, 3, 10), days=30)[0] == date(2026, 2, 8)
    with pytest.raises(ValueError, match="45 days"):
        ingest.padded_window(date(2026, 3, 10), start=date(2026, 1, 1))


VERSION = "order_guid string, modified_date int, payload string, arrival bigint"


def test_stream_equals_batch(spark, tmp_path, rows):
    versions = [("o1", 5, "a"), ("o2", 1, "b"), ("o1", 3, "stale"), ("o1", None, "reset"), ("o1", 1, "after"), ("o2", 1, "tie"), ("o3", None, "c")]
    log = spark.createDataFrame([(*v, i) for i, v in enumerate(versions)], VERSION)
    incoming, root, marks = (str(tmp_path / x) for x in ("in", "root", "marks"))
    for part in range(3):
        log.filter(F.col("arrival").between(part * 3, part * 3 + 2)).coalesce(1).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(VERSION).option("maxFilesPerTrigger", 1).parquet(incoming)
        ingest.ingest_stream(stream, root, marks).awaitTermination()
    got = rows(ingest.current_orders(spark, root, VERSION), "order_guid", "payload")
    assert got == rows(upsert.resolve_versions(log), "order_guid", "payload") == [("o1", "after"), ("o2", "tie"), ("o3", "c")]


def test_landing_a_batch_again_replaces_it(spark, tmp_path):
    batch = spark.createDataFrame([("o1", 1, "a", 0)], VERSION)
    for _ in range(2):
        ingest.land_batch(batch, 7, str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_one_scan_of_the_feed_for_all_staging_tables(spark, config, rules, tmp_path, monkeypatch):
    from menumix.operators import nested

    feed(spark, [order("o1", 5, None, 3, voided=True), order("o2", 6, None, 4)]).write.parquet(str(tmp_path / "feed"))
    raw = spark.read.parquet(str(tmp_path / "feed"))
    plans, tagged = [], nested.tagged_rows
    monkeypatch.setattr(nested, "tagged_rows", lambda orders: plans.append(tagged(orders)) or plans[-1])
    lookups = {**nested.build_lookups(documents.latest_config(config)), "names": rules["names"], "blocklist": rules["blocklist"]}
    parsed = nested.parse_orders(raw, lookups)
    (plan,) = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
    for name, rows in parsed.items():
        read = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "payload" not in read and "variant" not in read, name
    assert {name: rows.count() for name, rows in parsed.items()} == {"order_lines": 2, "modifiers": 4, "checks": 2, "payments": 2, "adjustments": 1}


def test_tables_parsed_at_once_equal_those_parsed_apart(spark, config, rules):
    from menumix.operators import nested

    odd = {"guid": "o3", "businessDate": 20260309, "checks": [
        {"guid": "c", "deleted": True, "payments": [{"guid": "p", "refund": {"refundAmount": 2}, "type": "CREDIT"}, {"refund": {}}], "selections": [
            {"voided": True, "modifiers": [{"guid": "a", "modifiers": [{"guid": "b", "voided": True, "modifiers": [{"quantity": 0, "modifiers": [{"guid": "d", "modifiers": [{"guid": "e"}]}]}]}]}]},
            {"guid": "s2", "item": {"name": "Plain"}, "quantity": None}]}, {"guid": "empty"}, "no check"]}
    raw = feed(spark, [order("o1", 5, None, 3, voided=True), odd, {"guid": "", "businessDate": 20260301}, {"guid": "o5", "businessDate": 0, "checks": [{}]}])
    lookups = {**nested.build_lookups(documents.latest_config(config)), "names": rules["names"], "blocklist": rules["blocklist"]}
    apart = {
        "order_lines": nested.explode_selections(raw, lookups), "modifiers": nested.walk_modifiers(raw, lookups), "checks": nested.explode_checks(raw),
        "payments": nested.explode_payments(raw, lookups["alt_pay"]), "adjustments": nested.extract_adjustments(raw, lookups["names"])}
    for name, rows in nested.parse_orders(raw, lookups).items():
        assert rows.columns == apart[name].columns
        assert sorted(map(str, rows.collect())) == sorted(map(str, apart[name].collect())), name
        assert rows.count() > 1
    empty = nested.parse_orders(raw.limit(0), lookups)
    assert [rows.count() for rows in empty.values()] == [0] * 5


def test_stored_merge_equals_the_merge_of_frames_and_leaves_other_days_alone(spark, config, rules, rows, tmp_path):
    root, lookups = str(tmp_path / "star"), star.ready_lookups(config, rules)
    first = feed(spark, [order("o1", 5, None, 3, voided=True), order("o2", 6, None, 4, alt="a1")])
    edited = order("o1", 8, None, 7, dining="d2", name="Roti")  # claims another day; its facts stay on the first one
    second = feed(spark, [edited, order("o3", 9, None, 5, voided=True)])
    frames = run(second, config, rules, run(first, config, rules), repeatable=True, run_id=2)
    star.merge_stored(spark, star.stage_ready(first, lookups), root, rules["tags"], 1)
    day = tmp_path / "star" / "fact_order_lines" / "business_date=2026-03-06"
    kept = sorted(p.name for p in day.iterdir())
    staged = star.stage_ready(second, lookups)
    for _ in range(2):  # a run that failed is repeated
        star.merge_stored(spark, staged, root, rules["tags"], 2)
        for name, table in star.stored_tables(spark, root).items():
            assert rows(table.select(sorted(table.columns))) == rows(frames[name].select(sorted(table.columns))), name
    assert kept == sorted(p.name for p in day.iterdir())
    index = spark.read.parquet(f"{root}/fact_order_lines.keys")
    assert index.count() == index.select("key_hash").distinct().count() == 3


def test_index_names_the_partitions_of_a_batch_without_the_table(spark, frame, tmp_path):
    from menumix.sources import files

    path, merge = str(tmp_path / "t"), lambda old, new: upsert.upsert(old, new, ["k"], update=["v"])
    for n in range(3):
        batch = frame([(f"k{i}", n, f"p{(i + n) % 5}") for i in range(n * 20, n * 20 + 40)], "k string, v int, p string")
        files.merge_into(spark, path, batch, ["k"], merge, "p", run=n)
    found = files.indexed_partitions(spark, path, frame([("k25",), ("unseen",)], "k string"), ["k"], "p")
    assert [r.p for r in found.collect()] == ["p0"]
    assert "t/p=" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.v, r.p) for r in spark.read.parquet(path).collect()}
    assert len(got) == 80 and got["k25"] == (1, "p0") and got["k0"] == (0, "p0") and got["k79"] == (2, "p1")


ORDER = "order_guid string, modified_date int, payload string, arrival bigint"


def test_batches_reach_the_merge_once_and_in_order(spark, tmp_path, rows):
    log = [[("o1", 5, "a", 0), ("o2", 1, "b", 1), ("o2", 2, "b2", 2)], [("o1", 3, "stale", 3), ("o3", None, "c", 4)],
           [("o1", None, "reset", 5), ("o3", 1, "after null", 6)], [("o1", 1, "low", 7), ("o2", 2, "tie", 8), ("o2", 1, "stale", 9)]]
    root, seen = str(tmp_path / "landed"), []

    def merge(orders, batch_id):
        seen.append((batch_id, sorted(r.payload for r in orders.collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    def put(n):
        ingest.merge_batch(spark.createDataFrame(log[n], ORDER), n, root, ORDER, merge, fold_every=3)

    put(0)
    with pytest.raises(RuntimeError, match="lost"):
        put(1)
    for n in (1, 1, 0, 2, 2, 3, 3):  # a failed batch is repeated, one that is through changes nothing
        put(n)
    assert seen == [(0, ["a", "b2"]), (1, ["c"]), (1, ["c"]), (2, ["after null", "reset"]), (3, ["low", "tie"])]
    assert [p.name for p in (tmp_path / "landed.current").iterdir()] == ["upto=2"]
    assert rows(ingest.current_orders(spark, root, ORDER), "order_guid", "payload") == [("o1", "low"), ("o2", "tie"), ("o3", "after null")]
