"""Large jobs are done part by part, and what nothing reads any more goes."""

from collections import Counter
from pathlib import Path

from test_round3 import tables  # noqa: F401
from test_runs import config, feed, order  # noqa: F401

from menumix import session
from menumix.operators.upsert import upsert
from menumix.plans import driver_tables, registry, source_queries, star
from menumix.sources import files
from menumix.sources.documents import order_feed


def local_files(spark):
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for place in store.localDirsString() for f in Path(place).glob("*/shuffle_*.data")}


def scratch(spark, name):
    return set(Path(session.shared_folder(spark)).glob(f"menumix/{name}-*"))


def test_files_of_a_shuffle_go_with_their_query(spark):
    session.tune(spark)
    before = local_files(spark)
    session.materialise(spark.range(1000).repartition(7, "id").groupBy("id").count(), "shuffled")
    assert local_files(spark) <= before


def test_documents_in_parts_equal_those_at_once(spark, tables, monkeypatch, tmp_path):  # noqa: F811
    whole = Counter((r.location_code, r.value) for r in driver_tables.order_documents(spark, tables).collect())
    monkeypatch.setattr(session, "PART_BYTES", session.stored_bytes(spark, f"{tables}/lineitem.parquet") // 3 + 1)
    parts = [Counter((r.location_code, r.value) for r in part.collect()) for part in driver_tables.document_parts(spark, tables)]
    assert len(parts) > 1 and sum(map(bool, parts)) > 1 and sum(parts, Counter()) == whole
    driver_tables._LANDED.clear()
    landed = driver_tables.landed_orders(spark, tables)
    at_once = order_feed(driver_tables.order_documents(spark, tables))
    columns = ["location_code", "order_guid", "business_date", "modified_date", "to_json(payload)"]
    assert Counter(landed.selectExpr(*columns).collect()) == Counter(at_once.selectExpr(*columns).collect())
    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert registry.QUERIES["a1_read_orders"](spark, tables).count() == 400
    driver_tables._LANDED.clear()


def test_merges_in_parts_equal_those_at_once_and_leave_nothing_behind(spark, frame, tmp_path, rows, monkeypatch):
    schema = "k string, v int, p string"
    old = [(f"k{i}", i, f"p{i % 3}") for i in range(40)] + [(None, 7, "p0"), ("left", 1, None)]
    new = [(f"k{i}", 100 + i, "p1") for i in range(0, 40, 3)] + [("n", 1, "p9"), (None, 8, "p1")]

    def merged(name, run):
        path = str(tmp_path / f"{name}-{run}")
        for number, batch in enumerate([old, new]):
            if run is None and not number:
                files.write_table(frame(batch, schema), path, "p")
            else:
                files.merge_into(spark, path, frame(batch, schema), ["k"], lambda a, b: upsert(a, b, ["k"], update=["v", "p"]), "p", run=run and number)
        assert not Path(f"{path}.merged").exists()
        return rows(spark.read.schema(schema).parquet(path))

    before = scratch(spark, "batch")
    at_once = {run: merged("once", run) for run in (None, True)}
    monkeypatch.setattr(session, "PART_BYTES", 2000)
    assert {run: merged("parts", run) for run in (None, True)} == at_once
    assert len(at_once[None]) == 44 and scratch(spark, "batch") == before


def test_staging_in_parts_equals_staging_at_once_and_merged_tables_go(spark, config, rules, rows, tmp_path, monkeypatch):  # noqa: F811
    raw = feed(spark, [order(f"o{i}", 5 + i % 9, None, 3 + i, voided=i % 2 == 0) for i in range(12)] + [order("o1", 5, None, 99)])
    lookups, parsed = star.ready_lookups(config, rules), scratch(spark, "parsed")
    at_once = star.stage_ready(raw, lookups)
    monkeypatch.setattr(session, "PART_BYTES", 4000)
    staged = star.stage_ready(raw, lookups)
    assert scratch(spark, "parsed") == parsed
    monkeypatch.undo()
    for name, table in staged.items():
        assert rows(table) == rows(at_once[name]), name
    places = [Path(table.__dict__["_scratch"]) for table in staged.values()]
    for name, tables, last in (("kept", at_once, False), ("gone", staged, True)):
        star.merge_stored(spark, tables, str(tmp_path / name), rules["tags"], 1, last=last)
    assert not any(place.exists() for place in places) and at_once["checks"].count() == staged_count(spark, tmp_path)
    kept, gone = (star.stored_tables(spark, str(tmp_path / name)) for name in ("kept", "gone"))
    for name, table in kept.items():
        assert rows(table) == rows(gone[name]), name


def staged_count(spark, root):
    return spark.read.parquet(str(root / "gone" / "fact_checks")).count()
