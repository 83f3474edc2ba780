"""Feed, runs and stored merges on small tables of their own: what is written, shuffled and read."""

from datetime import datetime
from pathlib import Path

import pytest

from menumix.plans import driver_tables, registry

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """400 lines of 100 orders: every return flag, voids, lines without guid, several years."""
    root, rows = str(tmp_path_factory.mktemp("tables")), {}
    rows["region"] = [(i, name) for i, name in enumerate(REGIONS)], "r_regionkey int, r_name string"
    rows["nation"] = [(i, f"N{i}", i % 5) for i in range(10)], "n_nationkey int, n_name string, n_regionkey int"
    rows["customer"] = [(i, f"C{i}", i % 10, 1.5, ["AUTOMOBILE", "FURNITURE", "MACHINERY"][i % 3]) for i in range(20)], (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    rows["part"] = [(i, f"part {i % 7}", f"Brand#{i % 4}", ["TEA", "PROMO"][i % 4 % 2], i % 50, 2.5) for i in range(50)], (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    rows["orders"] = [(i, i % 20, "FOP"[i % 3], 9.5, datetime(1996 + i % 5, 1 + i % 12, 1 + i % 28), f"{i % 5 + 1}-X") for i in range(100)], (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    rows["lineitem"] = [
        (i % 100, i % 50, i % 9, i // 100 + 1 + i % 4, float(i % 11), 10.25 + i, i % 12 / 100, i % 9 / 100, "ARN"[i % 3], "OF"[i % 2], datetime(1999, 1 + i % 12, 1))
        for i in range(400)], (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_documents_are_written_compressed(spark, tables, monkeypatch, tmp_path):
    from menumix.plans import source_queries

    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = registry.QUERIES["a1_read_orders"](spark, tables).collect()
    texts = [r.value for r in driver_tables.order_documents(spark, tables).collect()]
    files = list(Path(tmp_path / "orders").glob("location_code=*/part-*"))
    assert len(got) == len(texts) == 400 and sum(r.order_guid is None for r in got) == 12
    assert files and all(f.suffix == ".gz" for f in files)
    assert sum(f.stat().st_size for f in files) < sum(map(len, texts)) / 4


def test_only_bare_lines_are_spread(spark, tables):
    """Lines are spread before the joins, so that names and order columns do not travel once more."""
    plan = driver_tables.order_documents(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):].split("Join")[0]
    assert "p_name" not in below and "o_orderpriority" not in below and plan.index("Join") < plan.index("RepartitionByExpression")


def test_landed_documents_have_no_inferred_columns(spark, tables):
    """Whole documents are read back, so none is taken apart when it is written."""
    driver_tables._LANDED.clear()
    path = driver_tables.landed_orders(spark, tables).inputFiles()[0]
    reader = spark.sparkContext._jvm.org.apache.parquet.hadoop.ParquetFileReader
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert "typed_value" not in reader.readFooter(spark._jsc.hadoopConfiguration(), place).getFileMetaData().getSchema().toString()


def test_adjustments_come_from_one_pass(spark, tables):
    got = registry.QUERIES["b5_extract_adjustments"](spark, tables)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert {r.kind for r in got.collect()} == {"VOID", "REFUND"}


def test_menus_are_spread_however_few_files_there_are(spark, tables):
    plan = driver_tables.menu_documents(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "parse_json" not in plan[plan.index("RepartitionByExpression"):]


def test_large_shuffles_start_with_more_partitions_than_the_session_names(spark, tables):
    """A task's share of a merge stays small when a session names few partitions; small ones are joined again."""
    rows = driver_tables.table(spark, tables, "lineitem").groupBy("l_orderkey").count()
    assert "480" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.rdd.getNumPartitions() < 10


def test_the_feed_parts_are_written_by_several_tasks(spark, tables, monkeypatch):
    from menumix.plans import run_queries
    from menumix.session import scratch_path

    seen = {}
    monkeypatch.setattr(run_queries, "scratch_path", lambda spark, name: seen.setdefault(name, scratch_path(spark, name)))
    monkeypatch.setattr(run_queries.star, "merge_stored", lambda *args, **options: None)  # only the feed is looked at
    monkeypatch.setattr(run_queries.star, "stage_ready", lambda orders, lookups: orders)
    monkeypatch.setattr(run_queries.star, "stored_tables", lambda spark, root: {"fact_order_lines": spark.range(1).selectExpr(*[f"id AS {c}" for c in run_queries.FACT_COLUMNS])})
    run_queries.stream_to_star(spark, tables)
    assert len(spark.read.parquet(seen["arriving"]).inputFiles()) > 2
    assert [int(p.name.split("=")[1]) for p in sorted(Path(seen["landed"] + ".ledger").glob("batch=*"))] == [0, 1]


def test_parsed_rows_are_written_with_zstd(spark, tables, monkeypatch, tmp_path):
    from menumix.operators import nested

    monkeypatch.setattr(nested, "scratch_path", lambda spark, name: str(tmp_path / name))
    lookups = {**nested.build_lookups(driver_tables.config_documents(spark, tables)), "names": spark.range(0).selectExpr("'' AS key", "'' AS value"),
               "blocklist": spark.range(0).selectExpr("'' AS key", "'' AS value")}
    parsed = nested.parse_orders(driver_tables.landed_orders(spark, tables), lookups)
    assert parsed["order_lines"].count() > 0
    files = [p.name for p in (tmp_path / "parsed").glob("tag=*/part-*")]
    assert files and all(".zstd." in name for name in files)
