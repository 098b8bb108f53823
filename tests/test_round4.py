"""Shuffles of the daily writer and of ingest; joins beyond the broadcast limit."""

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import fixtures as fx
from ledgerlake.sources import writer as W

ORDERS = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp, o_orderpriority string")
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
         "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of a few days, one without a customer, lines of which some repeat."""
    from datetime import datetime
    at = str(tmp_path_factory.mktemp("tables"))
    day = [datetime(1997, 12, 30, 5), datetime(1998, 1, 2), datetime(1998, 1, 3, 23)]
    orders = [(k, None if k == 5 else k % 7, "FOP"[k % 3], 13.5 * k, day[k % 3], "3-MEDIUM") for k in range(1, 60)]
    lines = [(k, k % 11, k % 5, n, float(k % 40), 7.25 * k, "RAN"[k % 3], "OF"[k % 2], day[0])
             for k in range(1, 64) for n in (1, 2, 2)]
    spark.createDataFrame(orders, ORDERS).coalesce(1).write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines, LINES).coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.mark.parametrize("kind", ["blocks", "txs", "events"])
def test_rows_dealt_by_day_are_the_view(spark, tables, kind):
    want, got = fx.raw(spark, tables, kind), fx.raw_by_day(spark, tables, kind)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    dealt = {(r[0], r[1]) for r in got.select("date", F.spark_partition_id()).collect()}
    assert len(dealt) == len({d for d, _ in dealt})


@pytest.mark.parametrize("kind", ["txs", "events"])
def test_hashes_are_not_shuffled_or_sorted(spark, tables, kind):
    """The hashes of a row come after its only way by day."""
    plan = fx.raw_by_day(spark, tables, kind)._jdf.queryExecution().executedPlan().toString().split("\n")
    hashed = [i for i, line in enumerate(plan) if "sha2(" in line]
    moved = [i for i, line in enumerate(plan) if re.search(r"Exchange|\bSort \[", line)]
    assert hashed and moved and max(hashed) < min(moved)


def test_tasks_by_day_follow_the_bytes(spark, tables, monkeypatch):
    df = spark.read.parquet(f"{tables}/lineitem.parquet")
    assert W.day_tasks(df) == 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(W, "TASK_INPUT", 16)
    assert W.day_tasks(df) > 2 * spark.sparkContext.defaultParallelism


def test_day_files_sorted_null_first(spark, scratch):
    """A day's file has its rows in the natural order; extra columns and nulls stay."""
    rows = [("2025-01-02", 2, "0xb", "y"), ("2025-01-01", None, "0xa", None), ("2025-01-02", 1, "0xc", "x"),
            ("2025-01-02", 2, None, "z"), ("2025-01-01", 3, "0xa", "w")]
    df = spark.createDataFrame(rows, "date string, block_number long, tx_hash string, note string")
    found = {r["date"]: r for r in W.write_days(df, scratch, "txs").collect()}
    assert sorted(found) == ["2025-01-01", "2025-01-02"]
    t = pq.read_table(os.path.join(scratch, found["2025-01-02"]["key"]))
    assert t.column_names == ["block_number", "tx_hash", "note"]
    assert list(zip(*t.to_pydict().values())) == [(1, "0xc", "x"), (2, None, "z"), (2, "0xb", "y")]
    t = pq.read_table(os.path.join(scratch, found["2025-01-01"]["key"]))
    assert t["block_number"].to_pylist() == [None, 3]


def test_days_without_rows_are_told_by_footers(spark, scratch, monkeypatch):
    """a rebuilt day without rows loses its folder, and no row is read again for it."""
    import json

    from conftest import DAY, DAY2, N_TXS, day_table, make_archive, parquet_bytes, put
    from ledgerlake.sources.archive import Archive
    from ledgerlake.streaming import ingest as H
    root, lake = os.path.join(scratch, "a"), os.path.join(scratch, "lake")
    doc = make_archive(root, days=(DAY, DAY2))
    H.ingest(spark, Archive(spark, root), lake, kinds=("txs",))
    e = put(root, f"daily/{DAY2}.txs.parquet", parquet_bytes(day_table("txs").slice(0, 0)))
    for f in doc["files"]:
        if f["date"] == DAY2 and f["kind"] == "txs":
            f.update(size=e["size"], md5=e["md5"])
    with open(os.path.join(root, "manifest.json"), "w") as fh:
        json.dump(doc, fh)
    frames = []
    entries = Archive.read_entries
    monkeypatch.setattr(Archive, "read_entries", lambda self, *a, **k: frames.append(entries(self, *a, **k)) or frames[-1])
    asked = []
    distinct = type(spark.range(1)).distinct
    monkeypatch.setattr(type(spark.range(1)), "distinct", lambda df: asked.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or distinct(df))
    assert [x["date"] for x in H.ingest(spark, Archive(spark, root), lake, kinds=("txs",))] == [DAY2]
    assert frames and not any("_metadata" in p or "Relation" in p and "tx_hash" in p for p in asked)
    assert H.read_lake(spark, lake, "txs").groupBy("date").count().collect()[0]["count"] == N_TXS
    assert not os.path.exists(os.path.join(lake, "txs", f"date={DAY2}"))


def test_keys_of_a_split_join_are_counted_once(spark, monkeypatch):
    """one pass over the big side tells the keys in use and the frequent ones, and
    the split evaluates the key once."""
    from ledgerlake.plans import joins as J
    rows = [(i, k) for i, k in enumerate(["hot"] * 900 + [None, ""] * 200 + [f"k{i}" for i in range(90)])]
    big = spark.createDataFrame(rows, "id long, k string").repartition(4)
    table = spark.createDataFrame([("hot", "h")] + [(f"k{i}", f"s{i}") for i in range(0, 500, 2)], "_lk string, s string")
    counted = []
    counts = J.key_counts
    monkeypatch.setattr(J, "key_counts", lambda *a: counted.append(1) or counts(*a))
    out = J.left_join_keyed(big, F.sha2("k", 256), table.withColumn("_lk", F.sha2("_lk", 256)), ("",), limit=0)
    assert len(counted) == 1
    names = {r[0]: r[1] for r in table.collect()}
    assert {(r["id"], r["s"]) for r in out.collect()} == {(i, names.get(k)) for i, k in rows}
    filters = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "coalesce(" in line]
    assert len(filters) == 2 and all(line.count("sha2(") == 1 for line in filters)
