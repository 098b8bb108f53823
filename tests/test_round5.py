"""What the archive, its replay, the lake and the contract state leave on disk."""

import glob
import os
import time

import pyarrow.parquet as pq
import pytest

from ledgerlake.session import scratch_root
from ledgerlake.sources import fixtures as fx
from ledgerlake.sources import writer as W

ORDERS = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp, o_orderpriority string")
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
         "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of days in both schema versions, one without a customer, lines of which some repeat."""
    from datetime import datetime
    at = str(tmp_path_factory.mktemp("tables"))
    day = [datetime(1997, 12, 30, 5), datetime(1998, 1, 2), datetime(2000, 1, 3, 23)]
    orders = [(k, None if k == 5 else k % 7, "FOP"[k % 3], 13.5 * k, day[k % 3], "3-MEDIUM") for k in range(1, 60)]
    lines = [(k, k % 11, k % 5, n, float(k % 40), 7.25 * k, "RAN"[k % 3], "OF"[k % 2], day[0])
             for k in range(1, 64) for n in (1, 2, 2)]
    for name, rows, ddl in (("orders", orders, ORDERS), ("lineitem", lines, LINES),
                            ("customer", [(k, "AUTO") for k in range(7)], "c_custkey long, c_mktsegment string"),
                            ("part", [(k,) for k in range(1, 12)], "p_partkey long")):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def _shuffle_files(spark) -> set[str]:
    """Files of shuffles in the session's own folders."""
    made = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (made.apply(i).getName() for i in range(made.size())) if n.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that came after ``before`` and stay (they are removed in the background)."""
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def _scratch(spark) -> str:
    return scratch_root(spark).removeprefix("file:")


def _checkpointed(spark) -> set[str]:
    """Files of checkpoints."""
    top = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    return set(glob.glob(f"{top}/rdd-*/part-*"))


def _codecs(files) -> set[str]:
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files]
    return {g.column(i).compression for g in groups for i in range(g.num_columns)}


def _rows(df) -> list[str]:
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def test_archive_leaves_no_shuffle_files(spark, tables, scratch):
    """shuffle files go with each kind, and daily files are as small as the format's."""
    frames = {k: fx.raw_by_day(spark, tables, k) for k in W.KINDS}
    lookups = {"function_selectors": fx.candidates(spark, tables, "selector")}
    before = _shuffle_files(spark)
    doc = W.write_archive(spark, frames, scratch, lookups, rule=W.two_versions, dealt=True)
    assert not _left(spark, before)
    assert len(doc["files"]) == 9 and [e["kind"] for e in doc["files"][:3]] == list(W.KINDS)
    assert _codecs(f"{scratch}/{e['key']}" for e in doc["files"]) == {"ZSTD"}


def test_replay_keeps_one_copy(spark, tables):
    """the sink is the result; neither the mirror nor a checkpoint of its rows stays."""
    from ledgerlake.plans.registry import QUERIES
    before = set(os.listdir(_scratch(spark)))
    out = QUERIES["h4_replay_txs"](spark, tables)
    want = fx.decoded(spark, tables, "txs")
    assert sorted(out.columns) == sorted(want.columns) and _rows(out) == _rows(want)
    assert "LogicalRDD" not in out._jdf.queryExecution().optimizedPlan().toString()
    new = set(os.listdir(_scratch(spark))) - before
    assert not [n for n in new if n.startswith("mirror")]
    (run,) = [n for n in new if n.startswith("replay")]
    assert os.listdir(f"{_scratch(spark)}/{run}") == ["sink"]
    assert _codecs(glob.glob(f"{_scratch(spark)}/{run}/sink/date=*/*.parquet")) == {"ZSTD"}


def test_lake_is_as_small_as_the_archive(spark, tables):
    """the decoded rows of the lake are compressed as the day files are."""
    from ledgerlake.plans.registry import QUERIES
    out = QUERIES["h1_ingest_events"](spark, tables)
    want = fx.decoded(spark, tables, "events")
    assert sorted(out.columns) == sorted(want.columns)
    assert _codecs(f.removeprefix("file://") for f in out.inputFiles()) == {"ZSTD"}
    assert _rows(out) == _rows(want)


def test_packed_hashes_are_told_apart_and_come_back(spark):
    """hex is packed, any other text goes as it is, null stays null."""
    from ledgerlake.operators.contract import _packed, _unpacked
    texts = [None, "", "0x", "0X", "0xab", "0xAB", "0xabc", "0x0abc", "0xzz", "ab", "\x01\xab", "0xab\n", " 0xab",
             "0x" + "0f" * 32, "0x" + "0F" * 32]
    df = spark.createDataFrame([(x,) for x in texts], "t string").select("t", _packed("t").alias("p"))
    rows = df.select("t", "p", _unpacked("p").alias("u")).collect()
    assert [r["u"] for r in rows] == texts
    assert len({None if r["p"] is None else bytes(r["p"]) for r in rows}) == len(texts)
    assert {len(r["p"]) for r in rows if r["t"] and len(r["t"]) == 66} == {33, 67}


def test_contract_state_leaves_its_summaries_alone(spark, scratch):
    """neither shuffles nor the keys of an update stay, and the rules hold for odd hashes."""
    from ledgerlake.operators.contract import ContractState, contract_checks
    from ledgerlake.sources.archive import Archive
    from ledgerlake.streaming import ingest as H
    good, big = "0x" + "0f" * 32, "0x" + "0F" * 32
    blocks = [("2020-01-01", 1), ("2020-01-02", 2), ("2020-01-02", 3)]
    txs = [("2020-01-01", 1, h) for h in (good, big, "odd", None)] + [("2020-01-02", 2, "0xab"), ("2020-01-02", 9, "")]
    events = [("2020-01-01", 1, good, "0x0"), ("2020-01-01", 1, good, "0x0"), ("2020-01-01", 1, big, "0x1"),
              ("2020-01-02", 2, big, "0x0"), ("2020-01-02", 2, "odd", "0x1"), ("2020-01-02", 3, "", None),
              ("2020-01-02", 3, "0xAB", "0x2"), ("2020-01-02", 7, "0xab", "0x3"), ("2020-01-02", 2, None, "0x4")]
    frames = {"blocks": spark.createDataFrame(blocks, "date string, number long"),
              "txs": spark.createDataFrame(txs, "date string, block_number long, tx_hash string"),
              "events": spark.createDataFrame(events, "date string, block_number long, tx_hash string, log_index string")}
    W.write_archive(spark, frames, f"{scratch}/a")
    a, lake = Archive(spark, f"{scratch}/a"), f"{scratch}/lake"
    for end in ("2020-01-01", None):
        H.ingest(spark, a, lake, end=end)
        before, kept = _shuffle_files(spark), _checkpointed(spark)
        assert ContractState(spark, lake).update()
        assert not _left(spark, before)
        new = _checkpointed(spark) - kept
        assert new and not any(good.encode() in open(f, "rb").read() for f in new)
    assert sorted(os.listdir(f"{lake}/_contract")) == ["blocks", "days", "events", "pairs", "txs"]
    full = contract_checks(*(H.read_lake(spark, lake, k) for k in ("blocks", "txs", "events")))
    want = {r["check"]: (r["violations"], r["example"]) for r in full.collect()}
    assert {r["check"]: (r["violations"], r["example"]) for r in ContractState(spark, lake).report().collect()} == want
    assert want["event_block_mismatch"] == (4, "")
