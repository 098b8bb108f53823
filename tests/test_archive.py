import json
import os
import warnings
from datetime import date
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import DAY, N_BLOCKS, N_EVENTS, N_TXS, TX_HASHES, day_table, make_archive, parquet_bytes, put
from ledgerlake.operators import catalog as A
from ledgerlake.sources import manifest as M
from ledgerlake.sources.archive import Archive


def test_manifest_tables(spark, day_archive):
    m = M.read_manifest(spark, day_archive)
    h = M.check_chain(m)
    assert h["chain_id"] == 43114 and h["latest_complete_date"] == DAY
    files = M.files_table(m).orderBy("pos").collect()
    assert [r["kind"] for r in files] == ["blocks", "txs", "events"]
    assert [r["pos"] for r in files] == [0, 1, 2]
    lk = {r["name"]: r["key"] for r in M.lookups_table(m).collect()}
    assert lk["function_selectors"] == "lookups/function_selectors.json"
    cols = M.columns_table(m).filter("kind = 'blocks'").orderBy("position").collect()
    assert cols[0]["column"] == "number"


def test_manifest_defaults_and_chain(spark, scratch):
    p = os.path.join(scratch, "manifest.json")
    with open(p, "w") as f:
        json.dump({"chain_id": 1, "generated_at": "x", "schema_version": "v2"}, f)
    m = M.read_manifest(spark, scratch)
    assert M.files_table(m).count() == 0 and M.lookups_table(m).count() == 0
    with pytest.raises(ValueError):
        M.check_chain(m)
    with pytest.raises(ValueError):
        Archive(spark, scratch)


def test_load_day_decoded_and_raw(spark, day_archive):
    a = Archive(spark, day_archive)
    b = a.load_day(DAY, "blocks").orderBy("number").collect()
    assert [r["base_fee_per_gas"] for r in b] == [Decimal(7), Decimal(469), None, Decimal(7 * 67 ** 3)]
    t = a.load_day(DAY, "txs").orderBy("tx_hash").collect()
    assert [r["value"] for r in t] == [Decimal(0), Decimal(3_500_000_000_000_007), Decimal(77)]
    e = a.load_day(DAY, "events").collect()
    assert sorted(r["log_index"] for r in e) == [0, 0, 0, 1, 1]
    raw = a.load_day(DAY, "txs", decode=False).orderBy("tx_hash").collect()
    assert raw[1]["value"] == "0xc6f3b40b6c007"


def test_missing_day_and_bad_kind(spark, day_archive):
    a = Archive(spark, day_archive)
    with pytest.raises(FileNotFoundError, match=DAY):
        a.load_day("1999-01-01", "txs")
    with pytest.raises(ValueError, match="unknown kind"):
        a.load_day(DAY, "block")
    with pytest.raises(ValueError, match="unknown kind"):
        a.available_dates("txn")


def test_range_gaps_empty_and_order(spark, day_archive):
    a = Archive(spark, day_archive)
    assert a.load_range("2025-11-06", "2025-11-08", "blocks").count() == N_BLOCKS
    with pytest.raises(FileNotFoundError):
        a.load_range("1999-01-01", "1999-01-03", "blocks")
    with pytest.raises(ValueError):
        a.load_range("2025-11-08", "2025-11-06", "blocks")
    assert a.available_dates("txs") == [date(2025, 11, 7)]
    assert a.latest_complete_date() == date(2025, 11, 7)
    assert a.url_for(DAY, "txs") == f"{day_archive}/daily/{DAY}.txs.parquet"


def test_schema_versions_warn_and_union(spark, scratch):
    root = os.path.join(scratch, "drift")
    make_archive(root, days=("2025-11-07", "2025-11-08"),
                 versions={"2025-11-08": "v3"})
    a = Archive(spark, root)
    with pytest.warns(UserWarning, match="multiple schema versions"):
        df = a.load_range("2025-11-07", "2025-11-08", "blocks")
    assert df.count() == 2 * N_BLOCKS
    days = sorted(r[0] for r in df.select("date").distinct().collect())
    assert days == [date(2025, 11, 7), date(2025, 11, 8)]


def test_schema_drift_extra_column_and_type_clash(spark, scratch):
    root = os.path.join(scratch, "drift2")
    t2 = day_table("blocks").append_column("extra", pa.array(list("abcd")))
    e = put(root, "daily/2025-11-08.blocks.parquet", parquet_bytes(t2))
    e.update(date="2025-11-08", kind="blocks", schema_version="v3")
    make_archive(root, days=("2025-11-07",), extra_files=[e])
    a = Archive(spark, root)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = a.load_range("2025-11-07", "2025-11-08", "blocks")
    by_day = {r["date"].isoformat(): r["n"] for r in
              df.groupBy("date").agg(F.count("extra").alias("n")).collect()}
    assert by_day == {"2025-11-07": 0, "2025-11-08": N_BLOCKS}
    # A type clash is refused instead of silently cast.
    root3 = os.path.join(scratch, "clash")
    t3 = day_table("blocks").set_column(1, "timestamp", pa.array(list("abcd")))
    e3 = put(root3, "daily/2025-11-08.blocks.parquet", parquet_bytes(t3))
    e3.update(date="2025-11-08", kind="blocks", schema_version="v3")
    make_archive(root3, days=("2025-11-07",), extra_files=[e3])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        with pytest.raises(TypeError, match="timestamp"):
            Archive(spark, root3).load_range("2025-11-07", "2025-11-08", "blocks")


def test_projection_only_named_columns(spark, day_archive):
    a = Archive(spark, day_archive)
    df = a.rows(DAY, "events", ["tx_hash", "log_index"])
    assert df.columns == ["tx_hash", "log_index"]
    assert sorted(r["log_index"] for r in df.collect()) == [0, 0, 0, 1, 1]
    rows = list(a.iter_rows(DAY, "txs", ["tx_hash"]))
    assert sorted(r["tx_hash"] for r in rows) == TX_HASHES
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<tx_hash:string,log_index:string>" in plan


def test_iter_range_and_views(spark, scratch):
    root = os.path.join(scratch, "two")
    make_archive(root, days=("2025-11-07", "2025-11-09"))
    a = Archive(spark, root)
    days = [(d, df.count()) for d, df in a.iter_range("2025-11-06", "2025-11-10", "txs")]
    assert days == [(date(2025, 11, 7), N_TXS), (date(2025, 11, 9), N_TXS)]
    assert a.rows_range("2025-11-06", "2025-11-10", "events", ["topic0"]).count() == 2 * N_EVENTS
    a.open_range("2025-11-07", "2025-11-09", prefix="t_")
    r = spark.sql("select count(*) from t_txs t join t_blocks b "
                  "on b.number = t.block_number and b.date = t.date").first()[0]
    assert r == 2 * N_TXS
    a.open_day("2025-11-09", prefix="d_")
    assert spark.sql("select sum(value) from d_txs").first()[0] == Decimal(3_500_000_000_000_007 + 77)
    assert [r["number"] for r in a.head("2025-11-09", "blocks", 2).collect()] == [701, 702]
    assert a.head("2025-11-09", "blocks", 0).count() == N_BLOCKS


def test_validation_and_duplicates(spark):
    rows = [
        (0, "2025-11-07", "txs", "daily/2025-11-07.txs.parquet", 10, "0" * 32, "v2"),
        (1, "2026-13-45", "txs", "daily/2026-13-45.txs.parquet", 10, "0" * 32, "v2"),
        (2, "2025-11-07", "wat", "daily/2025-11-07.wat.parquet", 10, "0" * 32, "v2"),
        (3, "2025-11-07", "txs", "daily/2025-11-07.txs.parquet", -1, "XYZ", "v2"),
        (4, "2025-11-07", "txs", "daily/other.parquet", 11, "1" * 32, "v2"),
    ]
    files = spark.createDataFrame(rows, "pos long, date string, kind string, key string, "
                                        "size long, md5 string, schema_version string")
    v = {r["pos"]: r["violations"] for r in A.file_violations(files).collect()}
    assert v[0] == [] and v[1] == ["date"] and v[2] == ["kind", "key"]
    assert v[3] == ["md5", "size"] and v[4] == ["key"]
    with pytest.raises(ValueError):
        A.validate(files)
    assert A.validate(files, strict=False).count() == 1
    # First entry wins on duplicates.
    assert A.entry(files, "2025-11-07", "txs")["size"] == 10
    assert A.duplicates(files).filter("kind = 'txs'").first()["copies"] == 3


def test_no_complete_day(spark):
    rows = [(0, "2025-11-06", "txs"), (1, "2025-11-07", "txs")]
    files = spark.createDataFrame(rows, "pos long, date string, kind string")
    assert A.latest_complete(files).first()[0] is None


def test_column_conformance(spark, scratch):
    root = os.path.join(scratch, "conf")
    make_archive(root)
    a = Archive(spark, root)
    probs = {(r["kind"], r["column"], r["problem"]) for r in a.conformance().collect()}
    # blocks files carry gas_limit before gas_used: both out of declared order.
    assert ("blocks", "gas_used", "out_of_order") in probs
    assert ("blocks", "gas_limit", "out_of_order") in probs
    # txs declares five columns; the file has more.
    assert ("txs", "status", "extra") in probs
    assert not any(p[2] == "missing" for p in probs)


def test_half_published_day_and_summary(spark, scratch):
    from ledgerlake.functions.hexnum import decode_audit
    root = os.path.join(scratch, "half")
    doc = make_archive(root, days=("2025-11-07", "2025-11-08"))
    doc["files"] = [f for f in doc["files"] if not (f["date"] == "2025-11-08" and f["kind"] == "events")]
    with open(os.path.join(root, "manifest.json"), "w") as f:
        json.dump(doc, f)
    a = Archive(spark, root)
    assert a.latest_complete_date() == date(2025, 11, 8)  # as declared
    assert a.derived_complete_date() == date(2025, 11, 7)
    views = a.open_range("2025-11-07", "2025-11-08", prefix="h_")
    assert views["txs"].count() == 2 * N_TXS  # each kind resolves its own days
    views = a.open_range("2025-11-07", "2025-11-08", prefix="c_", complete_days_only=True)
    assert views["txs"].count() == N_TXS and views["events"].count() == N_EVENTS
    s = a.summary()
    assert s["chain_id"] == 43114 and s["lookups"] == ["event_topics", "function_selectors"]
    per = {r["kind"]: (r["files"], r["first_date"], r["last_date"]) for r in s["files"].collect()}
    assert per["events"] == (1, "2025-11-07", "2025-11-07") and per[None][0] == 5
    raw = a.load_range("2025-11-07", "2025-11-08", "txs", decode=False)
    audit = decode_audit(raw, "txs", by=["date"]).filter("column = 'value'").collect()
    assert sorted((r["date"].isoformat(), r["decoded"]) for r in audit) == \
        [("2025-11-07", N_TXS), ("2025-11-08", N_TXS)]


def test_driver_resolution_matches_catalog(spark, scratch):
    root = os.path.join(scratch, "dups")
    doc = make_archive(root, days=("2025-11-07", "2025-11-08"))
    # A duplicate (later entry loses) and an impossible date.
    dup = dict(doc["files"][1], size=1, md5="f" * 32)
    bad = dict(doc["files"][1], date="2026-13-45")
    doc["files"] += [dup, bad]
    with open(os.path.join(root, "manifest.json"), "w") as f:
        json.dump(doc, f)
    with pytest.raises(ValueError, match="invalid manifest"):
        Archive(spark, root)
    a = Archive(spark, root, strict=False)  # the bad entry is left out
    for kind in ("blocks", "txs", "events"):
        local = [(e["date"], e["key"], e["size"]) for e in a._range("2000-01-01", "2030-12-31", kind)]
        cat = [(e["date"], e["key"], e["size"]) for e in
               A.range_list(a.files(), "2000-01-01", "2030-12-31", kind)]
        assert local == cat
    assert a.derived_complete_date() == A.latest_complete(a.files()).first()[0]


def test_lookup_entry_validation(spark):
    rows = [("function_selectors", "lookups/function_selectors.json", 10, "a" * 32),
            ("event_topics", "lookups/event_topics.json.gz", 10, "b" * 32),
            ("other", "lookups/x.parquet", 0, "c" * 32),
            ("bad", "daily/x.json", -5, "nope")]
    df = spark.createDataFrame(rows, "name string, key string, size long, md5 string")
    v = {r["name"]: r["violations"] for r in A.lookup_violations(df).collect()}
    assert v == {"function_selectors": [], "event_topics": [], "other": [],
                 "bad": ["key", "md5", "size"]}


def test_projection_across_versions(spark, scratch):
    root = os.path.join(scratch, "proj")
    t2 = day_table("blocks").append_column("extra", pa.array(list("abcd")))
    e = put(root, "daily/2025-11-08.blocks.parquet", parquet_bytes(t2))
    e.update(date="2025-11-08", kind="blocks", schema_version="v3")
    make_archive(root, days=("2025-11-07",), extra_files=[e])
    a = Archive(spark, root)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = a.load_range("2025-11-07", "2025-11-08", "blocks", columns=["extra", "number"])
        assert df.columns == ["extra", "number", "date"]
        got = sorted((r["date"].isoformat(), r["extra"] or "") for r in df.collect())
        assert got == [*[("2025-11-07", "")] * N_BLOCKS,
                       *[("2025-11-08", x) for x in "abcd"]]
        with pytest.raises(KeyError):
            a.load_range("2025-11-07", "2025-11-08", "blocks", columns=["nope"])


def test_invariants_range_is_union_of_days_and_projection_commutes(spark, scratch):
    from ledgerlake.functions.hexnum import decode_hex_columns
    root = os.path.join(scratch, "inv")
    make_archive(root, days=("2025-11-07", "2025-11-08", "2025-11-10"))
    a = Archive(spark, root)
    for kind in ("blocks", "txs", "events"):
        rng = a.load_range("2025-11-07", "2025-11-10", kind, with_date=False)
        days = None
        for d in a.available_dates(kind):
            one = a.load_day(d, kind)
            days = one if days is None else days.unionByName(one)
        assert rng.exceptAll(days).count() == 0 and days.exceptAll(rng).count() == 0
    raw = a.load_range("2025-11-07", "2025-11-10", "txs", decode=False, with_date=False)
    cols = ["tx_hash", "value", "gas_price"]
    before = decode_hex_columns(raw.select(*cols), "txs")
    after = decode_hex_columns(raw, "txs").select(*cols)
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_latest_report_declared_vs_derived(spark, scratch):
    root = os.path.join(scratch, "decl")
    make_archive(root, days=("2025-11-07", "2025-11-08"), latest="2025-11-19")
    r = Archive(spark, root).latest_report().first()
    assert r["latest_complete_date"] == date(2025, 11, 8)
    assert r["declared_latest_complete_date"] == date(2025, 11, 19)


def test_snapshot_diff_statuses(spark):
    cols = "pos long, date string, kind string, key string, size long, md5 string, schema_version string"
    prev = spark.createDataFrame([
        (0, "2025-11-07", "txs", "k1", 10, "a" * 32, "v2"),
        (1, "2025-11-08", "txs", "k2", 10, "b" * 32, "v2"),
        (2, "2025-11-09", "txs", "k3", 10, "c" * 32, "v2")], cols)
    cur = spark.createDataFrame([
        (0, "2025-11-07", "txs", "k1", 10, "a" * 32, "v2"),
        (1, "2025-11-08", "txs", "k2", 12, "d" * 32, "v2"),
        (2, "2025-11-10", "txs", "k4", 10, "e" * 32, "v2")], cols)
    got = {(r["date"], r["status"]) for r in A.diff(prev, cur).collect()}
    assert got == {("2025-11-08", "rebuilt"), ("2025-11-09", "vanished"), ("2025-11-10", "new")}
    assert A.latest_moved_back("2025-11-09", "2025-11-08")
    assert not A.latest_moved_back("2025-11-08", "2025-11-09")
    assert not A.latest_moved_back(None, "2025-11-09")


def test_column_added_within_one_version(spark, scratch):
    """The union of columns over every file, whichever day has more."""
    for name, more_on in (("late", "2025-11-08"), ("early", "2025-11-07")):
        root = os.path.join(scratch, name)
        t2 = day_table("blocks").append_column("extra", pa.array(list("abcd")))
        files = []
        for d in ("2025-11-07", "2025-11-08"):
            e = put(root, f"daily/{d}.blocks.parquet",
                    parquet_bytes(t2 if d == more_on else day_table("blocks")))
            files.append(dict(e, date=d, kind="blocks", schema_version="v2"))
        make_archive(root, days=(), extra_files=files, latest="")
        df = Archive(spark, root).load_range("2025-11-07", "2025-11-08", "blocks")
        assert df.count() == 2 * N_BLOCKS and "extra" in df.columns
        assert df.where("extra is not null").select("date").distinct().collect()[0][0] == \
            date.fromisoformat(more_on)


def test_filters_reach_the_scan_with_the_day_kept(spark, scratch):
    from ledgerlake.operators.recipes import failed_txs
    root = os.path.join(scratch, "push")
    make_archive(root, days=("2025-11-07", "2025-11-08"))
    a = Archive(spark, root)
    df = failed_txs(a.load_range("2025-11-07", "2025-11-08", "txs"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,0)" in plan
    one = a.load_range("2025-11-07", "2025-11-08", "txs").where("date = date'2025-11-08'")
    assert one.count() == N_TXS
    scan = [x for x in one._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert scan and "file_name" in scan[0].split("DataFilters")[1]


def test_damaged_file_is_not_read(spark, scratch):
    for how in ("cut", "altered", "missing"):
        root = os.path.join(scratch, how)
        doc = make_archive(root)
        path = os.path.join(root, doc["files"][1]["key"])
        body = open(path, "rb").read()
        if how == "missing":
            os.remove(path)
        else:
            with open(path, "wb") as f:
                f.write(body[:-1] if how == "cut" else body[:200] + b"\0" + body[201:])
        a = Archive(spark, root)
        assert a.load_day(DAY, "blocks").count() == N_BLOCKS
        with pytest.raises((ValueError, FileNotFoundError), match="fail verification"):
            a.load_day(DAY, "txs")


def test_keys_outside_the_root_are_refused_on_open(spark, scratch):
    root = os.path.join(scratch, "esc")
    doc = make_archive(root)
    doc["files"][0]["key"] = "../outside.parquet"
    with open(os.path.join(root, "manifest.json"), "w") as f:
        json.dump(doc, f)
    with pytest.raises(ValueError, match="invalid manifest"):
        Archive(spark, root)
