import glob
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import DAY, N_BLOCKS, N_EVENTS, N_TXS, make_archive
from ledgerlake import sinks
from ledgerlake.operators import integrity as D
from ledgerlake.operators.contract import contract_checks
from ledgerlake.sources import manifest as M
from ledgerlake.sources.archive import Archive


def _entries(spark, root):
    m = M.read_manifest(spark, root)
    return M.files_table(m), M.lookups_table(m)


def test_verify_ok_missing_and_mismatch(spark, scratch):
    root = os.path.join(scratch, "a")
    doc = make_archive(root)
    files, lookups = _entries(spark, root)
    st = {r["key"]: r["status"] for r in D.verify_objects(spark, root, files).collect()}
    assert set(st.values()) == {"ok"} and len(st) == 3
    lk = {r["key"]: r["status"] for r in D.verify_objects(spark, root, lookups).collect()}
    assert set(lk.values()) == {"ok"}
    # MD5 of 32 zeros, a truncated file and a missing file.
    doc["files"][0]["md5"] = "0" * 32
    os.remove(os.path.join(root, doc["files"][1]["key"]))
    with open(os.path.join(root, doc["files"][2]["key"]), "ab") as f:
        f.write(b"x")
    with open(os.path.join(root, "manifest.json"), "w") as f:
        json.dump(doc, f)
    files, _ = _entries(spark, root)
    st = {r["kind"]: r["status"] for r in D.verify_objects(spark, root, files).collect()}
    assert st == {"blocks": "md5_mismatch", "txs": "missing", "events": "size_mismatch"}


def test_mirror_copy_present_refuse(spark, scratch):
    src = os.path.join(scratch, "src")
    make_archive(src, days=(DAY, "2025-11-08"))
    dest = os.path.join(scratch, "mirror")
    a = Archive(spark, src)
    rep = D.mirror_range(spark, a, dest, DAY, "2025-11-08")
    assert sorted(r["status"] for r in rep) == ["copied"] * 6
    again = D.mirror_range(spark, a, dest, DAY, "2025-11-08")
    assert sorted(r["status"] for r in again) == ["present"] * 6
    names = sorted(os.path.basename(p) for p in glob.glob(os.path.join(dest, "daily", "*")))
    assert all(n.count(".") == 3 for n in names)  # date.kind.md5[:16].parquet
    m = Archive(spark, dest)
    assert m.load_range(DAY, "2025-11-08", "txs").count() == 2 * N_TXS
    assert m.load_day(DAY, "blocks").count() == N_BLOCKS
    bad = spark.createDataFrame([("2025-11-07", "txs", "../../etc/passwd", 1, "0" * 32, "v2")],
                                "date string, kind string, key string, size long, md5 string, "
                                "schema_version string")
    assert D.mirror(spark, src, dest, bad).first()["status"] == "refused"
    # A source shorter or longer than declared is not copied.
    wrong = spark.createDataFrame([(DAY, "txs", f"daily/{DAY}.txs.parquet", 5, "0" * 32, "v2")],
                                  "date string, kind string, key string, size long, md5 string, "
                                  "schema_version string")
    assert D.mirror(spark, src, dest, wrong).first()["status"] == "size_mismatch"


def test_contract_checks(spark):
    blocks = spark.createDataFrame([(1,), (2,), (2,)], "number long")
    txs = spark.createDataFrame([(1, "0xa"), (3, "0xb")], "block_number long, tx_hash string")
    events = spark.createDataFrame([(1, "0xa", 0), (1, "0xa", 0), (2, "0xb", 1), (4, "0xc", 0)],
                                   "block_number long, tx_hash string, log_index long")
    r = {x["check"]: (x["violations"], x["example"])
         for x in contract_checks(blocks, txs, events).collect()}
    assert r["dup_block_number"] == (1, "2")
    assert r["dup_event_key"] == (1, "1:0")
    assert r["tx_without_block"] == (1, "0xb")
    assert r["event_without_block"] == (1, "0xc")
    assert r["event_block_mismatch"] == (1, "0xb")


def _read_parts(path, pattern):
    out = []
    for p in sorted(glob.glob(os.path.join(path, pattern))):
        with open(p, newline="") as f:
            out.append(f.read())
    return "".join(out)


def test_ndjson_csv_parquet(spark, day_archive, scratch):
    a = Archive(spark, day_archive)
    txs = a.load_day(DAY, "txs").orderBy("tx_hash").coalesce(1)
    out = os.path.join(scratch, "json")
    sinks.write_ndjson(txs, out)
    lines = [json.loads(x) for x in _read_parts(out, "part-*.json").splitlines()]
    assert [x["value"] for x in lines] == ["0", "3500000000000007", "77"]
    assert "to_address" in lines[1] and lines[1]["to_address"] is None
    csv_out = os.path.join(scratch, "csv")
    sinks.write_csv(txs, csv_out)
    text = _read_parts(csv_out, "part-*.csv")
    rows = text.split("\n")
    assert rows[0].startswith("block_number,tx_hash") and rows[-1] == ""
    assert len(rows) == N_TXS + 2 and "\r" not in text
    assert ",,1," in rows[2] or rows[2].count(",,") >= 1  # null to_address is empty
    pq_out = os.path.join(scratch, "pq")
    sinks.write_parquet(a.load_range(DAY, DAY, "txs"), pq_out)
    back = spark.read.parquet(pq_out)
    assert back.count() == N_TXS and "date" in back.columns
    assert back.agg({"value": "sum"}).first()[0] == Decimal(3_500_000_000_000_007 + 77)


def test_text_safe_binary_and_decimal(spark, scratch):
    df = spark.createDataFrame([(bytearray(b"\xde\xad"), Decimal(10) ** 30, None)],
                               "b binary, d decimal(38,0), s string")
    out = os.path.join(scratch, "bin")
    sinks.write_ndjson(df.coalesce(1), out)
    row = json.loads(_read_parts(out, "part-*.json").splitlines()[0])
    assert row == {"b": "dead", "d": "1000000000000000000000000000000", "s": None}


# ------------------------------------------------------------------- ledger
def _state(spark, root, ledger, again=False, chunk=100):
    files, _ = _entries(spark, root)
    rows = D.Ledger(spark, root, ledger, chunk).check(files, again=again).collect()
    return {r["kind"]: (r["status"], r["bad_start"]) for r in rows}, sum(r["bytes_read"] for r in rows)


def test_second_session_hashes_nothing_and_changes_are_caught(spark, scratch):
    root, ledger = os.path.join(scratch, "led"), os.path.join(scratch, "ledger")
    doc = make_archive(root)
    total = sum(e["size"] for e in doc["files"])
    fine = {k: ("ok", None) for k in ("blocks", "txs", "events")}
    assert _state(spark, root, ledger) == (fine, total)
    assert _state(spark, root, ledger) == (fine, 0)                 # another object, as another session
    assert _state(spark, root, ledger, again=True) == (fine, total)  # by chunks now
    n = D.Ledger(spark, root, ledger, 100).chunks().count()
    assert n == sum(-(-e["size"] // 100) for e in doc["files"])
    # One byte changed in the middle: same size, another time of change.
    path = os.path.join(root, doc["files"][1]["key"])
    body = bytearray(open(path, "rb").read())
    body[250] ^= 1
    with open(path, "wb") as f:
        f.write(body)
    st, read = _state(spark, root, ledger)
    assert st[doc["files"][1]["kind"]] == ("md5_mismatch", 200) and read == doc["files"][1]["size"]
    body[250] ^= 1
    with open(path, "wb") as f:
        f.write(body)
    assert _state(spark, root, ledger) == (fine, doc["files"][1]["size"])
    os.remove(path)
    with open(os.path.join(root, doc["files"][0]["key"]), "ab") as f:
        f.write(b"x")
    st, read = _state(spark, root, ledger)
    assert sorted(s for s, _ in st.values()) == ["missing", "ok", "size_mismatch"] and read == 0


def test_archive_opens_by_its_ledger(spark, scratch):
    root, ledger = os.path.join(scratch, "arc"), os.path.join(scratch, "arc-ledger")
    make_archive(root)
    assert Archive(spark, root, ledger=ledger).load_day(DAY, "txs").count() == N_TXS
    before = D.Ledger(spark, root, ledger).verified().count()
    assert Archive(spark, root, ledger=ledger).load_day(DAY, "txs").count() == N_TXS
    assert D.Ledger(spark, root, ledger).verified().count() == before == 1


def _large(spark, scratch, name, size=3 << 20):
    import hashlib
    body = bytes(range(256)) * (size // 256) + b"tail"
    os.makedirs(os.path.join(scratch, name, "daily"))
    with open(os.path.join(scratch, name, "daily", "big.bin"), "wb") as f:
        f.write(body)
    row = (DAY, "txs", "daily/big.bin", len(body), hashlib.md5(body).hexdigest(), "v2")
    return os.path.join(scratch, name), body, spark.createDataFrame(
        [row], "date string, kind string, key string, size long, md5 string, schema_version string")


def test_one_large_file_is_verified_by_many_tasks(spark, scratch):
    root, body, df = _large(spark, scratch, "large")
    ledger = D.Ledger(spark, root, os.path.join(scratch, "large-ledger"), 256 << 10)
    assert ledger.check(df).first()["status"] == "ok"
    chunks = ledger.chunks()
    assert chunks.count() == 13 and D._tasks(spark, chunks, "length") > 4
    with open(os.path.join(root, "daily", "big.bin"), "r+b") as f:
        f.seek(2 << 20)
        f.write(b"?")
    r = ledger.check(df).first()
    assert (r["status"], r["bad_start"], r["bytes_read"]) == ("md5_mismatch", 2 << 20, len(body))


def test_mirror_resumes_by_parts(spark, scratch):
    root, body, df = _large(spark, scratch, "from")
    dest, chunk = os.path.join(scratch, "to"), 512 << 10
    assert {r["status"] for r in D.copy_parts(spark, root, dest, df, chunk).collect()} == {"copied"}
    parts = sorted(glob.glob(os.path.join(dest, "daily", "*.part-*")))
    assert len(parts) == 7
    os.remove(parts[3])                       # a mirror that was interrupted
    st = sorted((r["start"], r["status"]) for r in D.copy_parts(spark, root, dest, df, chunk).collect())
    assert [s for _, s in st] == ["present"] * 3 + ["copied"] + ["present"] * 3
    assert D.mirror(spark, root, dest, df, chunk=chunk).first()["status"] == "copied"
    left = glob.glob(os.path.join(dest, "daily", "*"))
    assert len(left) == 1 and open(left[0], "rb").read() == body
    assert D.mirror(spark, root, dest, df, chunk=chunk).first()["status"] == "present"
    # A part damaged on the way: the file is refused and the parts go.
    other = os.path.join(scratch, "other")
    D.copy_parts(spark, root, other, df, chunk).count()
    bad = sorted(glob.glob(os.path.join(other, "daily", "*.part-*")))[2]
    with open(bad, "r+b") as f:
        f.write(b"?")
    assert D.mirror(spark, root, other, df, chunk=chunk).first()["status"] == "md5_mismatch"
    assert not glob.glob(os.path.join(other, "daily", "*"))
    assert D.mirror(spark, root, other, df, chunk=chunk).first()["status"] == "copied"


def test_paths_are_qualified(spark, scratch):
    from ledgerlake.sources import fsio
    assert fsio.qualify(spark, scratch) == f"file:{scratch}" and fsio.qualify(spark, f"file://{scratch}/x") == f"file:{scratch}/x"
    assert fsio.is_local("file:/x") and not fsio.is_local("hdfs:/x") and not fsio.is_local("s3a://b/x")
    for path in ("x/y", "hdfs:/x"):
        try:
            fsio.size_of(path)
        except Exception:
            continue
        raise AssertionError(path)


# ------------------------------------------------------- two-phase publishing
@pytest.mark.parametrize("form", ["ndjson", "csv", "parquet"])
def test_killed_publication_leaves_the_old_output(spark, scratch, form):
    path = os.path.join(scratch, f"pub-{form}")
    with pytest.raises(Exception):
        sinks.manifest_of(spark, path)
    df = spark.createDataFrame([(1, "2020-01-01", Decimal("7")), (2, "2020-01-02", None)],
                               "id long, date string, wei decimal(38,0)")
    doc = sinks.publish(df, path, form)
    want = sorted(map(str, sinks.published(spark, path, verify=True).collect()))
    assert len(want) == 2 and doc["parts"] and doc["format"] == form
    broken = df.repartition(4).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception):
        sinks.publish(broken, path, form)
    assert sorted(map(str, sinks.published(spark, path, verify=True).collect())) == want
    assert len(glob.glob(os.path.join(path, "parts-*"))) == 2   # the broken one lies there unread
    sinks.publish(df.where("id = 1"), path, form)
    assert sinks.published(spark, path).count() == 1 and len(glob.glob(os.path.join(path, "parts-*"))) == 1
    part = os.path.join(path, sinks.manifest_of(spark, path)["parts"][0]["path"])
    with open(part, "r+b") as f:
        f.write(b"??")
    with pytest.raises(ValueError, match="verification"):
        sinks.published(spark, path, verify=True)
    sinks.publish(df.limit(0), path, form)
    assert sinks.published(spark, path).count() == 0


# ------------------------------------------------------------------- footers
def test_counts_come_from_footers_alone(spark, scratch):
    import struct

    from ledgerlake.sources import footers
    root = os.path.join(scratch, "foot")
    doc = make_archive(root, days=(DAY, "2025-11-08"))
    for e in doc["files"]:  # wipe all column pages; the footer stays
        p = os.path.join(root, e["key"])
        body = open(p, "rb").read()
        foot = struct.unpack("<I", body[-8:-4])[0] + 8
        with open(p, "wb") as f:
            f.write(b"PAR1" + bytes(len(body) - foot - 4) + body[-foot:])
    g = Archive(spark, root, verify=False).footers()
    n = {"blocks": N_BLOCKS, "txs": N_TXS, "events": N_EVENTS}
    assert {(r.kind, str(r.date), r.rows) for r in footers.row_counts(g).collect()} == {
        (k, d, v) for k, v in n.items() for d in (DAY, "2025-11-08")}
    spans = {(r.kind, str(r.date)): (r.first_block, r.last_block) for r in footers.block_ranges(g).collect()}
    assert spans["blocks", DAY] == (701, 700 + N_BLOCKS)
    one = Archive(spark, root, verify=False).footers(start="2025-11-08")
    assert {r.date for r in one.collect()} == {"2025-11-08"}


# --------------------------------------------------- checks by changed days
def test_contract_state_equals_full_check_after_rebuilds(spark, scratch):
    import random

    from ledgerlake.operators.contract import ContractState
    from ledgerlake.streaming import ingest as H
    lake = os.path.join(scratch, "lake-state")
    rng = random.Random(7)
    days = [f"2020-01-0{i}" for i in range(1, 6)]

    def put_day(day, stamp, faulty):
        """A day as H1 leaves it: rows and its ledger entries."""
        base = 10 * int(day[-1])
        blocks = [(base + i,) for i in range(4)] + [(base,)] * faulty
        txs = [(base + rng.randrange(4), f"0x{day[-1]}{i}") for i in range(6)]
        events = [(b, h, j) for j, (b, h) in enumerate(txs * 2)]
        if faulty:  # another day's tx, a block twice on the calendar, a key twice, no such block
            events += [(base, "0x11", 0), (base, "0x11", 0), (10, "0x20", 3), (999, "0xff", None)]
            txs += [(20, "0x30"), (777, "0x99")]
        for kind, rows, ddl in (("blocks", blocks, "number long"), ("txs", txs, "block_number long, tx_hash string"),
                                ("events", events, "block_number long, tx_hash string, log_index long")):
            (spark.createDataFrame(rows, ddl).withColumn("date", F.lit(day).cast("date")).coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{lake}/{kind}"))
        spark.createDataFrame([(day, k, "k", stamp + day + k, 1, stamp, None, None) for k in ("blocks", "txs", "events")],
                              H.LEDGER_DDL).write.mode("append").parquet(f"{lake}/{H.LEDGER}")

    def same():
        full = contract_checks(*(H.read_lake(spark, lake, k) for k in ("blocks", "txs", "events")))
        got = ContractState(spark, lake).report()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
        return {r["check"]: r["violations"] for r in got.collect()}

    for d in days:
        put_day(d, "1", d == "2020-01-02")
    assert ContractState(spark, lake).update() == days
    assert all(same().values())
    assert ContractState(spark, lake).update() == []
    put_day("2020-01-02", "2", False)                       # rebuilt, now right
    put_day("2020-01-04", "2", True)
    assert ContractState(spark, lake).update() == ["2020-01-02", "2020-01-04"]
    assert all(same().values())
    put_day("2020-01-04", "3", False)
    assert ContractState(spark, lake).update() == ["2020-01-04"]
    assert not any(same().values())


def test_running_totals_in_two_levels(spark, scratch):
    from ledgerlake.operators import recipes as R
    from ledgerlake.streaming import ingest as H
    lake, dest = os.path.join(scratch, "lake-run"), os.path.join(scratch, "totals-run")
    days = [f"20{y}-{m:02d}-0{d}" for y in (19, 20) for m in (1, 5, 12) for d in (1, 2)]

    def put_txs(sizes):
        rows = [(d, i % 2) for d, n in sizes.items() for i in range(n)]
        (spark.createDataFrame(rows, "day string, status long").select("status", F.col("day").cast("date").alias("date"))
         .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{lake}/txs"))

    def check():
        want = sorted(map(tuple, R.running_totals(H.read_lake(spark, lake, "txs")).collect()))
        cols = ["date", "failed_txs", "txs", "failed_running", "txs_running"]
        got = sorted(map(tuple, spark.read.parquet(dest).select(cols).collect()))
        assert got == want
        total = 0
        for _, _, n, _, run in want:
            total += n
            assert run == total

    put_txs({d: 3 + i for i, d in enumerate(days)})
    H.refresh_running_totals(spark, lake, dest)
    check()
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{dest}/month=*/*.parquet")}
    put_txs({"2020-05-02": 9, "2020-07-01": 1})
    H.refresh_running_totals(spark, lake, dest, [{"date": d, "kind": "txs"} for d in ("2020-07-01", "2020-05-02")])
    check()
    kept = {f for f in glob.glob(f"{dest}/month=*/*.parquet") if before.get(f) == os.path.getmtime(f)}
    assert {f.split("month=")[1][:7] for f in kept} == {"2019-01", "2019-05", "2019-12", "2020-01"}
    plan = R.running_totals(H.read_lake(spark, lake, "txs"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
