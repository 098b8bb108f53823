import json
import os
import time

import pytest

from conftest import DAY, N_BLOCKS, N_EVENTS, N_TXS, day_table, make_archive, parquet_bytes, put
from ledgerlake.operators import integrity as D
from ledgerlake.sources.archive import Archive
from ledgerlake.streaming import ingest as H


def test_ingest_rerun_and_rebuild(spark, scratch):
    root = os.path.join(scratch, "a")
    doc = make_archive(root, days=(DAY, "2025-11-08"))
    lake = os.path.join(scratch, "lake")
    first = H.ingest(spark, Archive(spark, root), lake)
    assert len(first) == 6
    assert H.read_lake(spark, lake, "txs").count() == 2 * N_TXS
    assert H.ingest(spark, Archive(spark, root), lake) == []  # rerun is a no-op
    # Rebuild one day: same key, new bytes and md5.
    t = day_table("txs").slice(0, 1)
    e = put(root, "daily/2025-11-08.txs.parquet", parquet_bytes(t))
    for f in doc["files"]:
        if f["date"] == "2025-11-08" and f["kind"] == "txs":
            f.update(size=e["size"], md5=e["md5"])
    with open(os.path.join(root, "manifest.json"), "w") as fh:
        json.dump(doc, fh)
    again = H.ingest(spark, Archive(spark, root), lake)
    assert [(x["date"], x["kind"]) for x in again] == [("2025-11-08", "txs")]
    by_day = {r["date"].isoformat(): r["count"] for r in
              H.read_lake(spark, lake, "txs").groupBy("date").count().collect()}
    assert by_day == {DAY: N_TXS, "2025-11-08": 1}
    # Rebuilt back to the first bytes: the old md5 is in the ledger, but not
    # as the latest row, so the day is ingested again.
    e = put(root, "daily/2025-11-08.txs.parquet", parquet_bytes(day_table("txs")))
    for f in doc["files"]:
        if f["date"] == "2025-11-08" and f["kind"] == "txs":
            f.update(size=e["size"], md5=e["md5"])
    with open(os.path.join(root, "manifest.json"), "w") as fh:
        json.dump(doc, fh)
    back = H.ingest(spark, Archive(spark, root), lake)
    assert [(x["date"], x["kind"]) for x in back] == [("2025-11-08", "txs")]
    assert H.read_lake(spark, lake, "txs").count() == 2 * N_TXS
    one = H.lake_range(spark, lake, "txs", "2025-11-08", "2025-11-08")
    assert one.count() == N_TXS
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_follow_snapshots(spark, scratch):
    root = os.path.join(scratch, "a")
    make_archive(root, days=(DAY,))
    snaps = os.path.join(scratch, "snaps")
    os.makedirs(snaps)
    lake = os.path.join(scratch, "lake")
    ckpt = os.path.join(scratch, "ckpt")
    H.snapshot(root, snaps, "m1.json")
    q = H.follow(spark, Archive(spark, root), snaps, lake, ckpt)
    q.awaitTermination(120)
    assert H.read_lake(spark, lake, "events").count() == N_EVENTS
    # A new day is published: a new snapshot picks it up.
    make_archive(root, days=(DAY, "2025-11-08"))
    H.snapshot(root, snaps, "m2.json")
    totals = os.path.join(scratch, "totals")
    q = H.follow(spark, Archive(spark, root), snaps, lake, ckpt,
                 after=lambda done: H.refresh_running_totals(spark, lake, totals))
    q.awaitTermination(120)
    assert H.read_lake(spark, lake, "events").count() == 2 * N_EVENTS
    run = [(r["date"].isoformat(), r["txs"], r["txs_running"])
           for r in spark.read.parquet(totals).orderBy("date").collect()]
    assert run == [(DAY, N_TXS, N_TXS), ("2025-11-08", N_TXS, 2 * N_TXS)]


def test_replay_equals_range(spark, scratch):
    src = os.path.join(scratch, "src")
    make_archive(src, days=(DAY, "2025-11-08", "2025-11-10"))
    mirror = os.path.join(scratch, "mirror")
    a = Archive(spark, src)
    D.mirror_range(spark, a, mirror, DAY, "2025-11-10")
    sink = os.path.join(scratch, "sink")
    q = H.replay(spark, mirror, "txs", sink, os.path.join(scratch, "ck"), files_per_trigger=1)
    q.awaitTermination(120)
    assert q.lastProgress is not None
    got = spark.read.parquet(sink)
    want = a.load_range(DAY, "2025-11-10", "txs")
    cols = ["date", "tx_hash", "value", "block_number"]
    assert sorted(map(tuple, got.select(*cols).collect())) == \
        sorted(map(tuple, want.select(*cols).collect()))


def test_follow_with_time_trigger(spark, scratch):
    root = os.path.join(scratch, "a")
    make_archive(root, days=(DAY,))
    snaps = os.path.join(scratch, "snaps")
    os.makedirs(snaps)
    H.snapshot(root, snaps, "m1.json")
    lake = os.path.join(scratch, "lake")
    q = H.follow(spark, Archive(spark, root), snaps, lake, os.path.join(scratch, "ck"),
                 once=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert H.read_lake(spark, lake, "blocks").count() == N_BLOCKS


def _rebuild(root, doc, day, kind, table):
    e = put(root, f"daily/{day}.{kind}.parquet", parquet_bytes(table))
    for f in doc["files"]:
        if f["date"] == day and f["kind"] == kind:
            f.update(size=e["size"], md5=e["md5"])
    with open(os.path.join(root, "manifest.json"), "w") as fh:
        json.dump(doc, fh)


def test_day_rebuilt_to_empty_leaves_the_lake(spark, scratch):
    root, lake = os.path.join(scratch, "a"), os.path.join(scratch, "lake")
    doc = make_archive(root, days=(DAY, "2025-11-08"))
    H.ingest(spark, Archive(spark, root), lake)
    assert H.read_lake(spark, lake, "txs").count() == 2 * N_TXS
    _rebuild(root, doc, "2025-11-08", "txs", day_table("txs").slice(0, 0))
    assert len(H.ingest(spark, Archive(spark, root), lake)) == 1
    assert H.read_lake(spark, lake, "txs").count() == N_TXS


def test_damaged_day_is_not_ingested(spark, scratch):
    root, lake = os.path.join(scratch, "a"), os.path.join(scratch, "lake")
    doc = make_archive(root)
    with open(os.path.join(root, doc["files"][1]["key"]), "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="fail verification"):
        H.ingest(spark, Archive(spark, root), lake)
    assert not os.path.exists(os.path.join(lake, H.LEDGER))


def test_replay_after_rebuild_and_second_mirror(spark, scratch):
    src, mirror = os.path.join(scratch, "src"), os.path.join(scratch, "mirror")
    doc = make_archive(src, days=(DAY, "2025-11-08"))
    D.mirror_range(spark, Archive(spark, src), mirror, DAY, "2025-11-08")
    _rebuild(src, doc, "2025-11-08", "txs", day_table("txs").slice(0, 1))
    a = Archive(spark, src)
    D.mirror_range(spark, a, mirror, "2025-11-08", "2025-11-08")
    m = Archive(spark, mirror)
    assert m.files().count() == 6  # the first range is still listed
    assert m.summary()["lookups"] == ["event_topics", "function_selectors"]
    assert m.header["schema_version"] == "v2"
    sink = os.path.join(scratch, "sink")
    H.replay(spark, mirror, "txs", sink, os.path.join(scratch, "ck")).awaitTermination(120)
    assert spark.read.parquet(sink).count() == N_TXS + 1 == \
        a.load_range(DAY, "2025-11-08", "txs").count()


@pytest.mark.parametrize("how", ["chain", "cut"])
def test_follow_refuses_foreign_and_cut_off_snapshots(spark, scratch, how):
    root, snaps = os.path.join(scratch, "a"), os.path.join(scratch, "snaps")
    doc = make_archive(root)
    os.makedirs(snaps)
    text = json.dumps(dict(doc, chain_id=1) if how == "chain" else doc)
    with open(os.path.join(snaps, "m1.json"), "w") as f:
        f.write(text if how == "chain" else text[:len(text) // 2])
    lake = os.path.join(scratch, "lake")
    with pytest.raises(Exception):
        H.follow(spark, Archive(spark, root), snaps, lake, os.path.join(scratch, "ck")).awaitTermination(120)
    assert not os.path.exists(os.path.join(lake, H.LEDGER))


@pytest.mark.parametrize("kind", ["blocks", "txs", "events"])
def test_replay_keeps_a_column_added_on_day_two(spark, scratch, kind):
    src, mirror = os.path.join(scratch, f"src-{kind}"), os.path.join(scratch, f"mirror-{kind}")
    doc = make_archive(src, days=(DAY, "2025-11-08", "2025-11-09"))
    t = day_table(kind)
    _rebuild(src, doc, "2025-11-08", kind, t.append_column("added", [[str(i) for i in range(len(t))]]))
    a = Archive(spark, src)
    D.mirror_range(spark, a, mirror, DAY, "2025-11-09", kinds=(kind,))
    sink = os.path.join(scratch, f"sink-{kind}")
    q = H.replay(spark, mirror, kind, sink, os.path.join(scratch, f"ck-{kind}"), max_bytes=1)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3    # a file a batch
    got, want = spark.read.parquet(sink), a.load_range(DAY, "2025-11-09", kind)
    assert "added" in got.columns and set(got.columns) == set(want.columns)
    cols = sorted(want.columns)
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_follow_diffs_every_snapshot_and_records_batches(spark, scratch):
    root, snaps, lake = (os.path.join(scratch, x) for x in ("a", "snaps", "lake"))
    os.makedirs(snaps)
    doc = make_archive(root, days=(DAY, "2025-11-08"))
    H.snapshot(root, snaps, "1.json")
    _rebuild(root, doc, "2025-11-08", "txs", day_table("txs").slice(0, 1))  # before any trigger
    H.snapshot(root, snaps, "2.json")
    ck = os.path.join(scratch, "ck")
    H.follow(spark, Archive(spark, root), snaps, lake, ck, max_bytes=1)
    assert H.read_lake(spark, lake, "txs").count() == N_TXS + 1
    led = H._ledger(spark, lake)
    rows = [(r.batch_id, r.date, r.kind) for r in led.orderBy("batch_id").collect()]
    assert len(rows) == 6 and len({b for b, _, _ in rows}) == 6 and rows[-1][1:] == ("2025-11-08", "txs")
    H.follow(spark, Archive(spark, root), snaps, lake, ck)  # nothing new
    assert H._ledger(spark, lake).count() == 6


def test_source_offsets_are_repeatable(scratch):
    from ledgerlake.streaming.source import Reader
    snaps = os.path.join(scratch, "s")
    os.makedirs(snaps)
    entry = lambda d, md5: {"date": d, "kind": "txs", "key": f"daily/{d}.txs.parquet", "size": 10, "md5": md5}
    docs = [[entry("2020-01-01", "a"), entry("2020-01-02", "b")], [],
            [entry("2020-01-01", "a"), entry("2020-01-02", "c"), entry("2020-01-03", "d")]]
    for i, files in enumerate(docs):
        with open(os.path.join(snaps, f"{i}.json"), "w") as f:
            json.dump({"chain_id": 1, "files": files}, f)
    r, at, batches = Reader({"path": snaps, "maxBytes": "10"}), Reader({"path": snaps}).initialOffset(), []
    while True:
        rows, to = r.read(at)
        rows = list(rows)
        if not rows:
            break
        assert list(r.readBetweenOffsets(at, to)) == rows
        batches.append([(x[0], x[3], x[7], x[9]) for x in rows])
        at = to
    assert batches == [[("0.json", "2020-01-01", "a", False)], [("0.json", "2020-01-02", "b", True)],
                       [("2.json", "2020-01-01", "a", False)], [("2.json", "2020-01-02", "c", False)],
                       [("2.json", "2020-01-03", "d", False)]]
