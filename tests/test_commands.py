import glob
import json
import os

from conftest import DAY
from ledgerlake.plans import commands as C
from ledgerlake.sources.archive import Archive


def test_commands(spark, day_archive, scratch):
    a = Archive(spark, day_archive)
    assert C.latest(a) == DAY
    assert C.dates(a, "txs") == [DAY]
    assert C.url(a, DAY, "txs").endswith(f"daily/{DAY}.txs.parquet")
    assert C.manifest(a)["lookups"] == ["event_topics", "function_selectors"]
    got = C.fetch(spark, a, DAY, "blocks", os.path.join(scratch, "m"))
    assert got["status"] == "copied"
    ranked = C.lookup(spark, a, "selector", "0x51C0FFEE").collect()
    assert [(r["signature"], r["count"]) for r in ranked] == [
        ("settle(uint256,address)", 60317), ("settle(bytes8)", 88)]
    assert C.lookup(spark, a, "topic", "0xdeadbeef").count() == 0
    out = os.path.join(scratch, "show")
    C.show(a, DAY, "txs", 0, "ndjson", out)
    rows = [json.loads(x) for p in glob.glob(out + "/part-*.json") for x in open(p)]
    assert sorted(r["value"] for r in rows) == ["0", "3500000000000007", "77"]
    assert C.show(a, DAY, "blocks", 2, "csv", os.path.join(scratch, "csv")).count() == 2
