import gzip
import json
import os

import pytest

from conftest import SELECTORS, TOPICS
from ledgerlake.operators import lookups as L
from ledgerlake.sources.lookups import normalise_lookup, read_lookup


def _write(path, obj, seps=(",", ":"), gz=False):
    body = json.dumps(obj, separators=seps).encode()
    if gz:
        with gzip.open(path, "wb") as f:
            f.write(body)
    else:
        with open(path, "wb") as f:
            f.write(body)
    return path


def _rows(df):
    return sorted((r["key"], r["pos"], r["signature"], r["count"]) for r in df.collect())


WANT = [("0x0badf00d", 0, "quote(address)", 733),
        ("0x51c0ffee", 0, "settle(uint256,address)", 60317),
        ("0x51c0ffee", 1, "settle(bytes8)", 88)]


@pytest.mark.parametrize("seps", [(",", ":"), (", ", ": ")])
def test_split_read_both_spacings(spark, scratch, seps):
    p = _write(os.path.join(scratch, "sel.json"), SELECTORS, seps)
    df = read_lookup(spark, p)
    assert _rows(df) == WANT
    abi = df.filter("pos = 0 and key = '0x51c0ffee'").first()["abi"]
    assert json.loads(abi) == {"name": "settle"}


def test_split_read_many_keys_splits_over_tasks(spark, scratch):
    big = {f"0x{i:08x}": [{"signature": f"f{i}()", "count": i, "abi": {"inputs": [{"a": [1, 2]}]}},
                          {"signature": f"g{i}()", "count": 1, "abi": None}]
           for i in range(20000)}
    p = _write(os.path.join(scratch, "big.json"), big)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_lookup(spark, p)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 40000
        assert df.select("key").distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_gz_and_legacy_object(spark, scratch):
    p = _write(os.path.join(scratch, "sel.json.gz"), SELECTORS, gz=True)
    assert _rows(read_lookup(spark, p)) == WANT
    legacy = {"0x0badf00d": {"signature": "quote(address)", "count": 733, "abi": {}},
              "0x51c0ffee": SELECTORS["0x51c0ffee"]}
    p2 = _write(os.path.join(scratch, "legacy.json"), legacy)
    assert _rows(read_lookup(spark, p2)) == WANT


def test_bad_fragment_raises(spark, scratch):
    p = os.path.join(scratch, "bad.json")
    with open(p, "w") as f:
        f.write('{"0xaa":[{"signature":"x","count":1}],"0xbb":[{"signature":')
    with pytest.raises(Exception):
        read_lookup(spark, p)


def test_ranked_candidates_best_and_labels(spark, scratch):
    p = _write(os.path.join(scratch, "sel.json"), SELECTORS)
    dest = os.path.join(scratch, "sel.parquet")
    cands = normalise_lookup(spark, p, dest)
    ranked = L.lookup(cands, ["0x51C0FFEE"]).orderBy("rank").collect()
    assert [r["count"] for r in ranked] == [60317, 88]
    assert L.lookup(cands, ["0xdeadbeef"]).count() == 0
    best = {r["key"]: r["signature"] for r in L.best_candidates(cands).collect()}
    assert best["0x51c0ffee"] == "settle(uint256,address)"
    txs = spark.createDataFrame([("0xaa", "0x"), ("0xbb", "0x51c0ffee"), ("0xcc", ""),
                                 ("0xdd", "0x12345678"), ("0xee", "0x51C0FFEE")],
                                "tx_hash string, input_prefix string")
    lab = {r["tx_hash"]: r["signature"] for r in L.label_txs(txs, cands).collect()}
    assert lab == {"0xaa": None, "0xbb": "settle(uint256,address)", "0xcc": None,
                   "0xdd": None, "0xee": "settle(uint256,address)"}
    allc = {r["tx_hash"]: r["candidates"] for r in L.all_candidates(txs, "input_prefix", cands).collect()}
    assert [c["signature"] for c in allc["0xbb"]] == ["settle(uint256,address)",
                                                      "settle(bytes8)"]
    assert allc["0xaa"] is None
    un = {r["key"]: r["rows"] for r in L.unresolved(txs, "input_prefix", cands).collect()}
    assert un == {"0x12345678": 1}


def test_ties_are_stable(spark):
    cands = spark.createDataFrame(
        [("0x01", 0, "a()", 5, None), ("0x01", 1, "b()", 5, None), ("0x01", 2, "c()", None, None)],
        "key string, pos long, signature string, count long, abi string")
    assert L.best_candidates(cands).first()["signature"] == "a()"
    assert [r["signature"] for r in L.rank_candidates(cands).orderBy("rank").collect()] == \
        ["a()", "b()", "c()"]


def test_topic_labels(spark, scratch):
    p = _write(os.path.join(scratch, "top.json"), TOPICS, (", ", ": "))
    cands = read_lookup(spark, p)
    key = list(TOPICS)[0]
    ev = spark.createDataFrame([(key,), ("0xddf",), (None,)], "topic0 string")
    got = sorted((r["topic0"] or "", r["signature"] or "") for r in L.label_events(ev, cands).collect())
    assert got == sorted([("", ""), ("0xddf", ""), (key, "Settled(address,uint256)")])


def test_uppercase_keys_and_empty_lists(spark, scratch):
    p = os.path.join(scratch, "mixed.json")
    with open(p, "w") as f:
        f.write('{"0xAA":[{"signature":"a()","count":2,"abi":null}],'
                '"0XBB":[{"signature":"b()","count":1,"abi":{"inputs":[{"x":[1]}]}}],'
                '"0xcc":[],"0xdd":[{"signature":"d()","count":3,"abi":null}]}')
    got = sorted((r["key"], r["signature"]) for r in read_lookup(spark, p).collect())
    assert got == [("0xaa", "a()"), ("0xbb", "b()"), ("0xdd", "d()")]


def test_byte_order_mark(spark, scratch):
    p = os.path.join(scratch, "bom.json")
    with open(p, "wb") as f:
        f.write(b"\xef\xbb\xbf" + json.dumps(SELECTORS, separators=(",", ":")).encode())
    assert _rows(read_lookup(spark, p)) == WANT


def test_key_lookup_is_pushed_to_parquet(spark, scratch):
    p = _write(os.path.join(scratch, "sel.json"), SELECTORS)
    cands = normalise_lookup(spark, p, os.path.join(scratch, "norm"))
    q = L.lookup(cands, ["0x51C0FFEE"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(key, [0x51c0ffee])]" in plan or \
        "PushedFilters: [IsNotNull(key), EqualTo(key,0x51c0ffee)]" in plan, plan
    assert q.count() == 2


def test_cut_off_lookup_raises_at_every_cut(spark, scratch):
    obj = {f"0x{i:08x}": [{"signature": f"f{i}()", "count": i, "abi": None}] for i in range(40)}
    body = json.dumps(obj, separators=(",", ":")).encode()
    p = os.path.join(scratch, "cut.json")
    for end in [1, len(body) // 2, len(body) - 1] + [
            i + 1 for i, c in enumerate(body[:-1]) if c in b"]}"][::9]:
        with open(p, "wb") as f:
            f.write(body[:end])
        with pytest.raises(Exception):
            read_lookup(spark, p).count()


def test_lookup_must_match_its_entry(spark, scratch):
    import hashlib
    p = _write(os.path.join(scratch, "sel.json"), SELECTORS)
    body = open(p, "rb").read()
    entry = {"size": len(body), "md5": hashlib.md5(body).hexdigest()}
    assert read_lookup(spark, p, entry).count() == 3
    for bad in (dict(entry, md5="0" * 32), dict(entry, size=1)):
        with pytest.raises(ValueError, match="manifest entry"):
            read_lookup(spark, p, bad)


AWKWARD = {"0x01": [{"signature": 'a"b\\,}]{[(u)', "count": 1, "abi": {"x": [1, {"y": ","}]}}],
           "0x02": {"signature": "legacy(a,b)", "count": 2, "abi": None}, "0x03": [],
           "0xé": [{"signature": "é" * 40, "count": None, "abi": ["\\\\", '\\"']}] * 3,
           "0x05": [{"signature": "long(" + ",".join(["x"] * 3000) + ")", "count": 5, "abi": None}]}


@pytest.mark.parametrize("bytes_a_split", [97, 1000, 1 << 20])
def test_any_shape_and_split_gives_equal_rows(spark, scratch, bytes_a_split):
    want = sorted((k, i, c["signature"], c["count"], c["abi"]) for k, v in AWKWARD.items()
                  for i, c in enumerate(v if isinstance(v, list) else [v]))
    bodies = [json.dumps(AWKWARD), json.dumps(AWKWARD, separators=(",", ":"), ensure_ascii=False),
              json.dumps(AWKWARD, indent=1) + "\n\n"]
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(bytes_a_split))
        for body in bodies:
            p = os.path.join(scratch, f"any-{len(body)}.json")
            with open(p, "w") as f:
                f.write(body)
            got = sorted((r.key, r.pos, r.signature, r["count"], r.abi and json.loads(r.abi))
                         for r in read_lookup(spark, p).collect())
            assert got == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_one_odd_entry_keeps_many_tasks(spark, scratch):
    from ledgerlake.sources import jsonsplit as J
    big = {f"0x{i:08x}": [{"signature": f"f{i}(address,uint256)", "count": i, "abi": {"inputs": [i]}}] for i in range(30000)}
    big["0x00003a98"] = {"signature": "odd(a,b)", "count": 7, "abi": None}
    p = _write(os.path.join(scratch, "odd.json"), big, (", ", ": "))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        pieces = J._pieces(spark, p)
        assert pieces.rdd.getNumPartitions() > 8 and pieces.select("split").distinct().count() > 8
        df = read_lookup(spark, p)
        assert df.rdd.getNumPartitions() > 8 and df.count() == 30000
        assert df.where("key = '0x00003a98'").first().signature == "odd(a,b)"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


@pytest.mark.parametrize("body", ["", "[]", "7", '{"0x1":[]}{"0x2":[]}', '{"0x1":[]},{"0x2":[]}', '{"0x1":[]}}',
                                  '{"0x1":7}', '{"0x1":[1}', '{0x1:[]}', 'x{"0x1":[]}', '{"0x1":[]'])
def test_what_is_no_lookup_raises(spark, scratch, body):
    p = os.path.join(scratch, "no.json")
    with open(p, "w") as f:
        f.write(body)
    with pytest.raises(Exception, match="parse|whole|outside"):
        read_lookup(spark, p).count()


def test_empty_object_has_no_rows(spark, scratch):
    assert read_lookup(spark, _write(os.path.join(scratch, "none.json"), {})).count() == 0


def test_summaries_compose():
    import random

    from ledgerlake.sources.jsonsplit import compose, summarise
    rng = random.Random(1)
    for _ in range(2000):
        a, b, c = (b"".join(rng.choice([b"{", b"}", b"[", b"]", b'"', b",", b"\\\"", b"a"])
                            for _ in range(rng.randrange(9))) for _ in range(3))
        x, y, z = map(summarise, (a, b, c))
        assert compose(x, y) == summarise(a + b)
        assert compose(compose(x, y), z) == compose(x, compose(y, z))
