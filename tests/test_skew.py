"""One key holding a third of all rows: results stay whole and exact, and the
plans combine map-side before the shuffle."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.operators import lookups as L
from ledgerlake.operators import recipes as R
from ledgerlake.operators.contract import contract_checks
from ledgerlake.plans.joins import LIMIT_CONF, join_checked


def _frames(spark, n_tx=300, hot_share=3):
    txs = [(i % 10, f"0x{i:04x}", i % 2, "0xa9059cbb" if i % 3 else "") for i in range(n_tx)]
    events = []
    for i in range(n_tx):
        events += [(i % 10, f"0x{i:04x}", j) for j in range(1 + i % 4)]
    hot = len(events) // (hot_share - 1)  # the hot tx ends with a third of all events
    events += [(0, "0x0000", 100 + j) for j in range(hot)]
    blocks = [(b, 1_700_000_000 + b, None) for b in range(10)]
    return (spark.createDataFrame(blocks, "number long, timestamp long, base_fee_per_gas decimal(38,0)"),
            spark.createDataFrame(txs, "block_number long, tx_hash string, status long, input_prefix string"),
            spark.createDataFrame(events, "block_number long, tx_hash string, log_index long"),
            txs, events)


def test_hot_tx_event_counts_exact(spark):
    b, t, e, txs, events = _frames(spark)
    per_tx = Counter(x[1] for x in events)
    assert per_tx["0x0000"] * 3 >= len(events) - 3
    got = {r["tx_hash"]: r["event_count"] for r in R.tx_detail(b, t, e).collect()}
    assert got == {x[1]: per_tx.get(x[1], 0) for x in txs}
    top = R.events_per_tx_top(b, t, e, 5).collect()
    want = sorted(((per_tx[x[1]], x[1]) for x in txs), key=lambda p: (-p[0], p[1]))[:5]
    assert [(r["event_count"], r["tx_hash"]) for r in top] == want


def test_fallback_join_matches_broadcast(spark):
    b, t, e, _, _ = _frames(spark)
    small = b.select(F.col("number").alias("block_number"), "timestamp")
    fast = {tuple(r) for r in join_checked(t, small, "block_number", "left").collect()}
    spark.conf.set(LIMIT_CONF, "0")
    try:
        j = join_checked(t, small, "block_number", "left")
        slow = {tuple(r) for r in j.collect()}
    finally:
        spark.conf.unset(LIMIT_CONF)
    assert fast == slow and len(fast) == 300


def test_hot_selector_labels_whole(spark):
    _, t, _, txs, _ = _frames(spark)
    cands = spark.createDataFrame([("0xa9059cbb", 0, "transfer(address,uint256)", 9, None)],
                                  "key string, pos long, signature string, count long, abi string")
    for limit in (None, "0"):
        if limit:
            spark.conf.set(LIMIT_CONF, limit)
        try:
            rows = L.label_txs(t, cands).collect()
        finally:
            spark.conf.unset(LIMIT_CONF)
        assert len(rows) == len(txs)
        assert sum(r["signature"] is not None for r in rows) == sum(1 for x in txs if x[3])


def test_partial_aggregation_before_shuffle(spark):
    b, t, e, _, _ = _frames(spark)
    plan = R.events_per_tx_top(b, t, e, 5)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    plan = contract_checks(b, t, e)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    r = {x["check"]: x["violations"] for x in contract_checks(b, t, e).collect()}
    assert r["event_block_mismatch"] == 0 and r["tx_without_block"] == 0


def test_large_lookup_is_cut_to_used_keys(spark):
    from ledgerlake.plans.joins import measure
    cands = spark.createDataFrame(
        [(f"0x{i:08x}", 0, f"f{i}()", i, "x" * 200) for i in range(2000)],
        "key string, pos long, signature string, count long, abi string")
    data = spark.createDataFrame([("0x00000007",), ("0x00000007",), ("",)], "input_prefix string")
    _, _, whole = measure(L.best_candidates(cands))
    spark.conf.set(LIMIT_CONF, str(whole // 10))  # the whole lookup is over, the used part under
    try:
        out = L.label_txs(data, cands)
        rows = sorted((r["input_prefix"], r["signature"] or "") for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(LIMIT_CONF)
    assert rows == [("", ""), ("0x00000007", "f7()"), ("0x00000007", "f7()")]
    assert "BroadcastHashJoin" in plan


def test_split_join_shuffles_cold_keys_only(spark):
    from ledgerlake.plans import joins as J
    rows = [(i, k) for i, k in enumerate(
        ["0xhot"] * 3000 + [None, "", "0x"] * 500 + [f"0x{i:04x}" for i in range(700)])]
    data = spark.createDataFrame(rows, "id long, k string").repartition(4)
    table = spark.createDataFrame([("0xhot", "hot()")] + [(f"0x{i:04x}", f"f{i}()") for i in range(0, 9000, 2)],
                                  "_lk string, s string")
    assert J.frequent(data, F.col("k"), 0.05) == ["0xhot"] or set(J.frequent(data, F.col("k"), 0.05)) == {"0xhot", "", "0x"}
    out = J.left_join_keyed(data, F.col("k"), table, L.NO_SELECTOR, limit=0)
    names = {r[0]: r[1] for r in table.collect()}
    assert {(r.id, r.s) for r in out.collect()} == {(i, names.get(k)) for i, k in rows}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = J.left_join_keyed(data, F.col("k"), table, L.NO_SELECTOR, limit=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        # The frequent and the never-matching keys are filtered out below the exchange.
        shuffled = plan[plan.index("SortMergeJoin"):]
        assert "0xhot" in shuffled and shuffled.index("Exchange") < shuffled.index("0xhot")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bloom_filter_loses_no_key(spark):
    from ledgerlake.functions import bloom
    used = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    table = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), "id")
    kept = bloom.cut(table, "key", used, 3000, 1 << 20)
    ids = {r.id for r in kept.select("id").collect()}
    assert set(range(3000)) <= ids and len(ids) < 3000 + 0.03 * 57_000  # rows that go on to a shuffle
    assert bloom.cut(table, "key", used, 10 ** 9, 1 << 20).count() == 60_000
    blocks = bloom.blocks_for(30_000)  # partial filters merge
    merged = bloom.build(used.union(used.limit(500)).repartition(7), "key", blocks)
    assert merged.count() == blocks and bloom.may_hold(used, "key", merged, blocks).count() == 3000
    nulls = spark.createDataFrame([(None,)], "key string")
    assert bloom.may_hold(nulls, "key", bloom.build(nulls, "key", 1), 1).count() == 0
