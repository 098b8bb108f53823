from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.hexnum import decode_audit, decode_hex_columns, hex_int, norm_key, wei

MAX_DEC = 10 ** 38 - 1


def _wei(spark, values):
    """Both forms (SQL text for a name, Column builder for a Column) agree."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(wei("v"), wei(F.col("v"))).collect()
    assert all(r[0] == r[1] for r in rows)
    return [r[0] for r in rows]


def _int(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(hex_int("v"), hex_int(F.col("v"))).collect()
    assert all(r[0] == r[1] for r in rows)
    return [r[0] for r in rows]


def test_wei_contract_cases(spark):
    got = _wei(spark, [None, "", "0x", "0x0", "0xc6f3b40b6c007", "0xzz", "ff", "123",
                       "0x1d5", "0X1D5", "0x000000000000000000000000000000000000001"])
    assert got == [None, None, 0, 0, Decimal(3_500_000_000_000_007), None, None, None, 469, 469, 1]


def test_wei_limits(spark):
    top = hex(MAX_DEC)
    over = hex(MAX_DEC + 1)
    got = _wei(spark, [top, over, "0x" + "f" * 32, "0x" + "1" + "0" * 32, "0x" + "f" * 16,
                       "0x1" + "0" * 16])
    assert got == [Decimal(MAX_DEC), None, None, None, Decimal(2 ** 64 - 1), Decimal(2 ** 64)]


def test_log_index_cases(spark):
    got = _int(spark, [None, "", "0x", "0x0", "0x1", "0x1d5", "0x1zz", "zz", "0x7fffffffffffffff",
                       "0x8000000000000000", "0x" + "0" * 20 + "5"])
    assert got == [None, None, 0, 0, 1, 469, None, None, 2 ** 63 - 1, None, 5]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2 ** 130), min_size=1, max_size=40))
def test_wei_random_against_python(spark, nums):
    vals = [hex(n) for n in nums]
    got = _wei(spark, vals)
    want = [Decimal(n) if n <= MAX_DEC else None for n in nums]
    assert got == want
    ints = _int(spark, vals)
    assert ints == [n if n < 2 ** 63 else None for n in nums]


def test_decode_skips_absent_and_keeps_others(spark):
    df = spark.createDataFrame([("0x1d5", "0xbeef")], "log_index string, data string")
    out = decode_hex_columns(df, "events").first()
    assert out["log_index"] == 469 and out["data"] == "0xbeef"
    df2 = spark.createDataFrame([("0x1",)], "value string")
    assert decode_hex_columns(df2, "txs").first()["value"] == 1


def test_unknown_kind(spark):
    df = spark.createDataFrame([("0x1",)], "value string")
    with pytest.raises(ValueError, match="unknown kind"):
        decode_hex_columns(df, "txn")


def test_decode_has_no_python_node(spark):
    df = spark.createDataFrame([("0x1", "0x2", "0x3", "0x4")],
                               "value string, gas_price string, effective_gas_price string, "
                               "max_priority_fee_per_gas string")
    plan = decode_hex_columns(df, "txs")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


def test_audit_counts(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", "0x", "0xzz", "0x1", "0x" + "f" * 40]],
                               "value string")
    r = decode_audit(df, "txs").first().asDict()
    assert r == {"kind": "txs", "column": "value", "rows": 6, "nulls": 1, "empties": 1,
                 "zero_markers": 1, "invalid": 1, "too_large": 1, "decoded": 2}


def test_norm_key(spark):
    df = spark.createDataFrame([("0xA9059CBB",)], "k string")
    assert df.select(norm_key("k")).first()[0] == "0xa9059cbb"
    assert df.select(norm_key(F.col("k"))).first()[0] == "0xa9059cbb"


def test_sql_functions(spark):
    from ledgerlake.functions.hexnum import register_sql_functions
    assert register_sql_functions(spark) == ["ll_wei", "ll_hex_int", "ll_norm_key"]
    vals = ["0x", "0xc6f3b40b6c007", "0xzz", None, "0x" + "f" * 40]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    df.createOrReplaceTempView("hexvals")
    got = spark.sql("select ll_wei(v) as w, ll_hex_int(v) as i, ll_norm_key('0xABC') as k "
                    "from hexvals").collect()
    assert [r["w"] for r in got] == [0, Decimal(3_500_000_000_000_007), None, None, None]
    assert [r["i"] for r in got] == [0, 3_500_000_000_000_007, None, None, None]
    assert got[0]["k"] == "0xabc"
    plan = spark.sql("select ll_wei(v) from hexvals")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_trailing_newline_is_invalid(spark):
    assert _wei(spark, ["0x1\n", "0x" + "1" * 20 + "\n", " 0x1", "0x1 "]) == [None] * 4
    assert _int(spark, ["0x1\n", "0x1d5\n"]) == [None, None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(min_value=0, max_value=2 ** 130).map(hex),
                          st.sampled_from(["", "0x", "0xzz", "0x00", "ff", "0x1\n"]),
                          st.none()), min_size=1, max_size=30))
def test_staged_decode_matches_single_expressions(spark, vals):
    df = spark.createDataFrame([(v, v) for v in vals], "value string, log_index string")
    staged = decode_hex_columns(df.select("value"), "txs").collect()
    single = df.select(wei("value")).collect()
    assert [r[0] for r in staged] == [r[0] for r in single]
    staged_i = decode_hex_columns(df.select("log_index"), "events").collect()
    single_i = df.select(hex_int("log_index")).collect()
    assert [r[0] for r in staged_i] == [r[0] for r in single_i]
    assert decode_hex_columns(df, "txs").columns == ["value", "log_index"]
