"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan assertions for the choices the design depends on."""

import hashlib
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = dict(zip(dcols, (str(d[1]) for d in cur.description)))
    want = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN", "double": "DOUBLE"}
    spark_types = {f.name: want.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    assert spark_types == dtypes
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["block_number", "tx_hash", "status", "event_count"]
    assert 0 < df.count() <= 20


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_is_take_ordered(spark):
    plan = _plan(E.queries()["f5_failed_per_block_top20"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_no_python_in_sql_expressible_queries(spark):
    for name in ("f2_events_per_tx_top20", "c3_decode_txs", "e4_label_txs", "d3_contract"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_scan_prunes_and_pushes(spark, scratch):
    from ledgerlake.sources.writer import fixture_archive
    from ledgerlake.sources.archive import Archive
    from ledgerlake.operators import recipes as R
    a = Archive(spark, fixture_archive(spark, SF_SMALL))
    t = a.load_range("1990-01-01", "2100-01-01", "txs")
    plan = _plan(R.failed_per_block_top(t))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,0)]" in plan
    # (a generated row index may stand behind the two columns that are read)
    assert "ReadSchema: struct<block_number:bigint,status:bigint" in plan


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    n = df.count()
    assert n >= 0 and len(df.columns) > 0
    if name in ("a2_rejected_entries", "a11_conformance"):
        assert n == 0


def test_failed_count_and_running_totals_agree(spark):
    from ledgerlake.operators import recipes as R
    from ledgerlake.sources import fixtures as fx
    txs = fx.decoded(spark, SF_SMALL, "txs")
    n = R.failed_count(txs).first()["failed_txs"]
    assert n == R.failed_txs(txs).count()
    per_day = R.failed_per_day(txs).filter("date is null").first()
    assert per_day["failed_txs"] == n
    last = R.running_totals(txs).orderBy("date", ascending=False).first()
    assert last["failed_running"] == n and last["txs_running"] == per_day["txs"]
