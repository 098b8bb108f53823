"""The registered queries and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables (or data
Spark derives from them); each oracle is DuckDB SQL over the same tables with
the fixture views inlined as CTEs.  Column names match one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import recipes as R
from ledgerlake.session import apply_result_conf
from ledgerlake.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_result_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = fx.duckdb_with() + oracle
        return run
    return deco


def _bte(spark, sf_dir):
    return (fx.decoded(spark, sf_dir, "blocks"), fx.decoded(spark, sf_dir, "txs"),
            fx.decoded(spark, sf_dir, "events"))


# ------------------------------------------------------------------ recipes
@register("f1_blocks_txs", """
select t.block_number, b.timestamp as block_timestamp, b.base_fee_per_gas,
       t.tx_hash, t.from_address, t.to_address, t.value, t.status
from txs t join blocks b on b.number = t.block_number
""")
def f1(spark, sf_dir):
    b, t, _ = _bte(spark, sf_dir)
    return R.blocks_txs(b, t)


@register("f2_events_per_tx_top20", """
select b.number as block_number, t.tx_hash, t.status, count(e.tx_hash) as event_count
from txs t join blocks b on b.number = t.block_number
left join events e on e.tx_hash = t.tx_hash
group by 1, 2, 3
order by event_count desc, t.tx_hash
limit 20
""")
def f2(spark, sf_dir):
    b, t, e = _bte(spark, sf_dir)
    return R.events_per_tx_top(b, t, e, 20)


@register("f3_tx_detail", """
select t.tx_hash, t.block_number, t.status, b.timestamp as block_timestamp,
       cast(coalesce(ec.n, 0) as bigint) as event_count
from txs t
left join blocks b on b.number = t.block_number
left join (select tx_hash, count(*) as n from events group by tx_hash) ec on ec.tx_hash = t.tx_hash
""")
def f3(spark, sf_dir):
    b, t, e = _bte(spark, sf_dir)
    return R.tx_detail(b, t, e)


@register("f4_failed_txs", """
select * from txs where status = 0
""")
def f4(spark, sf_dir):
    return R.failed_txs(fx.decoded(spark, sf_dir, "txs"))


@register("f5_failed_per_block_top20", """
select block_number, count(*) as failed_txs from txs where status = 0
group by block_number order by failed_txs desc, block_number limit 20
""")
def f5(spark, sf_dir):
    return R.failed_per_block_top(fx.decoded(spark, sf_dir, "txs"), 20)


@register("f6_failed_per_day", """
select date, count(*) filter (where status = 0) as failed_txs, count(*) as txs
from txs group by rollup(date)
""")
def f6(spark, sf_dir):
    return R.failed_per_day(fx.decoded(spark, sf_dir, "txs"))


@register("f7_top_topics", """
select topic0, count(*) as events from events group by topic0
order by events desc, topic0 nulls first limit 10
""")
def f7(spark, sf_dir):
    return R.top_topics(fx.decoded(spark, sf_dir, "events"), 10)


@register("f8_events_per_block_top5", """
select block_number, count(*) as events from events group by block_number
order by events desc, block_number limit 5
""")
def f8(spark, sf_dir):
    return R.events_per_block_top(fx.decoded(spark, sf_dir, "events"), 5)


@register("f9_block_rollup", """
select b.number as block_number, b.timestamp, b.gas_used,
       cast(coalesce(t.tx_count, 0) as bigint) as tx_count,
       cast(coalesce(t.failed_txs, 0) as bigint) as failed_txs,
       cast(coalesce(e.event_count, 0) as bigint) as event_count
from blocks b
left join (select block_number, count(*) as tx_count,
                  count(*) filter (where status = 0) as failed_txs
           from txs group by block_number) t on t.block_number = b.number
left join (select block_number, count(*) as event_count from events group by block_number) e
       on e.block_number = b.number
""")
def f9(spark, sf_dir):
    b, t, e = _bte(spark, sf_dir)
    return R.block_rollup(b, t, e)


@register("f10_row_counts", """
select 'blocks' as kind, date, count(*) as rows from blocks group by date
union all select 'txs' as kind, date, count(*) as rows from txs group by date
union all select 'events' as kind, date, count(*) as rows from events group by date
""")
def f10(spark, sf_dir):
    b, t, e = _bte(spark, sf_dir)
    return R.row_counts({"blocks": b, "txs": t, "events": e})


@register("h3_running_total", """
select date, failed_txs, txs,
       cast(sum(failed_txs) over (order by date rows between unbounded preceding and current row) as bigint) as failed_running,
       cast(sum(txs) over (order by date rows between unbounded preceding and current row) as bigint) as txs_running
from (select date, count(*) filter (where status = 0) as failed_txs, count(*) as txs
      from txs group by date) d
""")
def h3(spark, sf_dir):
    return R.running_totals(fx.decoded(spark, sf_dir, "txs"))


# ------------------------------------------------------------------ decode
from ledgerlake.functions import hexnum as H  # noqa: E402
from ledgerlake.operators import contract as D  # noqa: E402
from ledgerlake.operators import lookups as L  # noqa: E402
from ledgerlake.schemas import INT_COLUMNS, WEI_COLUMNS  # noqa: E402


@register("c1_wei", f"""
select tx_hash, value as value_hex, {fx.duck_wei('value')} as value_wei,
       max_priority_fee_per_gas as tip_hex, {fx.duck_wei('max_priority_fee_per_gas')} as tip_wei
from raw_txs
""")
def c1(spark, sf_dir):
    t = fx.raw(spark, sf_dir, "txs")
    return t.select("tx_hash", F.col("value").alias("value_hex"), H.wei("value").alias("value_wei"),
                    F.col("max_priority_fee_per_gas").alias("tip_hex"),
                    H.wei("max_priority_fee_per_gas").alias("tip_wei"))


@register("c2_log_index", f"""
select tx_hash, block_number, log_index as log_index_hex, {fx.duck_int('log_index')} as log_index
from raw_events
""")
def c2(spark, sf_dir):
    e = fx.raw(spark, sf_dir, "events")
    return e.select("tx_hash", "block_number", F.col("log_index").alias("log_index_hex"),
                    H.hex_int("log_index").alias("log_index"))


@register("c3_decode_txs", """
select * from txs
""")
def c3(spark, sf_dir):
    return H.decode_hex_columns(fx.raw(spark, sf_dir, "txs"), "txs")


def _duck_audit(kind: str) -> str:
    parts = []
    for name in WEI_COLUMNS[kind] + INT_COLUMNS[kind]:
        dec = fx.duck_wei(name) if name in WEI_COLUMNS[kind] else fx.duck_int(name)
        pat = f"regexp_matches({name}, '^0[xX][0-9a-fA-F]+$')"
        parts.append(f"""select '{kind}' as kind, '{name}' as "column", count(*) as rows,
  count(*) filter (where {name} is null) as nulls,
  count(*) filter (where {name} = '') as empties,
  count(*) filter (where {name} = '0x') as zero_markers,
  count(*) filter (where {name} is not null and {name} <> '' and {name} <> '0x' and not {pat}) as invalid,
  count(*) filter (where {pat} and ({dec}) is null) as too_large,
  count(*) filter (where ({dec}) is not null) as decoded
from raw_{kind}""")
    return "\nunion all\n".join(parts)


@register("c4_audit", "\nunion all\n".join(_duck_audit(k) for k in ("blocks", "txs", "events")))
def c4(spark, sf_dir):
    parts = [H.decode_audit(fx.raw(spark, sf_dir, k), k) for k in ("blocks", "txs", "events")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("c5_key_norm", """
select t.tx_hash, lower(upper(t.input_prefix)) as key, b.signature
from txs t left join (
  select key, arg_min(signature, struct_pack(neg := -coalesce(count, 0), p := pos)) as signature
  from selector_candidates group by key) b
on b.key = lower(upper(t.input_prefix))
""")
def c5(spark, sf_dir):
    t = fx.decoded(spark, sf_dir, "txs").select("tx_hash", F.upper("input_prefix").alias("shouted"))
    out = L.label(t, "shouted", fx.candidates(spark, sf_dir, "selector"))
    return out.select("tx_hash", H.norm_key("shouted").alias("key"), "signature")


# ------------------------------------------------------------------ integrity
_D3 = """
select 'dup_block_number' as "check", count(*) as violations, min(cast(number as varchar)) as example
from (select number from blocks group by number having count(*) > 1) d
union all
select 'dup_event_key', count(*), min(concat_ws(':', cast(block_number as varchar), cast(log_index as varchar)))
from (select block_number, log_index from events group by block_number, log_index having count(*) > 1) d
union all
select 'tx_without_block', count(*), min(tx_hash)
from txs t where not exists (select 1 from blocks b where b.number = t.block_number)
union all
select 'event_without_block', count(*), min(tx_hash)
from events e where not exists (select 1 from blocks b where b.number = e.block_number)
union all
select 'event_block_mismatch', count(*), min(e.tx_hash)
from events e join txs t on t.tx_hash = e.tx_hash where e.block_number <> t.block_number
"""


@register("d3_contract", _D3)
def d3(spark, sf_dir):
    b, t, e = _bte(spark, sf_dir)
    return D.contract_checks(b, t, e)


# ------------------------------------------------------------------ lookups
_DUCK_BEST = """(select key, arg_min(signature, struct_pack(neg := -coalesce(count, 0), p := pos)) as signature,
        arg_min(abi, struct_pack(neg := -coalesce(count, 0), p := pos)) as abi
 from {c} group by key)"""


@register("e2_candidates", """
select key, signature, count, pos, abi,
       row_number() over (partition by key order by coalesce(count, 0) desc, pos) as rank
from selector_candidates where key in (select lower(input_prefix) from txs)
""")
def e2(spark, sf_dir):
    return L.resolve_keys(fx.candidates(spark, sf_dir, "selector"),
                          fx.decoded(spark, sf_dir, "txs"), "input_prefix")


@register("e3_best", """
select key, arg_min(signature, struct_pack(neg := -coalesce(count, 0), p := pos)) as signature,
       arg_min(count, struct_pack(neg := -coalesce(count, 0), p := pos)) as count,
       arg_min(abi, struct_pack(neg := -coalesce(count, 0), p := pos)) as abi
from selector_candidates group by key
""")
def e3(spark, sf_dir):
    return L.best_candidates(fx.candidates(spark, sf_dir, "selector"))


@register("e4_label_txs", f"""
select t.*, b.signature, b.abi
from txs t left join {_DUCK_BEST.format(c='selector_candidates')} b on b.key = lower(t.input_prefix)
""")
def e4(spark, sf_dir):
    return L.label_txs(fx.decoded(spark, sf_dir, "txs"), fx.candidates(spark, sf_dir, "selector"))


@register("e5_label_events", f"""
select e.*, b.signature, b.abi
from events e left join {_DUCK_BEST.format(c='topic_candidates')} b on b.key = lower(e.topic0)
""")
def e5(spark, sf_dir):
    return L.label_events(fx.decoded(spark, sf_dir, "events"), fx.candidates(spark, sf_dir, "topic"))


@register("e6_all_candidates", """
select t.tx_hash, t.input_prefix, c.n_candidates, c.candidate_signatures, c.candidate_counts
from txs t left join (
  select key, count(*) as n_candidates,
         string_agg(signature, ';' order by coalesce(count, 0) desc, pos) as candidate_signatures,
         string_agg(cast(count as varchar), ';' order by coalesce(count, 0) desc, pos) as candidate_counts
  from selector_candidates group by key) c on c.key = lower(t.input_prefix)
""")
def e6(spark, sf_dir):
    t = fx.decoded(spark, sf_dir, "txs").select("tx_hash", "input_prefix")
    out = L.all_candidates(t, "input_prefix", fx.candidates(spark, sf_dir, "selector"))
    return out.select(
        "tx_hash", "input_prefix",
        F.when(F.col("candidates").isNotNull(), F.size("candidates").cast("bigint")).alias("n_candidates"),
        F.array_join(F.transform("candidates", lambda x: x["signature"]), ";").alias("candidate_signatures"),
        F.array_join(F.transform("candidates", lambda x: x["count"].cast("string")), ";").alias("candidate_counts"))


# The same over a lookup that may not be broadcast: the split join.
@register("e4_label_txs_split", f"""
select t.*, b.signature, b.abi
from txs t left join {_DUCK_BEST.format(c='selector_candidates')} b on b.key = lower(t.input_prefix)
""")
def e4_split(spark, sf_dir):
    return L.label_txs(fx.decoded(spark, sf_dir, "txs"), fx.candidates(spark, sf_dir, "selector"), limit=0)


@register("e5_label_events_split", f"""
select e.*, b.signature, b.abi
from events e left join {_DUCK_BEST.format(c='topic_candidates')} b on b.key = lower(e.topic0)
""")
def e5_split(spark, sf_dir):
    return L.label_events(fx.decoded(spark, sf_dir, "events"), fx.candidates(spark, sf_dir, "topic"), limit=0)


@register("e7_unresolved", """
select lower(input_prefix) as key, count(*) as rows from txs
where input_prefix is not null and input_prefix not in ('', '0x')
  and lower(input_prefix) not in (select key from selector_candidates)
group by lower(input_prefix)
union all
select lower(topic0) as key, count(*) as rows from events
where topic0 is not null and topic0 not in ('', '0x')
  and lower(topic0) not in (select key from topic_candidates)
group by lower(topic0)
""")
def e7(spark, sf_dir):
    a = L.unresolved(fx.decoded(spark, sf_dir, "txs"), "input_prefix",
                     fx.candidates(spark, sf_dir, "selector"))
    b = L.unresolved(fx.decoded(spark, sf_dir, "events"), "topic0",
                     fx.candidates(spark, sf_dir, "topic"))
    return a.unionByName(b)


# ------------------------------------------------------------------ catalog
from ledgerlake.operators import catalog as A  # noqa: E402

# Fixed parameters of the registered catalog queries: the whole fixture span, and one
# that cuts days at both ends.
SPAN = ("1990-01-01", "2100-12-31")
CUT = ("1997-03-05", "2000-11-20")
BASE = "/data/archive"

_DUCK_RESOLVED = """(select date, kind, arg_min(key, pos) as key, arg_min(size, pos) as size,
        arg_min(md5, pos) as md5, arg_min(schema_version, pos) as schema_version, min(pos) as pos
 from {m} group by date, kind)"""


@register("a3_available_dates", """
select distinct cast(date as date) as date from manifest_files where kind = 'events'
""")
def a3(spark, sf_dir):
    return A.available_dates(fx.manifest_files(spark, sf_dir), "events")


@register("a4_latest_complete", """
select max(d) as latest_complete_date, cast(null as date) as declared_latest_complete_date
from (select cast(date as date) as d from manifest_files group by 1
      having count(distinct kind) = 3) c
""")
def a4(spark, sf_dir):
    return A.latest_complete(fx.manifest_files(spark, sf_dir))


@register("a5_entry", f"select * from {_DUCK_RESOLVED.format(m='manifest_files')} r")
def a5(spark, sf_dir):
    return A.resolve(fx.manifest_files(spark, sf_dir))


@register("a6_range", f"""
select * from {_DUCK_RESOLVED.format(m='manifest_files')} r
where kind = 'events' and date between '{SPAN[0]}' and '{SPAN[1]}'
""")
def a6(spark, sf_dir):
    return A.range_entries(fx.manifest_files(spark, sf_dir), SPAN[0], SPAN[1], "events")


@register("a7_locate", f"""
select *, concat('{BASE}', '/', key) as url from {_DUCK_RESOLVED.format(m='manifest_files')} r
where kind = 'txs' and date between '{SPAN[0]}' and '{SPAN[1]}'
""")
def a7(spark, sf_dir):
    return A.locate(A.range_entries(fx.manifest_files(spark, sf_dir), SPAN[0], SPAN[1], "txs"), BASE)


@register("a4_latest_declared", """
select max(d) as latest_complete_date, date'1997-03-04' as declared_latest_complete_date
from (select cast(date as date) as d from manifest_files group by 1
      having count(distinct kind) = 3) c
""")
def a4_declared(spark, sf_dir):
    """A manifest that declares another day than its files give."""
    return A.latest_complete(fx.manifest_files(spark, sf_dir), "1997-03-04")


@register("a6_range_cut", f"""
select * from {_DUCK_RESOLVED.format(m='manifest_files')} r
where kind = 'events' and date between '{CUT[0]}' and '{CUT[1]}'
""")
def a6_cut(spark, sf_dir):
    return A.range_entries(fx.manifest_files(spark, sf_dir), CUT[0], CUT[1], "events")


@register("a7_locate_cut", f"""
select *, concat('{BASE}', '/', key) as url from {_DUCK_RESOLVED.format(m='manifest_files')} r
where kind = 'txs' and date between '{CUT[0]}' and '{CUT[1]}'
""")
def a7_cut(spark, sf_dir):
    return A.locate(A.range_entries(fx.manifest_files(spark, sf_dir), CUT[0], CUT[1], "txs"), BASE)


# Entries planted among the manifest's: every rule of A2 broken, alone and together.
_PLANTED = """
select pos, case when pos % 13 = 1 then concat(substr(date, 1, 5), '13-45') when pos % 13 = 2 then null else date end as date,
       case when pos % 13 = 3 then 'logs' else kind end as kind,
       case when pos % 13 = 4 then concat('daily/../', key) when pos % 13 = 8 then 'x.parquet' else key end as key,
       case when pos % 13 in (5, 8) then -1 else size end as size,
       case when pos % 13 = 6 then upper(md5) when pos % 13 = 7 then substr(md5, 1, 31) else md5 end as md5,
       schema_version
from {files}
"""


@register("a2_planted_entries", f"""
select pos, date, kind, key, size, md5, schema_version,
       case pos % 13 when 1 then 'date' when 2 then 'date' when 3 then 'kind' when 4 then 'key'
            when 5 then 'size' when 6 then 'md5' when 7 then 'md5' else 'size,key' end as violations
from ({_PLANTED.replace('{files}', 'manifest_files')}) p where pos % 13 between 1 and 8
""")
def a2_planted(spark, sf_dir):
    planted = spark.sql(_PLANTED, files=fx.manifest_files(spark, sf_dir))
    bad = A.split_valid(A.file_violations(planted))[1]
    return bad.withColumn("violations", F.array_join("violations", ","))


@register("a8_summary", """
select kind, count(*) as files, cast(sum(size) as bigint) as bytes, min(date) as first_date,
       max(date) as last_date, cast(sum(size) / 1073741824.0 as decimal(20,3)) as gib
from manifest_files group by rollup(kind)
""")
def a8(spark, sf_dir):
    return A.summary(fx.manifest_files(spark, sf_dir))


@register("a9_gaps", """
select kind, prev, cur, cast(datediff('day', prev, cur) - 1 as bigint) as missing_days
from (select kind, lag(d) over (partition by kind order by d) as prev, d as cur
      from (select distinct kind, cast(date as date) as d from manifest_files) x) y
where prev is not null and datediff('day', prev, cur) > 1
""")
def a9(spark, sf_dir):
    return A.gaps(fx.manifest_files(spark, sf_dir))


@register("a10_diff", f"""
select coalesce(p.date, c.date) as date, coalesce(p.kind, c.kind) as kind,
       case when p.md5 is null and p.size is null then 'new'
            when c.md5 is null and c.size is null then 'vanished'
            else 'rebuilt' end as status,
       p.md5 as old_md5, c.md5 as new_md5, p.size as old_size, c.size as new_size
from {_DUCK_RESOLVED.format(m='manifest_prev')} p
full outer join {_DUCK_RESOLVED.format(m='manifest_files')} c on p.date = c.date and p.kind = c.kind
where p.date is null or c.date is null or p.md5 <> c.md5 or p.size <> c.size
""")
def a10(spark, sf_dir):
    return A.diff(fx.manifest_files(spark, sf_dir, previous=True), fx.manifest_files(spark, sf_dir))


# ------------------------------------------------------------------ scans
from ledgerlake.sources.archive import Archive, column_conformance  # noqa: E402
from ledgerlake.sources.writer import fixture_archive, fixture_tag, flawed_archive  # noqa: E402

_LATEST = "(select max(date) from txs)"


_ARCHIVES: dict[tuple, Archive] = {}


def _archive(spark, sf_dir) -> Archive:
    """The fixture archive, reopened only when its manifest file changes."""
    from ledgerlake.streaming.ingest import _fs
    root = fixture_archive(spark, sf_dir)
    fs, p = _fs(spark, f"{root}/manifest.json")
    st = fs.getFileStatus(p)
    key = (spark.sparkContext.applicationId, root, st.getLen(), st.getModificationTime())
    if key not in _ARCHIVES:
        _ARCHIVES[key] = Archive(spark, root)
    return _ARCHIVES[key]


def _flawed(spark, sf_dir) -> Archive:
    """The archive with flawed files; nothing is verified on open."""
    return Archive(spark, flawed_archive(spark, sf_dir), verify=False)


@register("b1_day_txs", f"""
select * exclude (date) from txs where date = {_LATEST}
""")
def b1(spark, sf_dir):
    a = _archive(spark, sf_dir)
    return a.load_day(a.latest_complete_date(), "txs")


@register("b2_range_txs", """
select * from txs
""")
def b2(spark, sf_dir):
    return _archive(spark, sf_dir).load_range(SPAN[0], SPAN[1], "txs")


@register("b2_range_cut", f"""
select * from events where date between '{CUT[0]}' and '{CUT[1]}'
""")
def b2_cut(spark, sf_dir):
    return _archive(spark, sf_dir).load_range(CUT[0], CUT[1], "events")


@register("b5_rows_range_cut", f"""
select block_number, max_priority_fee_per_gas, value from txs where date between '{CUT[0]}' and '{CUT[1]}'
""")
def b5_cut(spark, sf_dir):
    """Days before the second version lack one of the columns."""
    return _archive(spark, sf_dir).rows_range(CUT[0], CUT[1], "txs", ["block_number", "max_priority_fee_per_gas", "value"])


@register("b3_per_day", """
select date, count(*) as txs, count(*) filter (where status = 0) as failed_txs,
       sum(value) as value_wei
from txs group by date
""")
def b3(spark, sf_dir):
    t = _archive(spark, sf_dir).load_range(SPAN[0], SPAN[1], "txs")
    return t.groupBy("date").agg(F.count(F.lit(1)).alias("txs"),
                                 F.count_if(F.col("status") == 0).alias("failed_txs"),
                                 F.sum("value").alias("value_wei"))


@register("b4_rows_projected", f"""
select tx_hash, log_index, topic0 from events where date = {_LATEST}
""")
def b4(spark, sf_dir):
    a = _archive(spark, sf_dir)
    return a.rows(a.latest_complete_date(), "events", ["tx_hash", "log_index", "topic0"])


@register("b5_rows_range", """
select block_number, topic0 from events
""")
def b5(spark, sf_dir):
    return _archive(spark, sf_dir).rows_range(SPAN[0], SPAN[1], "events", ["block_number", "topic0"])


_F2_SQL = """
select b.number as block_number, t.tx_hash, t.status, count(e.tx_hash) as event_count
from {p}txs t join {p}blocks b on b.number = t.block_number
left join {p}events e on e.tx_hash = t.tx_hash
group by 1, 2, 3
order by event_count desc, t.tx_hash
limit 20
"""


@register("b6_open_day_sql", f"""
select b.number as block_number, t.tx_hash, t.status, count(e.tx_hash) as event_count
from (select * from txs where date = {_LATEST}) t
join (select * from blocks where date = {_LATEST}) b on b.number = t.block_number
left join (select * from events where date = {_LATEST}) e on e.tx_hash = t.tx_hash
group by 1, 2, 3 order by event_count desc, t.tx_hash limit 20
""")
def b6(spark, sf_dir):
    a = _archive(spark, sf_dir)
    a.open_day(a.latest_complete_date(), prefix="ll_day_")
    return spark.sql(_F2_SQL.format(p="ll_day_"))


@register("b7_open_range_sql", """
select block_number, count(*) as failed_txs from txs where status = 0
group by block_number order by failed_txs desc, block_number limit 20
""")
def b7(spark, sf_dir):
    _archive(spark, sf_dir).open_range(SPAN[0], SPAN[1], prefix="ll_range_")
    return spark.sql("""
        select block_number, count(*) as failed_txs from ll_range_txs where status = 0
        group by block_number order by failed_txs desc, block_number limit 20""")


@register("b8_day_lineage", """
select date, block_number, tx_hash, log_index from events
""")
def b8(spark, sf_dir):
    e = _archive(spark, sf_dir).load_range(SPAN[0], SPAN[1], "events",
                                           columns=["block_number", "tx_hash", "log_index"])
    return e.select("date", "block_number", "tx_hash", "log_index")


@register("b9_head", f"""
select * exclude (date) from events where date = {_LATEST}
order by block_number nulls first, log_index nulls first, tx_hash nulls first,
         address nulls first, topic0 nulls first, topic1 nulls first, topic2 nulls first,
         topic3 nulls first, data nulls first
limit 20
""")
def b9(spark, sf_dir):
    a = _archive(spark, sf_dir)
    return a.head(a.latest_complete_date(), "events", 20)


@register("f11_sql", _F2_SQL.format(p=""))
def f11(spark, sf_dir):
    from ledgerlake.sources.archive import register_views
    b, t, e = _bte(spark, sf_dir)
    register_views({"blocks": b, "txs": t, "events": e}, prefix="ll_fx_")
    return spark.sql(_F2_SQL.format(p="ll_fx_"))


# ------------------------------------------------ operators checked by rows
# (file bytes, footers, streams): registered without an oracle unless one is
# expressible over the same tables.
from ledgerlake.operators import integrity as I  # noqa: E402
from ledgerlake.session import scratch_path  # noqa: E402
from ledgerlake.sources import lookups as LK  # noqa: E402
from ledgerlake.schemas import KINDS  # noqa: E402
from ledgerlake.sources import manifest as M  # noqa: E402
from ledgerlake.streaming import ingest as ING  # noqa: E402


def _kept(df, *paths):
    """``df`` as it is now; the scratch folders it came from go."""
    out = df.checkpoint()
    _removed(df.sparkSession, *paths)
    return out


def _removed(spark, *paths):
    for path in paths:
        fs, p = ING._fs(spark, path)
        fs.delete(p, True)


_DAYS = " union all ".join(
    f"select distinct cast(date as varchar) as date, '{k}' as kind from {k}" for k in KINDS)


@register("a1_manifest_files", f"""
select date, kind, 'daily/' || date || '.' || kind || '.parquet' as key,
       case when date < '{fx.FIRST_V2}' then 'v1' else 'v2' end as schema_version
from ({_DAYS}) d
""")
def a1(spark, sf_dir):
    m = M.read_manifest(spark, fixture_archive(spark, sf_dir))
    return M.files_table(m).select("date", "kind", "key", "schema_version")


@register("a2_rejected_entries", """
select pos, date, kind, key, size, md5, schema_version, [''] as violations from manifest_files where false
""")
def a2(spark, sf_dir):
    return A.split_valid(A.file_violations(_archive(spark, sf_dir).files()))[1]


@register("a11_conformance", f"""
select distinct cast(date as varchar) as date, 'txs' as kind,
       concat('daily/', cast(date as varchar), '.txs.parquet') as key, 'max_priority_fee_per_gas' as "column",
       8 as declared_position, cast(null as int) as file_position, 'missing' as problem
from txs where date < '{fx.FIRST_V2}'
""")
def a11(spark, sf_dir):
    return _archive(spark, sf_dir).conformance()


# Of the flawed archive: day of 1970 mod 11 says what is wrong with a file.
_FLAW = """(select distinct cast(date as varchar) as date, concat('daily/', cast(date as varchar), '.blocks.parquet') as key,
  datediff('day', date'1970-01-01', date) % 11 as k from blocks)"""


@register("a11_conformance_flawed", f"""
select date, 'blocks' as kind, key, "column", declared_position, file_position, problem
from {_FLAW} d join (values
  (1, 'gas_limit', 3, cast(null as int), 'missing'), (2, 'note', cast(null as int), 5, 'extra'),
  (3, 'gas_limit', 3, 2, 'out_of_order'), (3, 'gas_used', 2, 3, 'out_of_order'))
  f(k, "column", declared_position, file_position, problem) using (k)
""")
def a11_flawed(spark, sf_dir):
    a = _flawed(spark, sf_dir)
    whole = A.split_valid(A.file_violations(a.files()))[0]
    fit = I.verify_objects(spark, a.root, whole).where(F.col("status") == I.OK).select("key")
    return column_conformance(spark, a.root, whole.join(fit, "key", "left_semi"), M.columns_table(a.manifest))


_OBJECTS = f"""
select date, kind, 'STATUS' as status from ({_DAYS}) d
union all select cast(null as varchar), 'function_selectors', 'STATUS'
union all select cast(null as varchar), 'event_topics', 'STATUS'
"""


def _objects(spark, a):
    """Files and lookups of the archive as entries."""
    looks = M.lookups_table(a.manifest).select(
        F.lit(None).cast("string").alias("date"), F.col("name").alias("kind"), "key", "size", "md5",
        F.lit(None).cast("string").alias("schema_version"))
    return a.files().select("date", "kind", "key", "size", "md5", "schema_version").union(looks)


@register("d1_verify", _OBJECTS.replace("STATUS", "ok"))
def d1(spark, sf_dir):
    a = _archive(spark, sf_dir)
    return I.verify_objects(spark, a.root, _objects(spark, a)).select("date", "kind", "status")


@register("d2_mirror", _OBJECTS.replace("STATUS", "copied"))
def d2(spark, sf_dir):
    a = _archive(spark, sf_dir)
    to = scratch_path(spark, "mirror", unique=True)
    return _kept(I.mirror(spark, a.root, to, _objects(spark, a)).select("date", "kind", "status"), to)


_FLAWED = f"""
select date, 'blocks' as kind, case k when 4 then 'missing' when 5 then 'size_mismatch'
       when 6 then 'md5_mismatch' else 'STATUS' end as status from {_FLAW} d
"""


@register("d1_verify_flawed", _FLAWED.replace("STATUS", "ok"))
def d1_flawed(spark, sf_dir):
    """Files that are not there, cut off or altered, twice: the second time by the ledger."""
    a = _flawed(spark, sf_dir)
    ledger = I.Ledger(spark, a.root, scratch_path(spark, "ledger", unique=True), chunk=1024)
    ledger.check(a.files())
    return _kept(ledger.check(a.files()).select("date", "kind", "status"), ledger.folder)


@register("d2_mirror_flawed", _FLAWED.replace("STATUS", "copied"))
def d2_flawed(spark, sf_dir):
    a = _flawed(spark, sf_dir)
    to = scratch_path(spark, "mirror", unique=True)
    return _kept(I.mirror(spark, a.root, to, a.files(), chunk=1024).select("date", "kind", "status"), to)


@register("e1_lookup_rows", """
select key, pos, signature, count, abi from selector_candidates
union all
select key, pos, signature, count, abi from topic_candidates
""")
def e1(spark, sf_dir):
    root = fixture_archive(spark, sf_dir)
    return (LK.read_lookup(spark, f"{root}/lookups/function_selectors.json")
              .unionByName(LK.read_lookup(spark, f"{root}/lookups/event_topics.json")))


def _ingested(spark, sf_dir, kind):
    a = _archive(spark, sf_dir)
    lake = scratch_path(spark, f"lake-{fixture_tag(sf_dir, spark)}")
    ING.ingest(spark, a, lake, kinds=(kind,))
    return ING.read_lake(spark, lake, kind)


@register("h1_ingest_txs", """
select * from txs
""")
def h1(spark, sf_dir):
    return _ingested(spark, sf_dir, "txs")


@register("h1_ingest_blocks", """
select * from blocks
""")
def h1_blocks(spark, sf_dir):
    return _ingested(spark, sf_dir, "blocks")


@register("h1_ingest_events", """
select * from events
""")
def h1_events(spark, sf_dir):
    return _ingested(spark, sf_dir, "events")


@register("d3_contract_incremental", _D3)
def d3_incremental(spark, sf_dir):
    """The checks kept by changed days: half of the lake first, then the rest."""
    a = _archive(spark, sf_dir)
    lake = scratch_path(spark, "lake-d3", unique=True)
    for end in ("1999-06-30", None):
        ING.ingest(spark, a, lake, end=end)
        D.ContractState(spark, lake).update()
    return _kept(D.ContractState(spark, lake).report(), lake)


@register("h3_running_refresh", """
select date, failed_txs, txs,
       cast(sum(failed_txs) over (order by date rows between unbounded preceding and current row) as bigint) as failed_running,
       cast(sum(txs) over (order by date rows between unbounded preceding and current row) as bigint) as txs_running
from (select date, count(*) filter (where status = 0) as failed_txs, count(*) as txs
      from txs group by date) d
""")
def h3_refresh(spark, sf_dir):
    """Totals kept by changed days: days from 1997 on first, then the earlier ones."""
    a = _archive(spark, sf_dir)
    home = scratch_path(spark, "lake-h3", unique=True)
    for start in ("1997-02-10", None):
        done = ING.ingest(spark, a, f"{home}/lake", kinds=("txs",), start=start)
        ING.refresh_running_totals(spark, f"{home}/lake", f"{home}/totals", done)
    return _kept(spark.read.parquet(f"{home}/totals").drop("month"), home)


@register("h2_follow_blocks", """
select * from blocks
""")
def h2(spark, sf_dir):
    """Two snapshots of a growing archive; the second adds days and rebuilds others."""
    from ledgerlake.sources.writer import write_archive
    home = scratch_path(spark, "follow", unique=True)
    root, snaps, lake, ckpt = (f"{home}/{x}" for x in ("archive", "snapshots", "lake", "checkpoint"))
    blocks = fx.raw(spark, sf_dir, "blocks")
    old = blocks.where("date < date'2000-01-01'").withColumn(
        "gas_used", F.when(F.dayofmonth("date") == 15, F.lit(0).cast("long")).otherwise(F.col("gas_used")))
    for name, rows in (("1.json", old), ("2.json", blocks)):
        write_archive(spark, {"blocks": rows}, root)
        ING.snapshot(root, snaps, name)
        ING.follow(spark, Archive(spark, root), snaps, lake, ckpt, kinds=("blocks",), max_bytes=1 << 20)
    return _kept(ING.read_lake(spark, lake, "blocks"), home)


def _replayed(spark, sf_dir, kind):
    a = _archive(spark, sf_dir)
    mirror_root = scratch_path(spark, f"mirror-{kind}", unique=True)
    I.mirror_range(spark, a, mirror_root, SPAN[0], SPAN[1], kinds=(kind,))
    run = scratch_path(spark, "replay", unique=True)
    ING.replay(spark, mirror_root, kind, f"{run}/sink", f"{run}/ckpt")
    _removed(spark, mirror_root, f"{run}/ckpt")
    return spark.read.parquet(f"{run}/sink")  # written once, by this run alone: no copy is taken


@register("h4_replay_txs", """
select * from txs
""")
def h4(spark, sf_dir):
    return _replayed(spark, sf_dir, "txs")


@register("h4_replay_blocks", """
select * from blocks
""")
def h4_blocks(spark, sf_dir):
    return _replayed(spark, sf_dir, "blocks")


@register("h4_replay_events", """
select * from events
""")
def h4_events(spark, sf_dir):
    return _replayed(spark, sf_dir, "events")


_COUNTS = """
select 'blocks' as kind, date, count(*) as rows from blocks group by date
union all select 'txs' as kind, date, count(*) as rows from txs group by date
union all select 'events' as kind, date, count(*) as rows from events group by date
"""


@register("f10_row_counts_footers", _COUNTS)
def f10_footers(spark, sf_dir):
    """F10 of the archive's files from their footers alone."""
    from ledgerlake.sources import footers
    return footers.row_counts(_archive(spark, sf_dir).footers())


@register("a8_block_ranges", """
select kind, date, count(*) as rows, min(b) as first_block, max(b) as last_block from (
  select 'blocks' as kind, date, number as b from blocks
  union all select 'txs', date, block_number from txs
  union all select 'events', date, block_number from events) x
group by kind, date
""")
def a8_ranges(spark, sf_dir):
    from ledgerlake.sources import footers
    return footers.block_ranges(_archive(spark, sf_dir).footers()).drop("row_groups", "bytes")


_TEXT_TXS = """
select block_number, tx_hash, from_address, to_address, cast(value as varchar) as value, gas_used,
       cast(effective_gas_price as varchar) as effective_gas_price, cast(gas_price as varchar) as gas_price,
       cast(max_priority_fee_per_gas as varchar) as max_priority_fee_per_gas, type, status, {prefix} as input_prefix,
       date
from txs
"""


def _published(spark, sf_dir, form, **options):
    """Written twice, read back by the manifest of the second publication."""
    from ledgerlake import sinks
    path = scratch_path(spark, f"published-{form}", unique=True)
    txs = fx.decoded(spark, sf_dir, "txs")
    if form == "parquet":  # a file a day
        txs = txs.repartition("date")
    sinks.publish(txs.where("status = 0"), path, form, **options)
    sinks.publish(txs, path, form, **options)
    return _kept(sinks.published(spark, path, verify=True), path)


@register("g1_ndjson", _TEXT_TXS.format(prefix="input_prefix"))
def g1(spark, sf_dir):
    return _published(spark, sf_dir, "ndjson")


# CSV has one empty value: an empty selector comes back as null.
@register("g2_csv", _TEXT_TXS.format(prefix="nullif(input_prefix, '')"))
def g2(spark, sf_dir):
    return _published(spark, sf_dir, "csv")


@register("g3_parquet", """
select * from txs
""")
def g3(spark, sf_dir):
    return _published(spark, sf_dir, "parquet")


@register("f11_sql_raw_decode", f"""
select date, count(*) as txs, sum({fx.duck_wei('value')}) as value_wei,
       sum({fx.duck_wei('gas_price')}) as gas_price_wei
from raw_txs group by date
""")
def f11_raw(spark, sf_dir):
    from ledgerlake.sources.archive import register_views
    register_views({"txs": fx.raw(spark, sf_dir, "txs")}, prefix="ll_raw_")
    return spark.sql("""
        select date, count(*) as txs, sum(ll_wei(value)) as value_wei,
               sum(ll_wei(gas_price)) as gas_price_wei
        from ll_raw_txs group by date""")
