"""Archive-shaped views derived from the driver's TPC-H-style tables.

One order is one transaction, one order day is one block, one line item is one
event log.  Each view is written once as a SQL template and rendered for two
dialects: Spark (run here, with DataFrames substituted for the tables) and
DuckDB (the oracle).  The same text in both engines keeps the stand-in data
identical; the decode on top of it is *not* shared (Spark uses
:mod:`ledgerlake.functions.hexnum`, the oracle an independent hugeint cast).

Every view scales with the tables it reads; nothing is sampled or capped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.hexnum import decode_hex_columns

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Dialect macros (fixed text per engine).
_MACROS = {
    "spark": {
        "SHA": lambda x: f"sha2({x}, 256)",
        "DAYNO": lambda t: f"cast(datediff(cast({t} as date), date'1995-01-01') as bigint)",
        "EPOCH": lambda t: f"(cast(datediff(cast({t} as date), date'1970-01-01') as bigint) * 86400)",
    },
    "duckdb": {
        "SHA": lambda x: f"sha256({x})",
        "DAYNO": lambda t: f"cast(datediff('day', date'1995-01-01', cast({t} as date)) as bigint)",
        "EPOCH": lambda t: f"(cast(datediff('day', date'1970-01-01', cast({t} as date)) as bigint) * 86400)",
    },
}

TEMPLATES = {
    "raw_blocks": """
select DAYNO(o_orderdate) as number, EPOCH(min(o_orderdate)) as timestamp,
       cast(sum(21000 + o_orderkey % 1000) as bigint) as gas_used,
       cast(15000000 as bigint) as gas_limit,
       case when DAYNO(o_orderdate) < 1000 then null
            else concat('0x', lower(hex(25000000000 + DAYNO(o_orderdate) * 1000))) end as base_fee_per_gas,
       cast(o_orderdate as date) as date
from $orders group by DAYNO(o_orderdate), cast(o_orderdate as date)
""",
    "raw_txs": """
select DAYNO(o_orderdate) as block_number,
       concat('0x', SHA(cast(o_orderkey as varchar(30)))) as tx_hash,
       concat('0x', substr(SHA(concat('c', cast(o_custkey as varchar(30)))), 1, 40)) as from_address,
       case when o_orderkey % 17 = 0 then null
            else concat('0x', substr(SHA(concat('t', cast(o_orderkey % 50 as varchar(30)))), 1, 40)) end as to_address,
       case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then ''
            when o_orderkey % 107 = 0 then '0x' when o_orderkey % 109 = 0 then '0xzz'
            when o_orderkey % 113 = 0 then concat('0x', repeat('f', 40))
            when o_orderkey % 127 = 0 then concat('0X', hex(o_orderkey))
            else concat('0x', lower(hex(cast(round(o_totalprice * 100) as bigint))), '0000000000000000') end as value,
       cast(21000 + o_orderkey % 1000 as bigint) as gas_used,
       concat('0x', lower(hex(25000000000 + o_orderkey))) as effective_gas_price,
       concat('0x', lower(hex(25000000000 + o_orderkey))) as gas_price,
       case when o_orderkey % 3 = 2 and cast(o_orderdate as date) >= date'FIRST_V2'
            then concat('0x', lower(hex(o_orderkey))) end as max_priority_fee_per_gas,
       cast(o_orderkey % 3 as bigint) as type,
       cast(case when o_orderstatus = 'F' then 0 else 1 end as bigint) as status,
       case when o_orderkey % 5 = 0 then '' when o_orderkey % 7 = 0 then '0x'
            when o_orderkey % 3 = 1
              then concat('0x', substr(SHA(concat('k', cast(o_custkey as varchar(30)))), 1, 8))
            else concat('0x', substr(SHA(o_orderpriority), 1, 8)) end as input_prefix,
       cast(o_orderdate as date) as date
from $orders
""",
    "raw_events": """
select DAYNO(o_orderdate) as block_number,
       concat('0x', SHA(cast(l_orderkey as varchar(30)))) as tx_hash,
       case when l_partkey % 211 = 0 then '0x' when l_partkey % 223 = 0 then '0xg1'
            when l_partkey % 227 = 0 then concat('0x1', repeat('f', 16))
            else concat('0x', lower(hex(cast(l_linenumber as bigint)))) end as log_index,
       concat('0x', substr(SHA(concat('s', cast(l_suppkey as varchar(30)))), 1, 40)) as address,
       case when l_orderkey % 3 = 1 then concat('0x', SHA(concat('p', cast(l_partkey as varchar(30)))))
            else concat('0x', SHA(concat(l_returnflag, l_linestatus))) end as topic0,
       case when l_quantity > 25 then null
            else concat('0x', SHA(cast(l_partkey as varchar(30)))) end as topic1,
       cast(null as varchar(80)) as topic2, cast(null as varchar(80)) as topic3,
       concat('0x', lower(hex(cast(round(l_extendedprice * 100) as bigint)))) as data,
       cast(o_orderdate as date) as date
from $lineitem join $orders on o_orderkey = l_orderkey
""",
    # A few hot keys with several candidates and a key for each customer, so the lookup
    # grows with the tables; '3-MEDIUM' and every 11th customer are left unresolved.
    "selector_candidates": """
select key, signature, count,
       cast(row_number() over (partition by key order by count desc, signature) - 1 as bigint) as pos,
       concat('{"type":"function","name":"', signature, '"}') as abi
from (
  select concat('0x', substr(SHA(o_orderpriority), 1, 8)) as key,
         concat(lower(c_mktsegment), '(address,uint256)') as signature,
         count(*) as count
  from $orders join $customer on c_custkey = o_custkey
  where o_orderpriority <> '3-MEDIUM' group by o_orderpriority, c_mktsegment
  union all
  select concat('0x', substr(SHA(concat('k', cast(c_custkey as varchar(30)))), 1, 8)) as key,
         concat('call', cast(c_custkey as varchar(30)), '(address,uint256)') as signature,
         cast(1 + c_custkey % 97 as bigint) as count
  from $customer where c_custkey % 11 <> 0
  union all
  select concat('0x', substr(SHA(concat('k', cast(c_custkey as varchar(30)))), 1, 8)) as key,
         concat('other', cast(c_custkey as varchar(30)), '(bytes[2])') as signature,
         cast(c_custkey % 89 as bigint) as count
  from $customer where c_custkey % 11 <> 0 and c_custkey % 4 = 0
) c
""",
    # One candidate per key; flag R with status O and every 13th part are left unresolved.
    "topic_candidates": """
select key, signature, count, cast(0 as bigint) as pos,
       concat('{"type":"event","name":"', signature, '"}') as abi
from (
  select concat('0x', SHA(concat(l_returnflag, l_linestatus))) as key,
         concat('Evt', l_returnflag, l_linestatus, '(address,uint256)') as signature,
         count(*) as count
  from $lineitem where not (l_returnflag = 'R' and l_linestatus = 'O')
  group by l_returnflag, l_linestatus
  union all
  select concat('0x', SHA(concat('p', cast(p_partkey as varchar(30))))) as key,
         concat('Part', cast(p_partkey as varchar(30)), '(uint256)') as signature,
         cast(p_partkey % 71 as bigint) as count
  from $part where p_partkey % 13 <> 0
) c
""",
    # Manifest `files` rows: blocks and txs for every order day, events only
    # for days whose first shipment is before EVENTS_CUTOFF, so the tail is
    # half published.  SALT_DAY marks days whose md5 differs (a rebuild).
    "manifest_files": """
with day_orders as (
  select cast(o_orderdate as date) as d, count(*) as n
  from $orders group by cast(o_orderdate as date)
),
day_lines as (
  select cast(o_orderdate as date) as d, count(*) as n, min(l_shipdate) as first_ship
  from $lineitem join $orders on o_orderkey = l_orderkey
  group by cast(o_orderdate as date)
),
entries as (
  select d, 'blocks' as kind, n from day_orders
  union all select d, 'txs' as kind, n from day_orders
  union all select d, 'events' as kind, n from day_lines where first_ship < date'EVENTS_CUTOFF'
)
select cast(d as varchar(30)) as date, kind,
       concat('daily/', cast(d as varchar(30)), '.', kind, '.parquet') as key,
       cast(n * (case kind when 'blocks' then 64 when 'txs' then 420 else 380 end) + 4096 as bigint) as size,
       md5(concat(cast(d as varchar(30)), kind, cast(n as varchar(30)),
                  case when extract(day from d) = SALT_DAY then 'rebuilt' else '' end)) as md5,
       case when d < date'FIRST_V2' then 'v1' else 'v2' end as schema_version,
       DAYNO(d) * 3 + (case kind when 'blocks' then 0 when 'txs' then 1 else 2 end) as pos
from entries where d < date'LIMIT_DATE'
""",
}

# Snapshot parameters for the manifest view (fixed values of the fixture).
MANIFEST_NOW = {"EVENTS_CUTOFF": "2001-06-30", "LIMIT_DATE": "2100-01-01", "SALT_DAY": "0"}
MANIFEST_PREV = {"EVENTS_CUTOFF": "2001-07-15", "LIMIT_DATE": "2001-07-20", "SALT_DAY": "15"}

# First day of the second schema version; txs of earlier days lack the column.
FIRST_V2 = "1998-01-01"
V1_LACKS = {"txs": ("max_priority_fee_per_gas",)}

_TABLE_REF = re.compile(r"\$([a-z_]+)")
_MACRO_CALL = re.compile(r"\b(SHA|DAYNO|EPOCH)\(")


def _expand_macros(sql: str, dialect: str) -> str:
    macros = _MACROS[dialect]
    while True:
        m = _MACRO_CALL.search(sql)
        if not m:
            return sql
        start, depth, i = m.end(), 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        inner = sql[start:i - 1]
        sql = sql[:m.start()] + macros[m.group(1)](inner) + sql[i:]


def render(name: str, dialect: str, params: dict | None = None) -> str:
    """SQL text of a view for ``dialect`` ('spark' or 'duckdb')."""
    sql = _expand_macros(TEMPLATES[name], dialect)
    for k, v in {"FIRST_V2": FIRST_V2, **(params or {})}.items():
        sql = sql.replace(k, v)
    if dialect == "spark":
        sql = sql.replace("{", "{{").replace("}", "}}")
        return _TABLE_REF.sub(lambda m: "{" + m.group(1) + "}", sql)
    return _TABLE_REF.sub(lambda m: m.group(1), sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  A file with fewer splits than the cluster has cores
    (one row group is one task) is spread round-robin first, so the per-row
    hashing and decoding above it runs on every core; a table that already
    splits wide is left as scanned."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (spark.sparkContext.applicationId, id(spark), path)
    if k not in _TABLES:  # plans only: the driver tables are read-only
        _TABLES[k] = spread(spark, spark.read.parquet(path), key=path)
    return _TABLES[k]


_TABLES: dict[tuple, DataFrame] = {}


_SPLITS: dict[tuple, tuple[int, int]] = {}
# About one task per this many input bytes when a scan is spread.
SPREAD_UNIT = 256 * 1024


def spread(spark: SparkSession, df: DataFrame, key: str | None = None) -> DataFrame:
    """Round-robin ``df`` when its scan has fewer splits than it has work
    for: the target is one task per ``SPREAD_UNIT`` of input, at most one per
    core, so a 25-row table is never cut into thousands of partitions.  The
    split count and input size are kept per input path (counting plans the
    scan)."""
    from ledgerlake.sources import fsio
    try:
        cores = spark.sparkContext.defaultParallelism
        k = (key, cores, spark.conf.get("spark.sql.files.maxPartitionBytes"))
        if key is None or k not in _SPLITS:
            size = sum(fsio.size_of(f) or 0 for f in df.inputFiles())
            _SPLITS[k] = (df.rdd.getNumPartitions(), size)
        splits, size = _SPLITS[k]
    except Exception:  # noqa: BLE001 - Spark Connect exposes neither
        return df
    target = min(cores, max(1, size // SPREAD_UNIT))
    return df.repartition(target) if splits < target else df


def view(spark: SparkSession, sf_dir: str, name: str, params: dict | None = None) -> DataFrame:
    """A fixture view as a lazy DataFrame over the driver tables."""
    sql = render(name, "spark", params)
    refs = set(_TABLE_REF.findall(TEMPLATES[name]))
    return spark.sql(sql, **{r: table(spark, sf_dir, r) for r in refs})


def raw(spark: SparkSession, sf_dir: str, kind: str, with_date: bool = True) -> DataFrame:
    """Raw (undecoded) archive rows of ``kind``; ``date`` is the day lineage."""
    df = view(spark, sf_dir, f"raw_{kind}")
    return df if with_date else df.drop("date")


def raw_by_day(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The rows of :func:`raw`, hash-partitioned and sorted by ``date``.

    The rows that the view selects from are dealt, and its expressions run on them
    afterwards: what is shuffled and sorted are a few numbers a row, not its hashes.
    Blocks are an aggregate, so their rows are dealt themselves.
    """
    from ledgerlake.sources.writer import day_tasks
    rows, by = raw(spark, sf_dir, kind), "date"
    tasks = day_tasks(rows)
    name = f"raw_{kind}"
    if " group by " not in TEMPLATES[name]:
        head, source = render(name, "spark").rsplit("\nfrom ", 1)
        refs = {r: table(spark, sf_dir, r) for r in _TABLE_REF.findall(TEMPLATES[name])}
        by = "cast(o_orderdate as date)"
        rows = spark.sql(f"select * from {source}", **refs)
    rows = rows.repartition(tasks, F.expr(by)).sortWithinPartitions(F.expr(by))
    return rows if by == "date" else spark.sql(f"{head}\nfrom {{dealt}}", dealt=rows)


def decoded(spark: SparkSession, sf_dir: str, kind: str, with_date: bool = True) -> DataFrame:
    """Decoded archive rows, as a load would return them."""
    return decode_hex_columns(raw(spark, sf_dir, kind, with_date), kind)


def candidates(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Normalised lookup candidates ``(key, signature, count, pos, abi)``;
    ``which`` is 'selector' or 'topic'."""
    return view(spark, sf_dir, f"{which}_candidates")


def manifest_files(spark: SparkSession, sf_dir: str, previous: bool = False) -> DataFrame:
    """Manifest ``files`` rows (date, kind, key, size, md5, schema_version, pos)."""
    return view(spark, sf_dir, "manifest_files", MANIFEST_PREV if previous else MANIFEST_NOW)


# ---------------------------------------------------------------- DuckDB side
_DUCK_WEI = ("case when {c} = '0x' then cast(0 as decimal(38,0)) "
             "when regexp_matches({c}, '^0[xX][0-9a-fA-F]+$') "
             "then try_cast(try_cast(lower({c}) as hugeint) as decimal(38,0)) end")
_DUCK_INT = ("case when {c} = '0x' then cast(0 as bigint) "
             "when regexp_matches({c}, '^0[xX][0-9a-fA-F]+$') "
             "then try_cast(lower({c}) as bigint) end")


def duck_wei(c: str) -> str:
    return _DUCK_WEI.format(c=c)


def duck_int(c: str) -> str:
    return _DUCK_INT.format(c=c)


def duckdb_with() -> str:
    """A WITH clause defining every fixture view for the DuckDB oracle."""
    parts = [f"raw_{k} as ({render('raw_' + k, 'duckdb')})" for k in ("blocks", "txs", "events")]
    parts.append(f"selector_candidates as ({render('selector_candidates', 'duckdb')})")
    parts.append(f"topic_candidates as ({render('topic_candidates', 'duckdb')})")
    parts.append(f"manifest_files as ({render('manifest_files', 'duckdb', MANIFEST_NOW)})")
    parts.append(f"manifest_prev as ({render('manifest_files', 'duckdb', MANIFEST_PREV)})")
    parts.append(
        "blocks as (select number, timestamp, gas_used, gas_limit, "
        f"{duck_wei('base_fee_per_gas')} as base_fee_per_gas, date from raw_blocks)")
    parts.append(
        "txs as (select block_number, tx_hash, from_address, to_address, "
        f"{duck_wei('value')} as value, gas_used, {duck_wei('effective_gas_price')} as effective_gas_price, "
        f"{duck_wei('gas_price')} as gas_price, {duck_wei('max_priority_fee_per_gas')} as max_priority_fee_per_gas, "
        "type, status, input_prefix, date from raw_txs)")
    parts.append(
        "events as (select block_number, tx_hash, "
        f"{duck_int('log_index')} as log_index, address, topic0, topic1, topic2, topic3, data, date "
        "from raw_events)")
    return "with " + ",\n".join(parts) + "\n"
