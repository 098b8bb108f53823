"""Write an archive in the published layout from archive-shaped DataFrames.

Used to build test inputs from the driver tables (the fixture views) and by
the registered scan queries: ``daily/YYYY-MM-DD.{kind}.parquet`` files, the
two lookup JSON files and ``manifest.json``.  The daily files are written by
``mapInArrow`` over rows partitioned and sorted by day, because the format
itself is one file per day and kind; each task writes to the exact key and
returns the entry (size, md5) for the manifest.  A retried task rewrites the same key, so the
write survives a lost executor; the manifest is written last.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import DEFAULT_CHAIN_ID, KINDS, RAW
from ledgerlake.sources import fsio
from ledgerlake.sources.manifest import MANIFEST_NAME

ENTRY_DDL = "date string, kind string, key string, size long, md5 string, schema_version string"

# Fixed key layout of the archive.
LOOKUP_KEYS = {"function_selectors": "lookups/function_selectors.json",
               "event_topics": "lookups/event_topics.json"}


# Hashes as hex text: half their bytes go, and higher levels find no more.
COMPRESSION = {"compression": "zstd", "compression_level": 1}


def _put(path: str, body: bytes) -> None:
    """Write then rename, so a reader never sees a partial file (a retried or
    concurrent writer replaces it whole)."""
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
    with fsio.open_write(tmp) as out:
        out.write(body)
    fsio.rename(tmp, path)


# About one task per this many input bytes when rows are dealt by day.
TASK_INPUT = 16 << 20


def day_tasks(df: DataFrame) -> int:
    """Tasks to deal the rows of ``df`` over by day: by the bytes of the files it reads, so
    that what a task sorts stays small however large the input, two a core at least."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(f))
        size += p.getFileSystem(conf).getFileStatus(p).getLen()
    return max(spark.sparkContext.defaultParallelism * 2, size // TASK_INPUT)


def write_days(df: DataFrame, root: str, kind: str, rule=None, dealt: bool = False) -> DataFrame:
    """Write one Parquet file per day of ``df`` (which has a ``date``
    column) and return the manifest entries as a DataFrame.

    ``rule(day, kind)`` gives what is special about a day's file, any of
    ``schema_version``, ``columns`` (a function of the list of names) and
    ``spoil`` (a function of the bytes that are put after the entry is taken;
    None puts no file): test inputs plant differing days and damage by it.

    Rows are hash-partitioned and sorted by day (``dealt`` says they already are, as
    :func:`fixtures.raw_by_day` does it before the rows grow wide), so each task sees its
    days as contiguous runs; ``mapInArrow`` streams the batches, keeps only the
    current day, and sorts and writes it when the day changes (memory: one day).
    """
    root = fsio.qualify(df.sparkSession, root)
    known = [f.name for f in RAW[kind].fields if f.name in df.columns]
    names = known + [c for c in df.columns if c != "date" and c not in RAW[kind].names]
    longs = {f.name for f in RAW[kind].fields if f.dataType.typeName() == "long"}
    order = [c for c in ("block_number", "number", "tx_hash") if c in df.columns]

    def write_one(day, batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        special = (rule(day, kind) if rule else None) or {}
        rows = pa.Table.from_batches(batches)
        if order:
            rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in order], null_placement="at_start"))
        own = special.get("columns", list)(names)

        def column(n):
            of = pa.int64() if n in longs else pa.string()
            if n not in rows.column_names:
                return pa.nulls(rows.num_rows, of)
            return rows[n].cast(of) if n in RAW[kind].names else rows[n]
        buf = io.BytesIO()
        pq.write_table(pa.Table.from_arrays([column(n) for n in own], names=own), buf, **COMPRESSION)
        body = buf.getvalue()
        key = f"daily/{day}.{kind}.parquet"
        entry = {"date": day, "kind": kind, "key": key, "size": len(body),
                 "md5": hashlib.md5(body).hexdigest(), "schema_version": special.get("schema_version", "v2")}
        body = special.get("spoil", bytes)(body)
        if body is not None:
            _put(f"{root}/{key}", body)
        return entry

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        fields = [c.split(" ") for c in ENTRY_DDL.split(", ")]
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in fields])
        day, parts = None, []
        for batch in batches:
            text = pc.fill_null(batch.column("date").cast(pa.string()), "None")
            runs, start, done = pc.run_end_encode(pc.utf8_slice_codeunits(text, 0, 10)), 0, []
            for d, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if d != day and parts:
                    done.append(write_one(day, parts))
                    parts = []
                day = d
                parts.append(batch.slice(start, end - start))
                start = end
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if parts:
            yield pa.RecordBatch.from_pylist([write_one(day, parts)], schema=schema)

    from ledgerlake.session import ship_package
    ship_package(df.sparkSession)
    # An explicit partition count: AQE would coalesce a small input into one
    # task, and then one task would write every file.
    src = df if dealt else df.repartition(day_tasks(df), "date").sortWithinPartitions("date")
    return src.select("date", *names).mapInArrow(write, ENTRY_DDL)


def lookup_lines(cands: DataFrame, legacy=None) -> DataFrame:
    """One line of text per key, ``"key":[{candidate}, ...]``, candidates in list order,
    sorted by key.  Keys for which the condition ``legacy`` holds and which have one
    candidate get it without a list, as old files do."""
    plain = F.to_json(F.struct("signature", "count"), {"ignoreNullFields": "false"})
    text = F.concat(F.rtrim("plain", F.lit("}")), F.lit(',"abi":'), F.coalesce("abi", F.lit("null")), F.lit("}"))
    lists = (cands.withColumn("plain", plain).select("key", F.struct("pos", text.alias("text")).alias("one"))
             .groupBy("key").agg(F.array_sort(F.collect_list("one")).alias("c")))
    bare = F.array_join(F.transform("c", lambda x: x["text"]), ",")
    value = F.concat(F.lit("["), bare, F.lit("]"))
    if legacy is not None:
        value = F.when((F.size("c") == 1) & legacy, bare).otherwise(value)
    name = F.regexp_replace(F.to_json(F.array("key")), r"^\[|\]$", "")
    return (lists.repartitionByRange("key").sortWithinPartitions("key")
            .select(F.concat(name, F.lit(":"), value).alias("value")))


def write_lookup(cands: DataFrame, root: str, name: str, legacy=None) -> dict:
    """The lookup file of ``cands``: its lines are written by Spark in parts, and the parts
    run through the driver line by line into the one object that the format asks for."""
    from ledgerlake.session import scratch_path
    spark = cands.sparkSession
    parts = scratch_path(spark, "lookup-parts", unique=True)
    lookup_lines(cands, legacy).write.text(parts)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parts)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(str(f.getPath()) for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    key = LOOKUP_KEYS.get(name, f"lookups/{name}.json")
    path = f"{root.rstrip('/')}/{key}"
    tmp, md5, size, sep = f"{path}.tmp-{uuid.uuid4().hex[:8]}", hashlib.md5(), 0, b"{"
    with fsio.open_write(tmp) as out:
        def put(text: bytes) -> None:
            nonlocal size
            out.write(text)
            md5.update(text)
            size += len(text)
        for f in files:
            with fsio.open_read(f) as lines:
                for line in lines:
                    put(sep + line.rstrip(b"\n"))
                    sep = b","
        put(b"{}" if sep == b"{" else b"}")
    fsio.rename(tmp, path)
    fs.delete(at, True)
    return {"key": key, "size": size, "md5": md5.hexdigest()}


def write_manifest(root: str, entries: list[dict], lookups: dict[str, dict] | None = None,
                   chain_id: int = DEFAULT_CHAIN_ID, schema_version: str = "v2",
                   columns: dict[str, list[str]] | None = None,
                   latest_complete_date: str | None = "derive") -> dict:
    """Write ``manifest.json`` (entries sorted by date and kind)."""
    entries = sorted(entries, key=lambda e: (e["date"], KINDS.index(e["kind"])
                                             if e["kind"] in KINDS else 9))
    if latest_complete_date == "derive":
        by_day: dict[str, set] = {}
        for e in entries:
            by_day.setdefault(e["date"], set()).add(e["kind"])
        full = [d for d, k in by_day.items() if set(KINDS) <= k]
        latest_complete_date = max(full) if full else None
    doc = {
        "chain_id": chain_id,
        "generated_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "schema_version": schema_version,
        "latest_complete_date": latest_complete_date,
        "columns": columns if columns is not None else {k: list(RAW[k].names) for k in KINDS},
        "lookups": lookups or {},
        "files": entries,
    }
    path = f"{root.rstrip('/')}/{MANIFEST_NAME}"
    tmp = path + ".tmp"
    with fsio.open_write(tmp) as out:
        out.write(json.dumps(doc, indent=1).encode())
    fsio.rename(tmp, path)
    return doc


def write_archive(spark: SparkSession, frames: dict[str, DataFrame], root: str,
                  lookups: dict[str, DataFrame] | None = None, rule=None, legacy=None,
                  chain_id: int = DEFAULT_CHAIN_ID, dealt: bool = False, **manifest) -> dict:
    """Write every kind in ``frames`` (raw rows with a ``date`` column, ``dealt`` by day
    or not), the lookups, then the manifest.  Returns the manifest document.

    A kind after the other, the largest (the last) first: the disk holds the shuffle files of
    one kind, and those of the largest while nothing else is written."""
    from ledgerlake.session import shuffles_dropped
    entries = []
    with shuffles_dropped(spark):
        for kind, df in reversed(frames.items()):
            # one row per file: catalog-sized
            entries += [r.asDict() for r in write_days(df, root, kind, rule, dealt).collect()]
        lk = {name: write_lookup(cands, root, name, legacy) for name, cands in (lookups or {}).items()}
    return write_manifest(root, entries, lk, chain_id=chain_id, **manifest)


# Bump when the layout written by this module changes.
WRITER_VERSION = "5"


def fixture_tag(sf_dir: str, spark: SparkSession | None = None) -> str:
    """Fingerprint of a fixture archive: the input folder with its files' sizes
    and times, the SQL of the views it is written from, and the writer
    version, so neither a changed view nor changed tables reuse an older one."""
    from ledgerlake.sources import fixtures as fx
    h = hashlib.md5(sf_dir.rstrip("/").encode())
    for name in ("raw_blocks", "raw_txs", "raw_events", "selector_candidates", "topic_candidates"):
        h.update(fx.render(name, "spark").encode())
    h.update(WRITER_VERSION.encode())
    if spark is not None:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for name in ("part", "supplier", "customer", "orders", "lineitem", "events"):
            f = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
            if fs.exists(f):
                for st in [fs.getFileStatus(f), *(fs.listStatus(f) if fs.isDirectory(f) else [])]:
                    h.update(f"{st.getPath().getName()} {st.getLen()} {st.getModificationTime()}".encode())
    return h.hexdigest()[:12]


def two_versions(day: str, kind: str) -> dict:
    """Days before ``FIRST_V2`` are of version v1 and lack the columns added since."""
    from ledgerlake.sources.fixtures import FIRST_V2, V1_LACKS
    if day >= FIRST_V2:
        return {}
    lacks = V1_LACKS.get(kind, ())
    return {"schema_version": "v1", "columns": lambda names: [n for n in names if n not in lacks]}


def flawed(day: str, kind: str) -> dict:
    """By the number of the day since 1970: files with a column missing, an extra one and
    two swapped, files that are not there, cut off and altered."""
    k = (date.fromisoformat(day) - date(1970, 1, 1)).days % 11
    shapes = {1: lambda n: [c for c in n if c != "gas_limit"], 2: lambda n: [*n, "note"],
              3: lambda n: [{"gas_used": "gas_limit", "gas_limit": "gas_used"}.get(c, c) for c in n]}
    spoils = {4: lambda b: None, 5: lambda b: b[:-7], 6: lambda b: b[:99] + bytes([b[99] ^ 1]) + b[100:]}
    return {**({"columns": shapes[k]} if k in shapes else {}), **({"spoil": spoils[k]} if k in spoils else {})}


def fixture_archive(spark: SparkSession, sf_dir: str) -> str:
    """The archive written from the fixture views of ``sf_dir``, under the
    shared scratch root; written once and reused while its manifest exists.  It has
    two schema versions, and legacy entries in its lookups."""
    from ledgerlake.sources import fixtures as fx

    def write(root):
        lookups = {"function_selectors": fx.candidates(spark, sf_dir, "selector"),
                   "event_topics": fx.candidates(spark, sf_dir, "topic")}
        write_archive(spark, {k: fx.raw_by_day(spark, sf_dir, k) for k in KINDS}, root, lookups, rule=two_versions,
                      legacy=F.col("key").endswith("7"), dealt=True)
    return _once(spark, sf_dir, "archive", write)


def flawed_archive(spark: SparkSession, sf_dir: str) -> str:
    """Blocks only, with the flaws of :func:`flawed` and a declared latest complete day."""
    from ledgerlake.sources import fixtures as fx

    def write(root):
        write_archive(spark, {"blocks": fx.raw_by_day(spark, sf_dir, "blocks")}, root, rule=flawed, dealt=True,
                      latest_complete_date="1997-03-04")
    return _once(spark, sf_dir, "flawed", write)


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    from ledgerlake.session import scratch_path
    root = scratch_path(spark, f"{name}-{fixture_tag(sf_dir, spark)}")
    if fsio.size_of(f"{root}/{MANIFEST_NAME}") is None:
        write(root)
    return root
