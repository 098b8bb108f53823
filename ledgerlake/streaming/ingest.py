"""Incremental ingest and following the archive (H1, H2, H4).

H1 keeps a decoded, ``date``-partitioned lake in step with the archive: the
manifest is diffed against a ledger of ``(date, kind, key, md5)`` already
ingested; only new or rebuilt days are read, their partitions replaced by a
dynamic overwrite, and the ledger appended last.  A rerun changes nothing; a
rebuilt day (same key, new md5) replaces its partition.  A lost executor
only retries tasks of the write, and a job that dies before the ledger append
is simply redone next run (the overwrite is idempotent).

H2 follows a folder of manifest snapshots as a stream of the entries they bring
(:mod:`ledgerlake.streaming.source`): every snapshot is diffed in order, and a batch's
number goes into the ledger with its entries, so a batch that is run again does
nothing.  The daily folder itself is not a stream source: a rebuilt file keeps its path
and the file source would skip it.

H4 replays an immutable mirror (D2) in micro-batches bounded by bytes, in the order of
the mirror's manifest, with the union of the columns of all listed files.
"""

from __future__ import annotations

import warnings
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import catalog as A
from ledgerlake.schemas import BLOCK_COLUMN, KINDS, RAW, check_kind
from ledgerlake.sources import fsio
from ledgerlake.sources import manifest as M
from ledgerlake.sources.archive import FILE_DATE, Archive
from ledgerlake.sources.footers import row_groups

LEDGER = "_ledger"
# Bound on rows per lake file, so a task holding a large slice of a hot day
# still writes files of bounded size (sorted by block, so row groups prune).
MAX_RECORDS_PER_FILE = 5_000_000
# Of the decoded rows: hashes as hex text lose half their bytes, and higher levels find no more.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
LEDGER_DDL = ("date string, kind string, key string, md5 string, size long, ingested_at string, "
              "stream string, batch_id long")


def _ledger(spark: SparkSession, lake: str) -> DataFrame:
    path = f"{lake.rstrip('/')}/{LEDGER}"
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).parquet(path)


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its Path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def latest_entries(spark: SparkSession, lake: str) -> DataFrame:
    """(date, kind, key, md5) that each day of the lake was last ingested from."""
    return (_ledger(spark, lake).groupBy("date", "kind")
            .agg(F.max_by(F.struct("key", "md5"), "ingested_at").alias("l"))
            .select("date", "kind", "l.key", "l.md5"))


def pending(spark: SparkSession, files: DataFrame, lake: str,
            kinds=KINDS, start: str | None = None, end: str | None = None) -> DataFrame:
    """Valid entries (winning per day and kind) whose key and md5 differ
    from the *latest* ledger row of their day and kind: new days and rebuilt
    days (a day rebuilt back to an earlier md5 included)."""
    valid, _ = A.split_valid(A.file_violations(files, strict_key=False))
    cur = A.resolve(valid.filter(F.col("kind").isin(*kinds)))
    if start:
        cur = cur.filter(F.col("date") >= str(start))
    if end:
        cur = cur.filter(F.col("date") <= str(end))
    last = latest_entries(spark, lake)
    return cur.join(last, ["date", "kind", "key", "md5"], "left_anti")


def ingest(spark: SparkSession, archive: Archive, lake: str, kinds=KINDS,
           start: str | None = None, end: str | None = None,
           files: DataFrame | None = None, batch: tuple[str, int] | None = None) -> list[dict]:
    """H1: bring ``lake/{kind}`` (decoded, partitioned by ``date``) up to the
    manifest (or to ``files`` when given, e.g. a batch of H2, whose stream and number
    ``batch`` go into the ledger).  Returns the entries ingested (catalog-sized)."""
    lake = lake.rstrip("/")
    for k in kinds:
        check_kind(k)
    todo = [r.asDict() for r in
            pending(spark, files if files is not None else archive.files(), lake,
                    kinds, start, end).collect()]
    for kind in kinds:
        ents = [e for e in todo if e["kind"] == kind]
        if not ents:
            continue
        df = archive.read_entries(ents, kind, decode=True, columns=None, with_date=True)
        # Input files are one per day, so tasks already align with days: sort
        # within tasks and write, no shuffle; a big day is split by row group.
        (df.sortWithinPartitions("date", BLOCK_COLUMN[kind])
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).options(**COMPRESSION)
           .partitionBy("date").parquet(f"{lake}/{kind}"))
        # A dynamic overwrite leaves the folder of a day without rows as it
        # was; days now empty are cleared before the ledger says done.
        filled = _days_with_rows(spark, archive, ents)
        for e in ents:
            fs, p = _fs(spark, f"{lake}/{kind}/date={e['date']}")
            if e["date"] not in filled and fs.exists(p):
                fs.delete(p, True)
    if todo:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")  # sortable
        rows = [(e["date"], e["kind"], e["key"], e["md5"], e["size"], now, *(batch or (None, None))) for e in todo]
        spark.createDataFrame(rows, LEDGER_DDL).write.mode("append").parquet(f"{lake}/{LEDGER}")
    return todo


def _days_with_rows(spark: SparkSession, archive: Archive, entries: list[dict]) -> set[str]:
    """Days of the entries' files that hold rows, by the files' footers."""
    rows = [(e["date"], e["kind"], e["key"]) for e in entries]
    groups = row_groups(spark, archive.root, spark.createDataFrame(rows, "date string, kind string, key string"))
    name = F.regexp_extract("key", "[^/]*$", 0)
    day = F.to_date(F.regexp_extract(name, FILE_DATE, 1))
    return {str(r[0]) for r in groups.where("rows > 0").select(day).distinct().collect()}


def read_lake(spark: SparkSession, lake: str, kind: str) -> DataFrame:
    """The ingested table of ``kind``; ``date`` is a partition column, so a
    date filter prunes directories."""
    path = f"{lake.rstrip('/')}/{check_kind(kind)}"
    with fsio.driver_listing(spark, path):
        return spark.read.parquet(path)


def lake_range(spark: SparkSession, lake: str, kind: str, start, end) -> DataFrame:
    """Days ``start..end`` of an ingested table; the date filter is a
    partition filter, so only those folders are listed into the scan."""
    df = read_lake(spark, lake, kind)
    return df.filter((F.col("date") >= F.lit(str(start)).cast("date"))
                     & (F.col("date") <= F.lit(str(end)).cast("date")))


def _start(writer, once: bool, interval: str):
    """``once`` works off what is there, batch by batch, and stops."""
    if not once:
        return writer.trigger(processingTime=interval).start()
    q = writer.trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def follow(spark: SparkSession, archive: Archive, snapshots: str, lake: str,
           checkpoint: str, kinds=KINDS, once: bool = True, interval: str = "10 minutes",
           after=None, max_bytes: int | None = None):
    """H2: every manifest snapshot in ``snapshots`` is taken in by H1, in order.

    Batches hold at most ``max_bytes`` of one snapshot's entries.  ``once`` runs what is
    there and stops; otherwise a processing-time trigger of ``interval``.
    ``after(ingested)`` runs after each batch (e.g. :func:`refresh_running_totals`).
    Returns the query.
    """
    from ledgerlake.streaming.source import entry_stream
    stream_id = fsio.qualify(spark, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = [r.asDict() for r in batch.collect()]  # catalog rows
        chain = archive.header.get("chain_id")
        other = [r["chain_id"] for r in rows if r["chain_id"] != chain]
        if other:
            raise ValueError(f"snapshot chain_id {other[0]} is not {chain}")
        done = _ledger(spark, lake).where((F.col("stream") == stream_id) & (F.col("batch_id") == batch_id))
        rows = [(r["seq"], *(r[f] for f in A.ENTRY_FIELDS)) for r in rows if not r["superseded"]]
        if not rows or not done.isEmpty():
            return
        files = spark.createDataFrame(rows, M.FILES_DDL)
        ingested = ingest(spark, archive, lake, kinds, files=files, batch=(stream_id, batch_id))
        if after is not None:
            after(ingested)

    stream = entry_stream(spark, snapshots, max_bytes=max_bytes, kinds=kinds)
    return _start(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), once, interval)


def replay(spark: SparkSession, mirror_root: str, kind: str, sink: str, checkpoint: str,
           files_per_trigger: int | None = None, decode: bool = True, max_bytes: int = 8 << 30):
    """H4: replay the immutable mirror of ``kind`` as micro-batches of at most
    ``max_bytes`` (and ``files_per_trigger`` files) into Parquet at ``sink``, partitioned
    by ``date``.  Only files that the mirror's manifest lists count: after a
    rebuild and a second mirror the older copy is still in the folder.  A batch's days
    replace their partitions, so a batch that is run again changes nothing; the result
    equals B2, columns that later files add included."""
    from ledgerlake.streaming.source import FIELDS, entry_stream
    check_kind(kind)
    mirror = Archive(spark, mirror_root)
    listed = [e for (_, k), e in mirror._winners.items() if k == kind]
    schema = mirror._parquet([mirror.path(e["key"]) for e in listed], None).schema if listed else RAW[kind]

    def run(batch: DataFrame, batch_id: int) -> None:
        entries = [{f: r[f] for f in FIELDS} for r in batch.orderBy("seq").collect()]  # catalog rows
        if not entries:
            return
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", UserWarning)  # several versions are what it is for
            df = mirror.read_entries(entries, kind, decode=decode, schema=schema)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).options(**COMPRESSION)
           .partitionBy("date").parquet(sink))

    stream = entry_stream(spark, M.manifest_path(mirror_root), max_bytes, files_per_trigger, (kind,))
    return _start(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), True, "")


def snapshot(archive_root: str, snapshots: str, name: str | None = None) -> str:
    """Copy the current manifest into the snapshot folder as a new file; names must sort
    in the order of the snapshots."""
    src = M.manifest_path(archive_root)
    snapshots = snapshots.rstrip("/")
    stamp = name or datetime.now(timezone.utc).strftime("manifest-%Y%m%dT%H%M%S%f.json")
    dest = f"{snapshots}/{stamp}"
    tmp = f"{snapshots}/.{stamp}.tmp"  # hidden from the file source
    with fsio.open_read(src) as fin, fsio.open_write(tmp) as fout:
        fout.write(fin.read())
    fsio.rename(tmp, dest)
    return dest


def refresh_running_totals(spark: SparkSession, lake: str, dest: str, changed=None) -> DataFrame:
    """H3 (streaming form): the running totals of the lake's txs in ``dest``, partitioned
    by month.

    ``changed`` are the entries that H1 took in (as ``follow`` gives them to ``after``).
    Only their days are counted anew, and only totals from the first of them on are
    written; None does all.  Equal to the one-pass total over the same days.
    """
    from ledgerlake.operators.recipes import failed_and_all, prefix_sums
    fs, p = _fs(spark, dest)
    txs = read_lake(spark, lake, "txs")
    if changed is None or not fs.exists(p):
        counts, base = failed_and_all(txs), {}
    else:
        days = sorted({e["date"] for e in changed if e["kind"] == "txs"})
        if not days:
            return spark.read.parquet(dest)
        old = spark.read.parquet(dest)
        first = F.trunc(F.lit(days[0]).cast("date"), "month")
        new = F.col("date").isin(*[F.lit(d).cast("date") for d in days])
        counts = (old.where((F.col("date") >= first) & ~new).select("date", "failed_txs", "txs")
                  .union(failed_and_all(txs.where(new))))
        row = old.where(F.col("date") < first).agg(F.sum("failed_txs"), F.sum("txs")).first()
        base = {"failed_txs": row[0] or 0, "txs": row[1] or 0}
    totals = prefix_sums(counts, "date", {"failed_txs": "failed_running", "txs": "txs_running"}, base)
    month = F.date_format("date", "yyyy-MM").alias("month")
    out = totals.select("*", month).checkpoint()
    if changed is not None and fs.exists(p):  # months without a day left
        left = {r[0] for r in out.select("month").distinct().collect()}
        for f in fs.listStatus(p):
            name = f.getPath().getName()
            if name.startswith("month=") and name[6:] >= days[0][:7] and name[6:] not in left:
                fs.delete(f.getPath(), True)
    (out.repartition("month").write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if changed is None else "dynamic").partitionBy("month").parquet(dest))
    return spark.read.parquet(dest)
