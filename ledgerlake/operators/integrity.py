"""Object integrity (D1), the ledger of verified files, and the verified mirror.

All work on file *bytes*, which no DataFrame expression reaches for objects above the
2 GB a ``binaryFile`` row holds, so each runs as ``mapInPandas`` over entry rows,
spread over tasks by their declared bytes; a task streams 1 MiB at a time.

An MD5 can only be taken from a file's start to its end.  The first verification does
that once, a file to a task, and writes down the digests of the file's chunks (64 MiB
each) beside it.  From then on a file is verified chunk by chunk, its chunks spread
over tasks however large it is, and damage is named by its place.  :class:`Ledger`
keeps both tables under a durable folder: a file whose size and time of change are
those of its last verification is not read again, in this session or another.

D2 copies a file above the chunk size in parts of a chunk each, by many tasks; parts that
are there are kept, so an interrupted mirror resumes.  Joining the parts takes the
file's MD5.  Every step of every task may be repeated: parts and files are written
to a temporary name and renamed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ledgerlake.session import scratch_path, ship_package
from ledgerlake.sources import fsio

# Statuses (fixed values).
OK, MISSING, SIZE_MISMATCH, MD5_MISMATCH = "ok", "missing", "size_mismatch", "md5_mismatch"
TASK_BYTES = 64 << 20
CHUNK_BYTES = 64 << 20
COPIED, PRESENT, REFUSED = "copied", "present", "refused"

VERIFY_DDL = ("date string, kind string, key string, size long, md5 string, "
              "actual_size long, actual_md5 string, status string")
MIRROR_DDL = ("date string, kind string, key string, size long, md5 string, "
              "schema_version string, dest_key string, status string")
VERIFIED_DDL = "key string, size long, md5 string, mtime long"
CHUNKS_DDL = "key string, md5 string, start long, length long, digest string"


def _spread(spark: SparkSession, entries: DataFrame, tasks: int | None) -> DataFrame:
    """Round-robin the entry rows over tasks of about ``TASK_BYTES`` (a
    multi-GB day is a task of its own)."""
    return entries.repartition(max(int(tasks or _tasks(spark, entries, "size")), 1))


def _entry_columns(entries: DataFrame) -> DataFrame:
    return entries.select(*[F.col(c) if c in entries.columns else F.lit(None).cast("string").alias(c)
                            for c in ("date", "kind")], "key", "size", "md5")


def verify_objects(spark: SparkSession, root: str, entries: DataFrame,
                   tasks: int | None = None) -> DataFrame:
    """Size and MD5 of every entry ``(key, size, md5, ...)`` under
    ``root`` against the manifest.  Status: ok, missing, size_mismatch,
    md5_mismatch.  MD5 is over the raw bytes; reading stops one byte past
    the declared size, so an oversized object is caught without reading it
    all."""
    base = fsio.qualify(spark, root)
    src = _entry_columns(entries)

    def check(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                path = f"{base}/{r.key}"
                actual = fsio.size_of(path)
                if actual is None:
                    out.append((r.date, r.kind, r.key, r.size, r.md5, None, None, MISSING))
                    continue
                if actual != r.size:
                    out.append((r.date, r.kind, r.key, r.size, r.md5, actual, None, SIZE_MISMATCH))
                    continue
                n, digest = fsio.md5_of(path, limit=int(r.size))
                status = OK if (n == r.size and digest == r.md5) else (
                    SIZE_MISMATCH if n != r.size else MD5_MISMATCH)
                out.append((r.date, r.kind, r.key, r.size, r.md5, n, digest, status))
            yield pd.DataFrame(out, columns=["date", "kind", "key", "size", "md5",
                                             "actual_size", "actual_md5", "status"])

    ship_package(spark)
    return _spread(spark, src, tasks).mapInPandas(check, VERIFY_DDL)


class Ledger:
    """Durable record of what has been verified under an archive root.

    Two Parquet tables in ``folder``, only ever appended to: ``verified`` has (key, size,
    md5, mtime) of files found right, ``chunks`` the digests of their chunks.  The default
    folder belongs to the root and lies in the shared scratch folder.
    """

    def __init__(self, spark: SparkSession, root: str, folder: str | None = None, chunk: int = CHUNK_BYTES):
        self.spark, self.root, self.chunk = spark, fsio.qualify(spark, root), chunk
        name = "verified-" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        self.folder = fsio.qualify(spark, folder) if folder else scratch_path(spark, name)

    def _table(self, name: str, ddl: str) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.schema(ddl).parquet(path.toString()) if fs.exists(path) else None

    def verified(self) -> DataFrame | None:
        return self._table("verified", VERIFIED_DDL)

    def chunks(self) -> DataFrame | None:
        """Chunk digests, once each: a repeated verification may have written them again."""
        found = self._table("chunks", CHUNKS_DDL)
        return None if found is None else found.distinct()

    def check(self, entries: DataFrame, again: bool = False) -> DataFrame:
        """D1 by the ledger: (date, kind, key, size, md5, status, bad_start, bytes_read).

        A file whose size and time of change the ledger has is ``ok`` unread (not with
        ``again``); one with known chunk digests is verified by chunks in parallel
        (``bad_start`` is the first that differs); any other is hashed from end to end.
        What is found right goes into the ledger.
        """
        # Catalog rows, bounded by the manifest, are looked at on the driver; bytes never are.
        rows = list(dict.fromkeys(tuple(r) for r in _entry_columns(entries).collect()))
        entry = "date string, kind string, key string, size long, md5 string"
        found = self._over(rows, entry).mapInPandas(_stats(self.root), f"{entry}, actual long, mtime long").collect()
        done, todo = [], []
        seen = None if again else self.verified()
        if seen is not None:
            keys = self.spark.createDataFrame([(r["key"],) for r in found], "key string").distinct()
            seen = {tuple(r) for r in seen.join(keys, "key", "left_semi").select("key", "size", "md5", "mtime").collect()}
        for r in found:
            status = (MISSING if r["actual"] is None else SIZE_MISMATCH if r["actual"] != r["size"] else
                      OK if seen and (r["key"], r["size"], r["md5"], r["mtime"]) in seen else None)
            if status:
                done.append((*r[:5], status, None, 0))
            else:
                todo.append((*r[:5], r["mtime"]))
        if todo:
            done += self._read(todo, entry)
        return self.spark.createDataFrame(done, f"{entry}, status string, bad_start long, bytes_read long")

    def _over(self, rows: list[tuple], ddl: str) -> DataFrame:
        """The rows of entries, spread over tasks by their declared bytes."""
        ship_package(self.spark)
        least = self.spark.sparkContext.defaultParallelism * 4
        tasks = min(len(rows), max(least, sum(r[3] or 0 for r in rows) // TASK_BYTES))
        return self.spark.createDataFrame(rows, ddl).repartition(max(1, tasks))

    def _read(self, todo: list[tuple], entry: str) -> list[tuple]:
        """Rows of the files that have to be read; what is found right is written down."""
        ddl, result = f"{entry}, mtime long", ["mtime", "status", "bad_start", "bytes_read"]
        own = ["date", "kind", "key", "size", "md5"]
        known, out = self.chunks(), []
        if known is not None:
            df = self.spark.createDataFrame(todo, ddl)
            whole = known.groupBy("key", "md5").agg(F.sum("length").alias("size"))
            parts = df.join(whole, ["key", "md5", "size"], "left_semi").join(known, ["key", "md5"])
            out = [tuple(r) for r in self._by_chunks(parts).select(*own, *result).collect()]
            by_chunk = {(r[2], r[4]) for r in out}
            todo = [r for r in todo if (r[2], r[4]) not in by_chunk]
        if todo:
            files = self._over(todo, ddl).mapInPandas(_hashes(self.root, self.chunk), _HASHED).checkpoint()
            whole = files.where(F.col("start").isNull()).select(
                *own, "mtime", "status", F.lit(None).cast("long"), "length")
            out += (hashed := [tuple(r) for r in whole.collect()])
            right = [(r[2], r[4]) for r in hashed if r[6] == OK]
            if right:  # digests first: a file that counts as verified has them
                right = F.broadcast(self.spark.createDataFrame(right, "key string, md5 string"))
                (files.where(F.col("start").isNotNull()).join(right, ["key", "md5"], "left_semi")
                 .select("key", "md5", "start", "length", "digest").write.mode("append").parquet(f"{self.folder}/chunks"))
        new = [(r[2], r[3], r[4], r[5]) for r in out if r[6] == OK]
        if new:
            (self.spark.createDataFrame(new, VERIFIED_DDL).coalesce(1)
             .write.mode("append").parquet(f"{self.folder}/verified"))
        return [(*r[:5], *r[6:]) for r in out]

    def _by_chunks(self, chunks: DataFrame) -> DataFrame:
        """A row a file from its chunks, each read by whatever task it fell to."""
        base = self.root

        def run(batches):
            import pandas as pd
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    h, n = hashlib.md5(), 0
                    for b in fsio.read_range(f"{base}/{r.key}", int(r.start), int(r.length)):
                        h.update(b)
                        n += len(b)
                    out.append(n == r.length and h.hexdigest() == r.digest)
                yield pdf.assign(good=pd.Series(out, index=pdf.index, dtype=bool))

        ship_package(self.spark)
        tasks = _tasks(self.spark, chunks, "length")
        read = chunks.repartition(tasks, "key", "start").mapInPandas(
            run, StructType([*chunks.schema.fields, StructField("good", BooleanType())]))
        each = read.groupBy("date", "kind", "key", "size", "md5", "mtime").agg(
            F.min(F.when(~F.col("good"), F.col("start"))).alias("bad_start"), F.sum("length").alias("bytes_read"))
        return each.withColumn("status", F.when(F.col("bad_start").isNull(), OK).otherwise(MD5_MISMATCH))


_HASHED = ("date string, kind string, key string, size long, md5 string, mtime long, start long, length long, "
           "digest string, status string")


def _tasks(spark: SparkSession, entries: DataFrame, size: str) -> int:
    """Tasks of about ``TASK_BYTES``, four a core at least, no more than rows.  Sized by the
    catalog's bytes, since the cores may not all be there yet."""
    n, total = entries.agg(F.count(F.lit(1)), F.sum(F.greatest(F.col(size), F.lit(0)))).first()
    return max(1, min(n, max(spark.sparkContext.defaultParallelism * 4, (total or 0) // TASK_BYTES)))


def _stats(base: str):
    def run(batches):
        for pdf in batches:
            found = [fsio.stat(f"{base}/{k}") or (None, None) for k in pdf["key"]]
            yield pdf.assign(actual=[x[0] for x in found], mtime=[x[1] for x in found]).astype(
                {"actual": "Int64", "mtime": "Int64"})
    return run


def _hashes(base: str, chunk: int):
    """Rows of a file's chunks with their digests, then one row with its status."""
    def run(batches):
        import pandas as pd
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                own = (r.date, r.kind, r.key, r.size, r.md5, r.mtime)
                h, n, out = hashlib.md5(), 0, []
                for start in range(0, int(r.size), chunk):
                    part, got = hashlib.md5(), 0
                    for b in fsio.read_range(f"{base}/{r.key}", start, min(chunk, int(r.size) - start)):
                        h.update(b)
                        part.update(b)
                        got += len(b)
                    n += got
                    out.append((*own, start, got, part.hexdigest(), None))
                status = OK if (n, h.hexdigest()) == (r.size, r.md5) else (SIZE_MISMATCH if n != r.size else MD5_MISMATCH)
                out.append((*own, None, n, None, status))
                yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in _HASHED.split(", ")]).astype(
                    {"start": "Int64"})
    return run


def mirror_key(key: str, md5: str) -> str:
    """Destination key: the manifest key with ``md5[:16]`` before the
    extension, so a rebuilt day never reuses a stale file."""
    stem, dot, ext = key.rpartition(".")
    return f"{stem}.{md5[:16]}.{ext}" if dot else f"{key}.{md5[:16]}"


def _safe_key(key: str) -> bool:
    parts = key.split("/")
    return bool(key) and not key.startswith("/") and ".." not in parts and "\\" not in key


def _parts_of(dest: str, size: int, chunk: int) -> list[tuple[str, int, int]]:
    return [(f"{dest}.part-{start:015d}", start, min(chunk, size - start)) for start in range(0, size, chunk)]


def copy_parts(spark: SparkSession, src_root: str, dest_root: str, entries: DataFrame,
               chunk: int = CHUNK_BYTES) -> DataFrame:
    """D2, first step for files above ``chunk`` bytes: their parts beside the destination.

    One row a part, (key, start, length, status); parts spread over tasks.  A part that
    is there whole is ``present``.  Files already mirrored, or whose source has another
    size than declared, have none.
    """
    src_base, dst_base = fsio.qualify(spark, src_root), fsio.qualify(spark, dest_root)
    big = entries.where((F.col("size") > chunk) & F.col("md5").isNotNull() & F.col("key").isNotNull()).select(
        "key", "md5", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk))).alias("start"))
    big = big.withColumn("length", F.least(F.lit(chunk), F.col("size") - F.col("start")))

    def run(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if not _safe_key(r.key):
                    continue
                dest = f"{dst_base}/{mirror_key(r.key, r.md5)}"
                part = f"{dest}.part-{int(r.start):015d}"
                if fsio.size_of(dest) == r.size or fsio.size_of(f"{src_base}/{r.key}") != r.size:
                    continue
                status = PRESENT
                if fsio.size_of(part) != r.length:
                    tmp = f"{part}.tmp-{uuid.uuid4().hex[:8]}"
                    with fsio.open_write(tmp) as fout:
                        for b in fsio.read_range(f"{src_base}/{r.key}", int(r.start), int(r.length)):
                            fout.write(b)
                    fsio.rename(tmp, part)
                    status = COPIED
                out.append((r.key, r.start, r.length, status))
            yield pd.DataFrame(out, columns=["key", "start", "length", "status"])

    ship_package(spark)
    return big.repartition(_tasks(spark, big, "length"), "key", "start").mapInPandas(
        run, "key string, start long, length long, status string")


def mirror(spark: SparkSession, src_root: str, dest_root: str, entries: DataFrame,
           tasks: int | None = None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Copy verified files into ``dest_root``; one file per row, spread
    over tasks.

    Per file: skip when a same-size file with the right MD5 is already there
    (``present``); else copy to a temporary name while hashing, never more
    bytes than declared, check size and MD5, then rename (``copied``).  Files above
    ``chunk`` bytes come from parts that :func:`copy_parts` has brought before, which
    is run at once; parts of a file that turns out wrong go.  A key escaping the root
    is ``refused``; a bad source gives its D1 status.
    """
    src_base, dst_base = fsio.qualify(spark, src_root), fsio.qualify(spark, dest_root)
    src = entries.select("date", "kind", "key", "size", "md5", "schema_version")
    if not src.where(F.col("size") > chunk).isEmpty():
        copy_parts(spark, src_base, dst_base, src, chunk).count()

    def pieces(r, dest):
        """The file's bytes, from its parts where there are any."""
        for part, start, length in _parts_of(dest, int(r.size), chunk):
            if r.size > chunk and fsio.size_of(part) == length:
                yield from fsio.read_range(part, 0, length)
            else:
                yield from fsio.read_range(f"{src_base}/{r.key}", start, length)

    def copy(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                dkey = mirror_key(r.key or "", r.md5 or "")
                row = [r.date, r.kind, r.key, r.size, r.md5, r.schema_version, dkey]
                if not r.md5 or r.size is None or not _safe_key(r.key or ""):
                    out.append(row + [REFUSED])
                    continue
                dest = f"{dst_base}/{dkey}"
                if fsio.size_of(dest) == r.size:
                    n, digest = fsio.md5_of(dest, limit=int(r.size))
                    if n == r.size and digest == r.md5:
                        out.append(row + [PRESENT])
                        continue
                actual = fsio.size_of(f"{src_base}/{r.key}")
                if actual != r.size:
                    out.append(row + [MISSING if actual is None else SIZE_MISMATCH])
                    continue
                tmp = f"{dest}.tmp-{uuid.uuid4().hex[:8]}"
                h, n = hashlib.md5(), 0
                with fsio.open_write(tmp) as fout:
                    for b in pieces(r, dest):
                        h.update(b)
                        fout.write(b)
                        n += len(b)
                good = n == r.size and h.hexdigest() == r.md5
                if good:
                    fsio.rename(tmp, dest)
                else:
                    fsio.remove(tmp)
                if r.size > chunk:
                    for part, _, _ in _parts_of(dest, int(r.size), chunk):
                        if fsio.size_of(part) is not None:
                            fsio.remove(part)
                out.append(row + [COPIED if good else SIZE_MISMATCH if n != r.size else MD5_MISMATCH])
            yield pd.DataFrame(out, columns=["date", "kind", "key", "size", "md5",
                                             "schema_version", "dest_key", "status"])

    ship_package(spark)
    return _spread(spark, src, tasks).mapInPandas(copy, MIRROR_DDL)


def mirror_range(spark: SparkSession, archive, dest_root: str, start, end,
                 kinds=None, tasks: int | None = None) -> list[dict]:
    """D2 for a date range of an :class:`~ledgerlake.sources.archive.Archive`:
    copy, then write the mirror's own ``manifest.json`` (keys rewritten to the
    mirrored names) listing the files that verified.  Returns the per-file
    report (catalog-sized)."""
    from ledgerlake.operators import catalog as A
    from ledgerlake.schemas import KINDS
    from ledgerlake.sources.writer import write_manifest
    kinds = list(kinds or KINDS)
    ents = None
    for k in kinds:
        e = A.range_entries(archive.files(), str(start), str(end), k)
        ents = e if ents is None else ents.unionByName(e)
    report = [r.asDict() for r in mirror(spark, archive.root, dest_root, ents, tasks).collect()]
    good = [{"date": r["date"], "kind": r["kind"], "key": r["dest_key"], "size": r["size"],
             "md5": r["md5"], "schema_version": r["schema_version"]}
            for r in report if r["status"] in (COPIED, PRESENT)]
    # The mirror keeps what earlier ranges brought; a rebuilt day's new copy wins.
    old_files, old_lookups = _manifest_entries(spark, dest_root)
    done = {(e["date"], e["kind"]) for e in good}
    good += [e for e in old_files if (e["date"], e["kind"]) not in done]
    looks = archive.manifest.select(F.explode("lookups").alias("name", "l")).select("name", "l.*")
    found = mirror(spark, archive.root, dest_root, looks.select(
        F.lit(None).cast("string").alias("date"), F.col("name").alias("kind"), "key", "size", "md5",
        F.lit(None).cast("string").alias("schema_version")), tasks).collect()
    lookups = dict(old_lookups)
    for r in found:
        if r["status"] in (COPIED, PRESENT):
            lookups[r["kind"]] = {"key": r["dest_key"], "size": r["size"], "md5": r["md5"]}
    h = archive.header
    declared = archive.manifest.first()["columns"]
    declared = declared.asDict() if hasattr(declared, "asDict") else declared
    write_manifest(dest_root, good, lookups, chain_id=h.get("chain_id"),
                   schema_version=h.get("schema_version") or "v2",
                   **({"columns": {k: list(v) for k, v in declared.items() if v}} if declared else {}))
    return report


def _manifest_entries(spark: SparkSession, root: str) -> tuple[list[dict], dict]:
    """Files and lookups of a manifest, empty where there is none."""
    from ledgerlake.sources import manifest as M
    if fsio.size_of(M.manifest_path(fsio.qualify(spark, root))) is None:
        return [], {}
    m = M.read_manifest(spark, root)
    files = [{k: r[k] for k in ("date", "kind", "key", "size", "md5", "schema_version")}
             for r in M.files_table(m).orderBy("pos").collect()]
    return files, {r["name"]: {k: r[k] for k in ("key", "size", "md5")} for r in M.lookups_table(m).collect()}
