"""Scans of the daily archive (B1-B9) and column conformance.

An :class:`Archive` is a Hadoop-FS root holding ``manifest.json`` and the
files it lists.  The manifest is resolved on the driver (it is bounded by the
contract at 16 MiB); the data never is: every load returns a lazy DataFrame
over the exact file list, decoded by native expressions, so Catalyst prunes
columns into the Parquet scan and pushes filters on raw columns.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from datetime import date as _date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.hexnum import decode_hex_columns
from ledgerlake.operators import catalog as A
from ledgerlake.schemas import DEFAULT_CHAIN_ID, KINDS, ORDER_KEYS, check_kind
from ledgerlake.sources import fsio
from ledgerlake.sources import manifest as M

# Fixed value: the day at the start of every daily file name.
FILE_DATE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})"


def day_lineage() -> "F.Column":
    """The day of each row, from the name of the file it came from.

    ``_metadata.file_name`` is deterministic, so filters pass the projection
    that holds it: those on data columns reach the Parquet scan and those on
    the day prune files.
    """
    return F.to_date(F.regexp_extract(F.col("_metadata.file_name"), FILE_DATE, 1))


class Archive:
    """A mirrored archive root (local, HDFS, S3A, ABFS ...)."""

    def __init__(self, spark: SparkSession, root: str, chain_id: int | None = DEFAULT_CHAIN_ID,
                 decode: bool = True, verify: bool = True, strict: bool = True, ledger: str | None = None):
        """``verify`` checks size and MD5 of files before they are read, once per file and
        time of change over all sessions that share the ``ledger`` folder (by default one
        in the shared scratch folder); ``strict`` refuses a manifest with an entry that
        breaks the contract (A2), else such entries are left out."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger = ledger
        self.decode = decode
        self.verify = verify
        self._verified: set[tuple[str, str]] = set()
        self.manifest = M.read_manifest(spark, self.root)
        # The manifest is read once per Archive and kept as a local relation:
        # it is catalog-sized (the contract caps it at 16 MiB) and every
        # resolve reads it.  Not ``cache()``: the cache is keyed by plan, so a
        # rewritten manifest at the same path would come back stale.
        row = self.manifest.first()
        self.header = {k: row[k] for k in ("chain_id", "generated_at", "schema_version",
                                           "latest_complete_date")} if row else {}
        entries = [(i, *e) for i, e in enumerate(row["files"] if row else [])]
        self._files = spark.createDataFrame(entries, M.FILES_DDL)
        if chain_id is not None and self.header.get("chain_id") != chain_id:
            raise ValueError(f"manifest chain_id {self.header.get('chain_id')} is not {chain_id}")
        bad = {r["pos"]: r["violations"] for r in
               A.split_valid(A.file_violations(self._files))[1].collect()}
        wrong = A.split_valid(A.lookup_violations(M.lookups_table(self.manifest)))[1].collect()
        if strict and (bad or wrong):
            raise ValueError(f"invalid manifest entries: {dict(list(bad.items())[:5])} "
                             f"{[r['name'] for r in wrong][:5]}")
        if bad:
            entries = [e for e in entries if e[0] not in bad]
            self._files = spark.createDataFrame(entries, M.FILES_DDL)
        # The same rows on the driver, for resolving the file list of a load
        # without a Spark job (first entry wins, impossible dates skipped).
        names = ("pos",) + A.ENTRY_FIELDS
        self._winners: dict[tuple[str, str], dict] = {}
        for e in entries:
            d = dict(zip(names, e))
            if _real_day(d["date"]) and (d["date"], d["kind"]) not in self._winners:
                self._winners[(d["date"], d["kind"])] = d

    # ------------------------------------------------------------- catalog
    def files(self) -> DataFrame:
        return self._files

    def available_dates(self, kind: str) -> list[_date]:
        return [r[0] for r in A.available_dates(self.files(), kind).collect()]

    def latest_complete_date(self) -> _date | None:
        """A4: the manifest's declared date, or the derived one where it
        declares none; :meth:`latest_report` has both."""
        declared = self.header.get("latest_complete_date")
        return _date.fromisoformat(str(declared)) if declared else self.derived_complete_date()

    def derived_complete_date(self) -> _date | None:
        """The latest day that has all three kinds."""
        by_day: dict[str, set] = {}
        for d, k in self._winners:
            by_day.setdefault(d, set()).add(k)
        full = [d for d, ks in by_day.items() if set(KINDS) <= ks]
        return _date.fromisoformat(max(full)) if full else None

    def latest_report(self) -> DataFrame:
        """A4: the derived latest complete date beside the manifest's
        declared one (they differ when the declaration is stale or wrong)."""
        return A.latest_complete(self.files(), self.header.get("latest_complete_date"))

    def path(self, key: str) -> str:
        return f"{self.root}/{key}"

    def url_for(self, date: str, kind: str) -> str:
        return self.path(self._entry(str(date), kind)["key"])

    def _entry(self, date: str, kind: str) -> dict:
        """A5 on the driver-held catalog rows (same rule as ``catalog.entry``)."""
        check_kind(kind)
        e = self._winners.get((str(date), kind))
        if e is None:
            raise FileNotFoundError(
                f"no {kind} file for {date} in the manifest; latest complete date is "
                f"{self.latest_complete_date()}")
        return e

    def _range(self, start, end, kind: str) -> list[dict]:
        """A6 on the driver-held catalog rows: inclusive, date order, gaps
        skipped, empty raises (same rule as ``catalog.range_list``)."""
        check_kind(kind)
        start, end = str(start), str(end)
        if end < start:
            raise ValueError(f"end {end} is before start {start}")
        out = sorted((e for (d, k), e in self._winners.items()
                      if k == kind and start <= d <= end), key=lambda e: e["date"])
        if not out:
            raise FileNotFoundError(f"no {kind} files between {start} and {end}")
        return out

    # ------------------------------------------------------------- scans
    def read_entries(self, entries: list[dict], kind: str, decode: bool | None = None,
                     columns: list[str] | None = None, with_date: bool = True,
                     schema: StructType | None = None) -> DataFrame:
        """Read exactly these manifest entries (one file each) as one frame:
        grouped by schema version, unioned by name after a type check,
        projected to ``columns``, with the ``date`` lineage, decoded."""
        decode = self.decode if decode is None else decode
        self.check_entries(entries)
        by_version: dict[str, list[str]] = {}
        for e in entries:
            by_version.setdefault(e.get("schema_version") or "", []).append(self.path(e["key"]))
        if len(by_version) > 1:
            warnings.warn(f"range spans multiple schema versions: {sorted(by_version)}",
                          UserWarning, stacklevel=3)
        frames, seen = [], set()
        for _, paths in sorted(by_version.items()):
            df = self._parquet(paths, schema)
            keep = list(df.columns) if columns is None else [c for c in columns if c in df.columns]
            seen.update(keep)
            df = df.select(*keep, *([day_lineage().alias("date")] if with_date else []))
            frames.append(df)
        if columns is not None and set(columns) - seen:
            raise KeyError(f"columns not in {kind}: {sorted(set(columns) - seen)}")
        out = frames[0]
        for df in frames[1:]:
            _check_union(out, df)
            out = out.unionByName(df, allowMissingColumns=True)
        if columns is not None:  # requested order; a column absent in one version is null there
            out = out.select(*columns, *(["date"] if with_date else []))
        return decode_hex_columns(out, kind) if decode else out

    def check_entries(self, entries: list[dict]) -> None:
        """D1 on the entries about to be read, by the ledger of verified files; raises."""
        todo = [e for e in entries if (e["key"], e["md5"]) not in self._verified]
        if not self.verify or not todo:
            return
        from ledgerlake.operators import integrity as D
        rows = [(e["date"], e["kind"], e["key"], e["size"], e["md5"]) for e in todo]
        df = self.spark.createDataFrame(
            rows, "date string, kind string, key string, size long, md5 string")
        bad = (D.Ledger(self.spark, self.root, self.ledger).check(df)
               .where(F.col("status") != D.OK).select("key", "status").collect())
        if bad:
            kind = FileNotFoundError if all(r["status"] == D.MISSING for r in bad) else ValueError
            raise kind(f"{len(bad)} of {len(todo)} files fail verification: "
                       f"{[tuple(r) for r in bad[:5]]}")
        self._verified.update((e["key"], e["md5"]) for e in todo)

    def _parquet(self, paths: list[str], schema: StructType | None) -> DataFrame:
        """Read an exact file list, with the union of all files' columns (the
        footers are read in a Spark job); a type clash raises.  On a local or mounted root the files are
        listed on the driver (a listing job costs more than it saves there);
        on an object store Spark's parallel listing is kept."""
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        if schema is None and len(paths) > 1:
            reader = reader.option("mergeSchema", True)
        with fsio.driver_listing(self.spark, self.root, len(paths)):
            try:
                return reader.parquet(*paths)
            except Exception as e:
                if "CANNOT_MERGE_SCHEMA" in str(e) or "CANNOT_MERGE_INCOMPATIBLE" in str(e):
                    raise TypeError(f"columns clash across days: {str(e)[:500]}") from e
                raise

    def load_day(self, date, kind: str, decode: bool | None = None,
                 columns: list[str] | None = None, with_date: bool = False) -> DataFrame:
        """B1: one day of ``kind``; missing raises ``FileNotFoundError``."""
        e = self._entry(str(date), kind)
        return self.read_entries([e], kind, decode, columns, with_date)

    def load_range(self, start, end, kind: str, decode: bool | None = None,
                   columns: list[str] | None = None, with_date: bool = True) -> DataFrame:
        """B2: inclusive range; gaps skipped; empty raises.  ``date`` (B8) is
        added by default so per-day work is a ``groupBy("date")``."""
        entries = self._range(start, end, kind)
        return self.read_entries(entries, kind, decode, columns, with_date)

    def iter_range(self, start, end, kind: str, decode: bool | None = None,
                   columns: list[str] | None = None) -> Iterator[tuple[_date, DataFrame]]:
        """B3 (driver hand-over form): ``(date, DataFrame)`` per day in date
        order.  Each frame is lazy; prefer ``load_range(...).groupBy("date")``
        for work that can stay distributed."""
        for e in self._range(start, end, kind):
            yield _date.fromisoformat(e["date"]), self.read_entries([e], kind, decode, columns, False)

    def rows(self, date, kind: str, columns: list[str]) -> DataFrame:
        """B4 as a DataFrame: only ``columns`` exist (decode still applies)."""
        return self.load_day(date, kind, columns=columns)

    def iter_rows(self, date, kind: str, columns: list[str]) -> Iterator:
        """Rows of one day on the driver, one partition at a time."""
        return self.rows(date, kind, columns).toLocalIterator(prefetchPartitions=True)

    def rows_range(self, start, end, kind: str, columns: list[str]) -> DataFrame:
        """B5 as a DataFrame: the projected range (row count is the sum of days)."""
        return self.load_range(start, end, kind, columns=columns, with_date=False)

    def iter_rows_range(self, start, end, kind: str, columns: list[str]) -> Iterator:
        """Projected rows of a range on the driver, partition by partition."""
        return self.rows_range(start, end, kind, columns).toLocalIterator(prefetchPartitions=True)

    def head(self, date, kind: str, n: int = 20, decode: bool | None = None) -> DataFrame:
        """The first ``n`` rows of a day in the natural order (§1.5); 0 is all."""
        df = self.load_day(date, kind, decode)
        order = list(ORDER_KEYS[kind]) + [c for c in df.columns if c not in ORDER_KEYS[kind]]
        df = df.orderBy(*[F.asc_nulls_first(c) for c in order])
        return df.limit(n) if n else df

    # ------------------------------------------------------------- SQL views
    def open_day(self, date, prefix: str = "") -> dict[str, DataFrame]:
        """Temp views ``{prefix}blocks``, ``{prefix}txs``, ``{prefix}events``
        for one day; all three kinds must exist."""
        frames = {k: self.load_day(date, k, with_date=True) for k in KINDS}
        return register_views(frames, prefix)

    def open_range(self, start, end, prefix: str = "",
                   complete_days_only: bool = False) -> dict[str, DataFrame]:
        """The same over a range.  Each kind resolves its own days
        unless ``complete_days_only`` keeps only days with all three kinds."""
        frames = {k: self.load_range(start, end, k) for k in KINDS}
        if complete_days_only:
            days = A.complete_days(self.files())
            frames = {k: df.join(days, "date", "left_semi") for k, df in frames.items()}
        return register_views(frames, prefix)

    def summary(self) -> dict:
        """Chain, version, lookup names and the per-kind file summary
        (a DataFrame; its null-``kind`` row is the total)."""
        lookups = sorted(r["name"] for r in M.lookups_table(self.manifest).collect())
        return {**self.header, "lookups": lookups, "files": A.summary(self.files())}

    def footers(self, start=None, end=None) -> DataFrame:
        """Row groups of the files from their footers (:mod:`ledgerlake.sources.footers`)."""
        from ledgerlake.sources.footers import row_groups
        files = A.resolve(self.files())
        for bound, keep in ((start, F.col("date") >= str(start)), (end, F.col("date") <= str(end))):
            files = files if bound is None else files.where(keep)
        return row_groups(self.spark, self.root, files)

    # ------------------------------------------------------------- A11
    def conformance(self) -> DataFrame:
        """Declared columns (manifest) against each file's footer."""
        return column_conformance(self.spark, self.root, self.files(),
                                  M.columns_table(self.manifest))


def _real_day(text) -> bool:
    try:
        return bool(text) and len(text) == 10 and _date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> dict[str, DataFrame]:
    """Register each frame as a temp view named ``prefix + kind``, plus the
    decode functions (``ll_wei``, ``ll_hex_int``, ``ll_norm_key``) for SQL
    over raw columns."""
    from ledgerlake.functions.hexnum import register_sql_functions
    for kind, df in frames.items():
        df.createOrReplaceTempView(f"{prefix}{kind}")
    if frames:
        register_sql_functions(next(iter(frames.values())).sparkSession)
    return frames


def _check_union(a: DataFrame, b: DataFrame) -> None:
    """V8: refuse a type clash before ``unionByName`` casts it away."""
    ta = {f.name: f.dataType for f in a.schema.fields}
    for f in b.schema.fields:
        if f.name in ta and ta[f.name] != f.dataType:
            raise TypeError(f"column {f.name}: {ta[f.name].simpleString()} vs "
                            f"{f.dataType.simpleString()} across days")


def column_conformance(spark: SparkSession, root: str, files: DataFrame,
                       declared: DataFrame) -> DataFrame:
    """Per file, columns missing from, extra to, or out of the declared
    order.  Footers are read by ``mapInPandas`` over the path list (one row per
    file and column), so the work spreads over tasks by file.

    Output: ``(date, kind, key, column, declared_position, file_position,
    problem)`` with ``problem`` in {missing, extra, out_of_order}.  A kind with
    no declared columns is undeclared and is not reported.
    """
    base = fsio.qualify(spark, root)
    paths = files.select("date", "kind", "key",
                         F.concat(F.lit(base + "/"), F.col("key")).alias("path"))

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        from ledgerlake.sources import fsio
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                with fsio.open_random(r.path) as fh:
                    names = pq.ParquetFile(fh).schema_arrow.names
                out.extend((r.date, r.kind, r.key, n, i) for i, n in enumerate(names))
            yield pd.DataFrame(out, columns=["date", "kind", "key", "column", "file_position"])

    from ledgerlake.session import ship_package
    ship_package(spark)
    # By entries: the cores may not all be there yet.
    tasks = max(spark.sparkContext.defaultParallelism * 2, paths.count() // 100)
    found = paths.repartition(tasks).mapInPandas(
        footers, "date string, kind string, key string, column string, file_position int")
    decl = declared.select("kind", "column", F.col("position").alias("declared_position"))
    kinds_declared = decl.select("kind").distinct()
    keys = files.select("date", "kind", "key").join(kinds_declared, "kind", "left_semi")
    expected = keys.join(decl, "kind")
    j = (expected.join(found, ["date", "kind", "key", "column"], "full_outer")
                 .join(kinds_declared, "kind", "left_semi"))
    # Order is compared among the columns both sides have.
    shared = F.col("file_position").isNotNull() & F.col("declared_position").isNotNull()
    per_file = Window.partitionBy("date", "kind", "key", shared)
    j = (j.withColumn("file_rank", F.rank().over(per_file.orderBy("file_position")))
          .withColumn("declared_rank", F.rank().over(per_file.orderBy("declared_position"))))
    problem = (F.when(F.col("file_position").isNull(), "missing")
                .when(F.col("declared_position").isNull(), "extra")
                .when(F.col("file_rank") != F.col("declared_rank"), "out_of_order"))
    return (j.withColumn("problem", problem).where(F.col("problem").isNotNull())
             .select("date", "kind", "key", "column", "declared_position", "file_position", "problem"))
