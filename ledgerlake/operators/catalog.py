"""Catalog operators over manifest ``files`` rows (A2-A10).

Input is the exploded manifest: one row per file entry with
``(pos, date, kind, key, size, md5, schema_version)``; ``pos`` is the position
in the manifest's ``files`` array (first one wins on duplicates).  All
operators are lazy DataFrame transformations; the helpers that must raise
(missing day, empty range) run one small action on the catalog, never on
data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.schemas import KINDS, check_kind

# Fixed validation patterns of the archive contract; a mirror's keys carry 16
# digits of the MD5 before the extension.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MD5_PATTERN = r"^[0-9a-f]{32}$"
FILE_KEY_PATTERN = r"^daily/[0-9]{4}-[0-9]{2}-[0-9]{2}\.(blocks|txs|events)(\.[0-9a-f]{16})?\.parquet$"
LOOKUP_KEY_PATTERN = r"^lookups/[A-Za-z0-9_-]+(\.[0-9a-f]{16})?\.(json|json\.gz|parquet)$"
GIB = 1024 ** 3

ENTRY_FIELDS = ("date", "kind", "key", "size", "md5", "schema_version")


def _day(c="date"):
    """Manifest date text to DATE; an impossible day (V11) is null."""
    return F.when(F.col(c).rlike(DATE_PATTERN), F.col(c).try_cast("date"))


def file_violations(files: DataFrame, strict_key: bool = True) -> DataFrame:
    """A2: add ``violations`` (array of rule names) to every file entry.

    Rules: ``date`` is ``YYYY-MM-DD`` and a real day (``2026-13-45`` is
    rejected), ``kind`` is known, ``md5`` is 32 lower-case hex, ``size >= 0``,
    and (``strict_key``) ``key`` follows the daily key layout.
    """
    date_ok = F.col("date").rlike(DATE_PATTERN) & F.col("date").try_cast("date").isNotNull()
    rules = [
        (F.coalesce(date_ok, F.lit(False)), "date"),
        (F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "kind"),
        (F.coalesce(F.col("md5").rlike(MD5_PATTERN), F.lit(False)), "md5"),
        (F.coalesce(F.col("size") >= 0, F.lit(False)), "size"),
    ]
    if strict_key:
        rules.append((F.coalesce(F.col("key").rlike(FILE_KEY_PATTERN), F.lit(False)), "key"))
    arr = F.filter(F.array(*[F.when(~ok, F.lit(name)) for ok, name in rules]),
                   lambda x: x.isNotNull())
    return files.withColumn("violations", arr)


def lookup_violations(lookups: DataFrame) -> DataFrame:
    """A2 for ``lookups`` rows ``(name, key, size, md5)``."""
    rules = [
        (F.coalesce(F.col("key").rlike(LOOKUP_KEY_PATTERN), F.lit(False)), "key"),
        (F.coalesce(F.col("md5").rlike(MD5_PATTERN), F.lit(False)), "md5"),
        (F.coalesce(F.col("size") >= 0, F.lit(False)), "size"),
    ]
    arr = F.filter(F.array(*[F.when(~ok, F.lit(name)) for ok, name in rules]),
                   lambda x: x.isNotNull())
    return lookups.withColumn("violations", arr)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without ``violations``, rejected rows with them)."""
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)


def validate(files: DataFrame, strict: bool = True) -> DataFrame:
    """A2, whole-manifest form: ``strict`` raises on any rejected entry (as
    the reference does); otherwise the valid rows are returned."""
    valid, rejected = split_valid(file_violations(files))
    if strict:
        bad = rejected.select("pos", "date", "kind", "violations").limit(5).collect()
        if bad:
            raise ValueError(f"invalid manifest entries: {[r.asDict() for r in bad]}")
    return valid


def resolve(files: DataFrame) -> DataFrame:
    """A5 (batch form): the entry that wins for every ``(date, kind)`` — the
    first in manifest order.  An aggregate, so it combines map-side."""
    first = F.min_by(F.struct(*ENTRY_FIELDS[2:]), F.col("pos"))
    return (files.groupBy("date", "kind")
                 .agg(first.alias("e"), F.min("pos").alias("pos"))
                 .select("date", "kind", "e.key", "e.size", "e.md5", "e.schema_version", "pos"))


def duplicates(files: DataFrame) -> DataFrame:
    """``(date, kind)`` listed more than once, with how many times."""
    return (files.groupBy("date", "kind").agg(F.count(F.lit(1)).alias("copies"))
                 .filter("copies > 1"))


def available_dates(files: DataFrame, kind: str) -> DataFrame:
    """A3: distinct dates of ``kind``, as DATE, ascending."""
    check_kind(kind)
    return (files.filter(F.col("kind") == kind)
                 .select(_day().alias("date")).where(F.col("date").isNotNull())
                 .distinct().orderBy("date"))


def complete_days(files: DataFrame) -> DataFrame:
    """Days that carry all three kinds."""
    return (files.filter(F.col("kind").isin(*KINDS))
                 .groupBy(_day().alias("date"))
                 .agg(F.count_distinct("kind").alias("kinds"))
                 .filter(F.col("kinds") == len(KINDS)).select("date"))


def latest_complete(files: DataFrame, declared: str | None = None) -> DataFrame:
    """A4: the latest day with all three kinds (null if none), beside the
    manifest's declared ``latest_complete_date``."""
    derived = complete_days(files).agg(F.max("date").alias("latest_complete_date"))
    return derived.select(
        "latest_complete_date",
        F.lit(declared).cast("date").alias("declared_latest_complete_date"))


def entry(files: DataFrame, date: str, kind: str) -> dict:
    """A5 point form: the winning entry for ``(date, kind)`` as a dict.

    Missing raises ``FileNotFoundError`` naming the latest complete date.
    """
    check_kind(kind)
    rows = resolve(files.filter((F.col("date") == date) & (F.col("kind") == kind))).collect()
    if not rows:
        latest = latest_complete(files).collect()[0][0]
        raise FileNotFoundError(
            f"no {kind} file for {date} in the manifest; latest complete date is {latest}")
    return rows[0].asDict()


def range_entries(files: DataFrame, start: str, end: str, kind: str) -> DataFrame:
    """Winning entries with ``start <= date <= end``, inclusive; gaps are
    simply absent.  Lazy; see :func:`range_list` for the raising form."""
    check_kind(kind)
    if str(end) < str(start):
        raise ValueError(f"end {end} is before start {start}")
    f = files.filter((F.col("kind") == kind) & _day().isNotNull()
                     & (F.col("date") >= str(start)) & (F.col("date") <= str(end)))
    return resolve(f)


def range_list(files: DataFrame, start: str, end: str, kind: str) -> list[dict]:
    """A6 as a date-ordered list (catalog rows only; bounded by the days in
    the range).  An empty range raises ``FileNotFoundError``."""
    rows = range_entries(files, start, end, kind).orderBy("date").collect()
    if not rows:
        raise FileNotFoundError(f"no {kind} files between {start} and {end}")
    return [r.asDict() for r in rows]


def locate(entries: DataFrame, base: str) -> DataFrame:
    """The URL or path of each entry, from the manifest key."""
    return entries.withColumn("url", F.concat(F.lit(base.rstrip("/")), F.lit("/"), F.col("key")))


def summary(files: DataFrame) -> DataFrame:
    """Per kind, files, bytes, first and last date; the row with a null
    ``kind`` is the total.  Kinds without files do not appear."""
    return (files.rollup("kind")
                 .agg(F.count(F.lit(1)).alias("files"),
                      F.sum("size").cast("bigint").alias("bytes"),
                      F.min("date").alias("first_date"),
                      F.max("date").alias("last_date"))
                 .withColumn("gib", (F.col("bytes").cast("decimal(38,0)") / F.lit(GIB))
                                    .cast("decimal(20,3)")))


def gaps(files: DataFrame, kind: str | None = None) -> DataFrame:
    """``(kind, prev, cur, missing_days)`` for every hole inside each
    kind's first..last date.  The window runs over distinct catalog dates."""
    f = files if kind is None else files.filter(F.col("kind") == check_kind(kind))
    days = f.select("kind", _day().alias("date")).where(F.col("date").isNotNull()).distinct()
    w = Window.partitionBy("kind").orderBy("date")
    return (days.select("kind", F.lag("date").over(w).alias("prev"), F.col("date").alias("cur"))
                .where(F.col("prev").isNotNull())
                .select("kind", "prev", "cur",
                        (F.datediff("cur", "prev") - 1).cast("bigint").alias("missing_days"))
                .where(F.col("missing_days") > 0))


def diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """A10: snapshot diff on ``(date, kind)``: ``new``, ``rebuilt`` (md5 or
    size changed) and ``vanished`` (breaks the contract); unchanged rows are
    left out."""
    p = resolve(previous).select("date", "kind", F.col("md5").alias("old_md5"),
                                 F.col("size").alias("old_size"))
    c = resolve(current).select("date", "kind", F.col("md5").alias("new_md5"),
                                F.col("size").alias("new_size"))
    j = p.join(c, ["date", "kind"], "full_outer")
    status = (F.when(F.col("old_md5").isNull() & F.col("old_size").isNull(), "new")
               .when(F.col("new_md5").isNull() & F.col("new_size").isNull(), "vanished")
               .when((F.col("old_md5") != F.col("new_md5")) | (F.col("old_size") != F.col("new_size")),
                     "rebuilt"))
    return (j.withColumn("status", status).where(F.col("status").isNotNull())
             .select("date", "kind", "status", "old_md5", "new_md5", "old_size", "new_size"))


def latest_moved_back(previous_latest: str | None, current_latest: str | None) -> bool:
    """A10: a ``latest_complete_date`` that moves back breaks the contract."""
    return bool(previous_latest and current_latest and current_latest < previous_latest)
