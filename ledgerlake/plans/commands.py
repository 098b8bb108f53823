"""One function per data command of the reference's command line.

No argument parsing (see README, "Survey items re-aimed"): each command is a
function over an :class:`~ledgerlake.sources.archive.Archive` that returns a
value or a lazy DataFrame; printing is ``df.show`` or a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.operators import integrity as I
from ledgerlake.operators import lookups as L
from ledgerlake.sources.archive import Archive
from ledgerlake.sources.lookups import read_lookup

# Lookup names per command kind (fixed values of the archive layout).
LOOKUP_FOR = {"selector": "function_selectors", "topic": "event_topics"}


def manifest(archive: Archive) -> dict:
    """``manifest``: chain, version, lookups and the per-kind file summary."""
    return archive.summary()


def latest(archive: Archive) -> str:
    """``latest``: the latest complete date, or an empty string."""
    d = archive.latest_complete_date()
    return d.isoformat() if d else ""


def dates(archive: Archive, kind: str = "txs") -> list[str]:
    """``dates``: available dates of ``kind``, ascending."""
    return [d.isoformat() for d in archive.available_dates(kind)]


def url(archive: Archive, date: str, kind: str) -> str:
    """``url``: the path of one (date, kind), from the manifest key."""
    return archive.url_for(date, kind)


def fetch(spark: SparkSession, archive: Archive, date: str, kind: str, dest_root: str) -> dict:
    """``fetch``: copy one verified file into ``dest_root``."""
    e = archive._entry(str(date), kind)
    one = spark.createDataFrame([e]).select("date", "kind", "key", "size", "md5", "schema_version")
    return I.mirror(spark, archive.root, dest_root, one, tasks=1).first().asDict()


def show(archive: Archive, date: str, kind: str, limit: int = 20, fmt: str = "table",
         out: str | None = None, decode: bool | None = None) -> DataFrame:
    """``show``: the first ``limit`` rows of a day (0 is all) in the natural
    order; ``decode=False`` shows raw hex.  ``fmt`` 'table' prints, 'ndjson'
    and 'csv' write to ``out``."""
    df = archive.head(date, kind, limit, decode)
    if fmt == "table" and limit:
        df.show(limit, truncate=False)
    elif fmt == "table":  # all rows: a partition at a time, never the whole day
        print("|".join(df.columns))
        for row in df.toLocalIterator(prefetchPartitions=True):
            print("|".join("NULL" if v is None else str(v) for v in row))
    elif fmt == "ndjson":
        sinks.write_ndjson(df, out)
    elif fmt == "csv":
        sinks.write_csv(df, out)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return df


def lookup(spark: SparkSession, archive: Archive, which: str, key: str,
           normalised: DataFrame | None = None) -> DataFrame:
    """``lookup selector|topic KEY``: ranked candidates of one key
    (case-insensitive; missing count ranks as 0; no rows when unknown).
    ``normalised`` is an E1 table; without it the JSON is read directly."""
    if which not in LOOKUP_FOR:
        raise ValueError(f"unknown lookup {which!r}; expected selector or topic")
    cands = normalised
    if cands is None:
        lk = {r["name"]: r.asDict() for r in
              archive.manifest.select(F.explode("lookups").alias("name", "l"))
                              .select("name", "l.key", "l.size", "l.md5").collect()}
        entry = lk[LOOKUP_FOR[which]]
        cands = read_lookup(spark, archive.path(entry["key"]), entry)
    return L.lookup(cands, [key]).orderBy("rank")
