"""Normalise a lookup JSON file into candidate rows.

The published file is one JSON object ``{key: [candidate, ...], ...}`` of
hundreds of MB.  :mod:`ledgerlake.sources.jsonsplit` cuts it into entries over
many tasks whatever its spacing and the shape of its entries; each entry's list is
parsed by ``from_json`` and ``posexplode``d into ``(key, pos, signature, count,
abi)``.  ``abi`` stays a JSON string.  A legacy entry, one candidate without a list,
is a list of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources import fsio
from ledgerlake.sources.jsonsplit import object_entries

CANDIDATES_DDL = "array<struct<signature:string,count:bigint,abi:string>>"
KEY = r'^\s*("(?:[^"\\]++|\\.)*+")\s*:'


def verify_lookup(spark: SparkSession, path: str, entry: dict) -> None:
    """Size and MD5 of a lookup file against its manifest entry, in a task; raises."""
    from ledgerlake.operators.integrity import MISSING, OK, Ledger
    root, _, name = path.rpartition("/")
    row = spark.createDataFrame([(name, entry["size"], entry["md5"])], "key string, size long, md5 string")
    status = Ledger(spark, root).check(row).first()["status"]
    if status == MISSING:
        raise FileNotFoundError(path)
    if status != OK:
        raise ValueError(f"lookup file does not match its manifest entry ({status}): {path}")


def read_lookup(spark: SparkSession, path: str, entry: dict | None = None) -> DataFrame:
    """Candidate rows ``(key, pos, signature, count, abi)``.

    ``entry`` is the manifest's entry of the file: size and MD5 are checked
    first.  The object must be whole, and an entry that does not parse raises.
    """
    from ledgerlake.session import scratch_root
    path = fsio.qualify(spark, path)
    if entry is not None:
        verify_lookup(spark, path, entry)
    elif fsio.size_of(path) is None:
        raise FileNotFoundError(path)
    scratch_root(spark)
    found = object_entries(spark, path)
    body = F.trim(F.regexp_replace("entry", KEY, ""), F.lit(" \t\r\n"))
    key = F.get(F.from_json(F.concat(F.lit("["), F.regexp_extract("entry", KEY, 1), F.lit("]")), "array<string>"), F.lit(0))
    parsed = found.select(F.lower(key).alias("key"), body.alias("body"),
                          F.col("entry").rlike(KEY).alias("has_key"))
    legacy = F.col("body").startswith("{") & F.col("body").endswith("}")
    lists = F.when(legacy, F.concat(F.lit("["), F.col("body"), F.lit("]"))).otherwise(F.col("body"))
    is_list = lists.startswith("[") & lists.endswith("]")
    # Parse once: the check and the result both read the checkpoint.
    parsed = parsed.select("key", "has_key", is_list.alias("is_list"),
                           F.from_json(lists, CANDIDATES_DDL).alias("c")).checkpoint(eager=True)
    bad = parsed.where(~F.col("has_key") | ~F.col("is_list") | F.col("c").isNull()).select("key").limit(3).collect()
    if bad:
        raise ValueError(f"lookup entries do not parse: {[r[0] for r in bad]}")
    return (parsed.select("key", F.posexplode("c").alias("pos", "x"))
                  .select("key", F.col("pos").cast("bigint").alias("pos"),
                          "x.signature", "x.count", "x.abi"))


def normalise_lookup(spark: SparkSession, path: str, dest: str) -> DataFrame:
    """E1 to Parquet, range-partitioned and sorted by ``key`` so a key
    lookup (E2) prunes to few row groups; returns the written table."""
    df = read_lookup(spark, path)
    (df.repartitionByRange("key").sortWithinPartitions("key", "pos")
       .write.mode("overwrite").parquet(dest))
    return spark.read.parquet(dest)
