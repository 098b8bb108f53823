"""Read the archive manifest as DataFrames (A1).

The manifest is one JSON document (at most 16 MiB by contract).  Spark reads
it with an explicit schema and explodes it into three tables: ``files`` (one
row per entry, with its array position), ``lookups`` and ``columns``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import DEFAULT_CHAIN_ID, MANIFEST

MANIFEST_NAME = "manifest.json"
FILES_DDL = ("pos bigint, date string, kind string, key string, size bigint, md5 string, "
             "schema_version string")


def manifest_path(root: str) -> str:
    return root if root.endswith(".json") else f"{root.rstrip('/')}/{MANIFEST_NAME}"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """A1: the manifest as a one-row DataFrame with defaults applied: empty
    ``columns``, ``lookups`` and ``files`` when absent."""
    m = (spark.read.schema(MANIFEST).option("multiLine", True)
              .option("mode", "FAILFAST").json(manifest_path(root)))
    return m.select(
        "chain_id", "generated_at", "schema_version", "latest_complete_date",
        F.coalesce("columns", F.create_map().cast(MANIFEST["columns"].dataType)).alias("columns"),
        F.coalesce("lookups", F.create_map().cast(MANIFEST["lookups"].dataType)).alias("lookups"),
        F.coalesce("files", F.array().cast(MANIFEST["files"].dataType)).alias("files"))


def files_table(manifest: DataFrame) -> DataFrame:
    """``files`` exploded: ``(pos, date, kind, key, size, md5, schema_version)``."""
    return (manifest.select(F.posexplode("files").alias("pos", "f"))
                    .select(F.col("pos").cast("bigint").alias("pos"), "f.*"))


def lookups_table(manifest: DataFrame) -> DataFrame:
    """``lookups`` exploded: ``(name, key, size, md5)``."""
    return (manifest.select(F.explode("lookups").alias("name", "l"))
                    .select("name", "l.key", "l.size", "l.md5"))


def columns_table(manifest: DataFrame) -> DataFrame:
    """Declared column order: ``(kind, position, column)``."""
    return (manifest.select(F.explode("columns").alias("kind", "cols"))
                    .select("kind", F.posexplode("cols").alias("position", "column")))


def header(manifest: DataFrame) -> dict:
    """The scalar fields (one small row)."""
    r = manifest.select("chain_id", "generated_at", "schema_version",
                        "latest_complete_date").first()
    return r.asDict() if r else {}


def check_chain(manifest: DataFrame, expected: int = DEFAULT_CHAIN_ID) -> dict:
    """Raise when ``chain_id`` is not the expected one; return the header."""
    h = header(manifest)
    if h.get("chain_id") != expected:
        raise ValueError(f"manifest chain_id {h.get('chain_id')} is not {expected}")
    return h
