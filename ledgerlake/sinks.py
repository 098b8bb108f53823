"""Row outputs (G1-G3): NDJSON, CSV with header, partitioned Parquet.

All are distributed writes (one part file per task); nothing passes through
the driver.  Value conventions follow the reference's output: decimals are
written as strings (a wei amount does not survive a JSON number), binary as
lower-case hex, and nulls are written rather than dropped.

:func:`publish` writes any of them in two phases.  The parts go to a staging folder of
their own, where each is measured (size, MD5, in tasks); then one small file,
``_manifest.json``, is put in place of the old one and names the parts that count.  A
reader (:func:`published`) goes by it, so it sees the old output whole or the new one
whole, however a job ends.  Staging folders that no manifest names are removed by the
next publication.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, StructType

from ledgerlake.sources import fsio

MANIFEST = "_manifest.json"
PARTS_DDL = "path string, size long, md5 string"


def text_safe(df: DataFrame) -> DataFrame:
    """Decimals to their plain string, binary to lower-case hex."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, BinaryType):
            out.append(F.lower(F.hex(F.col(f.name))).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """G1: one JSON object per line, nulls kept, decimals as strings."""
    (text_safe(df).write.mode(mode)
        .option("ignoreNullFields", False)
        .option("lineSep", "\n")
        .json(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; null and ``""`` are both written empty; LF
    line ends."""
    (text_safe(df).write.mode(mode)
        .option("header", True)
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("lineSep", "\n")
        .csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = "date",
                  sort_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """G3 (decoded form): Parquet partitioned by ``partition_by``; with
    ``mode='overwrite'`` only the partitions present in ``df`` are replaced
    (dynamic overwrite).  Rows are sorted within each task, no shuffle; raw
    published bytes are copied by :func:`ledgerlake.operators.integrity.mirror`."""
    w = df
    keys = ([partition_by] if partition_by else []) + list(sort_by or [])
    if keys:
        w = w.sortWithinPartitions(*keys)
    writer = w.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


WRITERS = {"ndjson": write_ndjson, "csv": write_csv, "parquet": write_parquet}


def _files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path below ``folder``, size) of the data files in it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    base, out = fsio.qualify(spark, folder), []
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString()[len(base) + 1:]
        if not any(x[:1] in "._" for x in name.split("/")):
            out.append((name, f.getLen()))
    return sorted(out)


def publish(df: DataFrame, path: str, form: str, **options) -> dict:
    """G1-G3 in two phases; ``form`` is ndjson, csv or parquet, ``options`` its writer's.

    Returns the manifest: format, schema, time and the parts with size and MD5.
    """
    from ledgerlake.session import ship_package
    spark, path = df.sparkSession, fsio.qualify(df.sparkSession, path)
    stage = f"parts-{uuid.uuid4().hex}"
    WRITERS[form](df, f"{path}/{stage}", **options)
    found = [(f"{stage}/{name}", size) for name, size in _files(spark, f"{path}/{stage}")]

    def digests(batches):
        for pdf in batches:
            yield pdf.assign(md5=[fsio.md5_of(f"{path}/{p}")[1] for p in pdf["path"]])

    ship_package(spark)
    tasks = max(1, min(len(found), spark.sparkContext.defaultParallelism * 4))
    parts = spark.createDataFrame(found, "path string, size long").repartition(tasks).mapInPandas(digests, PARTS_DDL)
    schema = (df if form == "parquet" else text_safe(df)).schema
    doc = {"format": form, "published_at": datetime.now(timezone.utc).isoformat(), "schema": schema.jsonValue(),
           "parts": sorted((r.asDict() for r in parts.collect()), key=lambda r: r["path"])}  # a row a file
    tmp = f"{path}/.{MANIFEST}.{uuid.uuid4().hex[:8]}"
    with fsio.open_write(tmp) as out:
        out.write(json.dumps(doc).encode())
    fsio.rename(tmp, f"{path}/{MANIFEST}")
    _sweep(spark, path, stage)
    return doc


def _sweep(spark: SparkSession, path: str, keep: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if name.startswith("parts-") and name != keep:
            fs.delete(f.getPath(), True)


def manifest_of(spark: SparkSession, path: str) -> dict:
    """The manifest of a publication; FileNotFoundError before the first."""
    with fsio.open_read(f"{fsio.qualify(spark, path)}/{MANIFEST}") as f:
        return json.loads(f.read())


def published(spark: SparkSession, path: str, verify: bool = False) -> DataFrame:
    """The rows of a publication, exactly the parts of its manifest.

    Decimals of the text formats stay strings, as written.  ``verify`` checks the
    parts' sizes and MD5s first.
    """
    doc, base = manifest_of(spark, path), fsio.qualify(spark, path)
    schema = StructType.fromJson(doc["schema"])
    if verify and doc["parts"]:
        from ledgerlake.operators.integrity import OK, verify_objects
        rows = spark.createDataFrame([(p["path"], p["size"], p["md5"]) for p in doc["parts"]],
                                     "key string, size long, md5 string")
        bad = verify_objects(spark, base, rows).where(F.col("status") != OK).select("key", "status").collect()
        if bad:
            raise ValueError(f"parts fail verification: {[tuple(r) for r in bad[:5]]}")
    if not doc["parts"]:
        return spark.createDataFrame([], schema)
    paths = [f"{base}/{p['path']}" for p in doc["parts"]]
    reader = spark.read.schema(schema)
    if doc["format"] == "parquet":
        return reader.option("basePath", f"{base}/{doc['parts'][0]['path'].split('/')[0]}").parquet(*paths).select(
            *schema.names)
    if doc["format"] == "csv":
        return reader.option("header", True).csv(paths)
    return reader.json(paths)
