"""Counts and block ranges from Parquet footers (F10 and A8 without reading data).

A footer lists its file's row groups with their rows, bytes and the least and greatest
value of each column.  The table of these, one row a row group, answers how many rows
a day has and which blocks it spans from some kilobytes a file; no column page is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import BLOCK_COLUMN
from ledgerlake.sources import fsio

GROUPS_DDL = ("date string, kind string, key string, row_group long, rows long, bytes long, "
              "first_block long, last_block long")


def row_groups(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """One row per row group of the files (date, kind, key) under ``root``.

    ``first_block`` and ``last_block`` are null where the group has no statistics of its
    block column (an older writer, or no row).
    """
    from ledgerlake.session import ship_package
    base = fsio.qualify(spark, root)

    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                with fsio.open_random(f"{base}/{r.key}") as f:
                    meta = pq.ParquetFile(f).metadata
                names = [meta.schema.column(i).path for i in range(meta.num_columns)]
                at = names.index(BLOCK_COLUMN[r.kind]) if BLOCK_COLUMN[r.kind] in names else None
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    st = group.column(at).statistics if at is not None else None
                    span = (st.min, st.max) if st is not None and st.has_min_max else (None, None)
                    out.append((r.date, r.kind, r.key, g, group.num_rows, group.total_byte_size, *span))
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in GROUPS_DDL.split(", ")]).astype(
                {"first_block": "Int64", "last_block": "Int64"})

    ship_package(spark)
    paths = files.select("date", "kind", "key")
    # By entries: the cores may not all be there yet.
    tasks = max(spark.sparkContext.defaultParallelism * 2, paths.count() // 100)
    return paths.repartition(tasks).mapInPandas(read, GROUPS_DDL)


def row_counts(groups: DataFrame) -> DataFrame:
    """F10 from footers: (kind, date, rows); a day without rows has none."""
    per_day = groups.groupBy("kind", F.col("date").cast("date").alias("date")).agg(F.sum("rows").alias("rows"))
    return per_day.where("rows > 0")


def block_ranges(groups: DataFrame) -> DataFrame:
    """Per kind and day: row groups, rows, bytes and the span of blocks."""
    return groups.groupBy("kind", F.col("date").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("row_groups"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        F.min("first_block").alias("first_block"), F.max("last_block").alias("last_block"))
