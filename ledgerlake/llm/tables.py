"""Intermediate tables written to the shared scratch folder.

Unlike ``checkpoint()``, a table read back carries no constraints inferred from
the plan that made it; in loops those grow with every turn until planning runs
out of memory.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import scratch_path


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None):
    """Arrow batches of at most ``rows`` in what runs here."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        if rows:
            spark.conf.set(name, str(rows))
        yield
    finally:
        spark.conf.set(name, before)


class Tables:
    """Tables of one operator's run; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name, unique=True), 0
        self.held: list[tuple[DataFrame, str]] = []

    def settle(self, df: DataFrame, batch_rows: int | None = None) -> DataFrame:
        """``df`` written and read again.

        ``batch_rows`` bounds the Arrow batches of this one write, for Python
        stages whose rows are long.
        """
        self.n += 1
        path = f"{self.root}/{self.n}"
        with _batches_of(self.spark, batch_rows):
            df.write.parquet(path, compression="zstd")
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def bucketed(self, df: DataFrame, n: int, by: str, batch_rows: int | None = None) -> DataFrame:
        """``df`` written in ``n`` buckets by a column and read again: grouping or joining
        by it then shuffles only the other side.

        Buckets need a catalog's table; it is external and leaves the catalog at once.
        """
        self.n += 1
        path, table = f"{self.root}/{self.n}", f"ledgerlake_{uuid.uuid4().hex}"
        with _batches_of(self.spark, batch_rows):
            df.write.bucketBy(n, by).option("path", path).format("parquet").saveAsTable(table)
        try:
            out = self.spark.table(table)
            out.schema
        finally:
            self.spark.sql(f"DROP TABLE {table}")
        self.held.append((out, path))
        return out

    def only(self, *dfs: DataFrame) -> None:
        """Delete all tables but these."""
        self.drop(*[x for x, _ in self.held if not any(x is y for y in dfs)])

    def drop(self, *dfs: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df, path in [x for x in self.held if any(x[0] is y for y in dfs)]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.held = [x for x in self.held if not any(x[0] is y for y in dfs)]
