"""Joins with a side whose size is checked, not assumed.

AQE can turn a sort-merge join into a broadcast once a side's shuffle stage
has finished, but it launches both sides' stages together: by the time the
small side is known to be small, the big side has already been shuffled by
the join key (a hot key included).  For the joins where one side is a reduced
lookup or a per-block table, we therefore materialise that side first
(``checkpoint()`` into the shared checkpoint folder, which also cuts its
lineage), measure its exact size in one aggregate over the materialised rows,
and broadcast it only under the limit.  Beyond the limit the join stays a
sort-merge join and AQE's skew handling splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ledgerlake.functions import bloom
from ledgerlake.session import scratch_root

LIMIT_CONF = "ledgerlake.broadcastBytes"
DEFAULT_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def broadcast_limit(spark) -> int:
    """Bytes under which a measured side is broadcast (``ledgerlake.broadcastBytes``)."""
    v = spark.conf.get(LIMIT_CONF, None)
    return int(v) if v else DEFAULT_LIMIT


# Fixed per-value sizes of the flat types (bytes in Spark's row format).
FIXED_SIZE = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
              "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def _bytes_expr(df: DataFrame) -> Column:
    parts = [F.lit(ROW_OVERHEAD)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(FIXED_SIZE.get(f.dataType.typeName(), 8)))
    e = parts[0]
    for p in parts[1:]:
        e = e + p
    return e.cast("bigint")


def measure(small: DataFrame) -> tuple[DataFrame, int, int]:
    """Materialise ``small`` (reliable checkpoint) and return it with its
    exact row count and byte size."""
    scratch_root(small.sparkSession)  # make sure a checkpoint folder is set
    m = small.checkpoint(eager=True)
    r = m.agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes_expr(m)).alias("b")).first()
    return m, int(r["n"] or 0), int(r["b"] or 0)


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "left",
                 limit: int | None = None) -> DataFrame:
    """``big.join(small, on, how)`` with ``small`` broadcast only when its
    measured size is under ``limit`` (default :func:`broadcast_limit`).

    Beyond the limit the join is left to sort-merge and AQE's skew handling.
    """
    lim = broadcast_limit(big.sparkSession) if limit is None else limit
    m, _, nbytes = measure(small)
    side = F.broadcast(m) if nbytes <= lim else m
    return big.join(side, on, how)


# Most keys that a split join treats as frequent.
FREQUENT_KEYS = 1000


def key_counts(df: DataFrame, key: Column) -> DataFrame:
    """Rows of each key, null included: (_lk, rows)."""
    return df.select(key.alias("_lk")).groupBy("_lk").agg(F.count(F.lit(1)).alias("rows"))


def frequent(df: DataFrame, key: Column, share: float, counts: DataFrame | None = None) -> list[str]:
    """Keys that hold at least ``share`` of the rows, the ``FREQUENT_KEYS`` most frequent of
    them; from ``counts`` where :func:`key_counts` has been taken already."""
    counts = key_counts(df, key) if counts is None else counts
    n = counts.agg(F.sum("rows")).first()[0] or 0
    top = counts.where(F.col("_lk").isNotNull() & (F.col("rows") >= max(1, share * n)))
    return [r["_lk"] for r in top.orderBy(F.desc("rows"), "_lk").limit(FREQUENT_KEYS).collect()]


def left_join_keyed(big: DataFrame, key: Column, table: DataFrame, never: tuple[str, ...] = (),
                    limit: int | None = None) -> DataFrame:
    """``big`` left-joined with ``table`` (one row a key, in column ``_lk``) on ``key``.

    ``table`` is broadcast if its measured size is under ``limit``; else the keys of
    ``big`` are counted, once for all that follows, and the table is cut to those that
    are used (a Bloom filter before any shuffle, then a semi-join) and measured again.
    Beyond that the rows are split: those of frequent keys, of the
    ``never`` keys and without a key meet a broadcast of the few table rows they can
    match and are not shuffled, the rest is joined by sort-merge.
    """
    spark = big.sparkSession
    lim = broadcast_limit(spark) if limit is None else limit
    m, _, nbytes = measure(table)
    if nbytes > lim:
        counts, n, _ = measure(key_counts(big, key))
        used = counts.where(F.col("_lk").isNotNull()).select("_lk")
        m, _, nbytes = measure(bloom.cut(m, "_lk", used, n, DEFAULT_LIMIT).join(used, "_lk", "left_semi"))
    if nbytes <= lim:
        return big.join(F.broadcast(m), key == F.col("_lk"), "left").drop("_lk")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = sorted({*never, *frequent(big, key, 1 / (4 * width), counts)})
    few, _, size = measure(m.where(F.col("_lk").isin(*hot)) if hot else m.limit(0))
    if size > max(lim, DEFAULT_LIMIT):  # a few huge rows: only keys that match nothing stay apart
        hot = list(never)
        few = m.where(F.col("_lk").isin(*hot)) if hot else m.limit(0)
    # The key is evaluated once: it may be dear, and a filter shares nothing.
    apart = F.coalesce(key.isin(*hot), F.lit(True)) if hot else key.isNull()
    near = big.where(apart).join(F.broadcast(few), key == F.col("_lk"), "left")
    far = big.where(~apart).join(m.where(~F.col("_lk").isin(*hot)) if hot else m, key == F.col("_lk"), "left")
    return near.unionByName(far).drop("_lk")
