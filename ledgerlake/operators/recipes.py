"""Relational recipes users run over blocks, txs and events.

Every function takes decoded DataFrames and returns a lazy DataFrame.  The
shapes follow the cookbook; the physical choices are Spark's:

* aggregate-before-join for the 1:N side (events per tx, per block), so a hot
  tx or block is combined map-side before any shuffle and the join sees at
  most one row per key;
* no blind broadcast: where the big side is a bare scan (F1), the per-block
  side is materialised and measured first and broadcast only under the limit
  (:func:`ledgerlake.plans.joins.join_checked`); where the join sits above
  another shuffle (F2, F3), AQE decides from the finished blocks stage before
  the big side's exchange starts; beyond the limit joins stay sort-merge and
  AQE splits skewed partitions;
* top-k is ``orderBy(...).limit(k)`` with a total order, which plans as
  ``TakeOrderedAndProject`` (per-partition heaps, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans.joins import join_checked


def _count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def blocks_txs(blocks: DataFrame, txs: DataFrame) -> DataFrame:
    """inner equi-join of blocks with txs on ``number = block_number``."""
    b = blocks.select(F.col("number").alias("block_number"),
                      F.col("timestamp").alias("block_timestamp"),
                      F.col("base_fee_per_gas"))
    t = txs.select("block_number", "tx_hash", "from_address", "to_address", "value", "status")
    return join_checked(t, b, "block_number", "inner")


def events_per_tx_top(blocks: DataFrame, txs: DataFrame, events: DataFrame,
                      k: int = 20) -> DataFrame:
    """event count per tx (0 without events), top ``k``.

    Events are counted per ``tx_hash`` first; summing after the join keeps the
    result equal to ``COUNT(e.tx_hash)`` even for duplicate txs.  The blocks
    join sits above the ``tx_hash`` shuffle: the blocks scan is a leaf stage
    that has finished before the joined side's exchange would start, so AQE
    already knows its size and broadcasts it without shuffling the big side.
    """
    ev = _count_by(events, "tx_hash", "n")
    t = txs.select("tx_hash", "block_number", "status")
    b = blocks.select(F.col("number").alias("block_number"))
    joined = t.join(ev, "tx_hash", "left").join(b, "block_number", "inner")
    return (joined.groupBy("block_number", "tx_hash", "status")
                  .agg(F.sum(F.coalesce(F.col("n"), F.lit(0))).cast("bigint").alias("event_count"))
                  .orderBy(F.desc("event_count"), F.asc("tx_hash"))
                  .limit(k))


def tx_detail(blocks: DataFrame, txs: DataFrame, events: DataFrame) -> DataFrame:
    """per tx, its block timestamp (or null) and event count (or 0).

    As in F2, the blocks join comes after the ``tx_hash`` shuffle, where AQE
    decides from the finished blocks stage."""
    ev = _count_by(events, "tx_hash", "n")
    b = blocks.select(F.col("number").alias("block_number"),
                      F.col("timestamp").alias("block_timestamp"))
    t = txs.select("tx_hash", "block_number", "status")
    return (t.join(ev, "tx_hash", "left").join(b, "block_number", "left")
             .select("tx_hash", "block_number", "status", "block_timestamp",
                     F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("event_count")))


def failed_txs(txs: DataFrame) -> DataFrame:
    """failed txs (``status = 0``); the filter reaches the Parquet scan."""
    return txs.filter(F.col("status") == 0)


def failed_count(txs: DataFrame) -> DataFrame:
    """the count of failed txs as a one-row frame."""
    return failed_txs(txs).agg(F.count(F.lit(1)).alias("failed_txs"))


def failed_per_block_top(txs: DataFrame, k: int = 20) -> DataFrame:
    """failed txs per block, top ``k``, tie-break ``block_number``."""
    return (_count_by(failed_txs(txs).select("block_number"), "block_number", "failed_txs")
            .orderBy(F.desc("failed_txs"), F.asc("block_number"))
            .limit(k))


def failed_per_day(txs: DataFrame) -> DataFrame:
    """failed and all txs per day plus a total row (``date`` null).

    Days with no failure show 0.  ``rollup`` computes the total in the same
    aggregation instead of a second pass.
    """
    return (txs.rollup("date")
               .agg(F.count_if(F.col("status") == 0).alias("failed_txs"),
                    F.count(F.lit(1)).alias("txs")))


def top_topics(events: DataFrame, k: int = 10) -> DataFrame:
    """top ``k`` ``topic0`` by rows; null is its own group."""
    return (events.select("topic0").groupBy("topic0")
                  .agg(F.count(F.lit(1)).alias("events"))
                  .orderBy(F.desc("events"), F.asc_nulls_first("topic0"))
                  .limit(k))


def events_per_block_top(events: DataFrame, k: int = 5) -> DataFrame:
    """F8: events per block, top ``k``, tie-break ``block_number``."""
    return (_count_by(events.select("block_number"), "block_number", "events")
            .orderBy(F.desc("events"), F.asc("block_number"))
            .limit(k))


def block_rollup(blocks: DataFrame, txs: DataFrame, events: DataFrame) -> DataFrame:
    """per block, txs, failed txs and events (0 when none).

    Both sides are pre-aggregated by block number, so the three-way join is
    on one key and shares one hash partitioning.
    """
    t = (txs.groupBy("block_number")
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.count_if(F.col("status") == 0).alias("failed_txs")))
    e = _count_by(events, "block_number", "event_count")
    b = blocks.select(F.col("number").alias("block_number"), "timestamp", "gas_used")
    return (b.join(t, "block_number", "left").join(e, "block_number", "left")
             .select("block_number", "timestamp", "gas_used",
                     F.coalesce("tx_count", F.lit(0)).cast("bigint").alias("tx_count"),
                     F.coalesce("failed_txs", F.lit(0)).cast("bigint").alias("failed_txs"),
                     F.coalesce("event_count", F.lit(0)).cast("bigint").alias("event_count")))


def row_counts(frames: dict[str, DataFrame], by_date: bool = True) -> DataFrame:
    """rows per kind (and day).  Only the ``date`` column is read."""
    parts = []
    for kind, df in frames.items():
        g = df.groupBy("date") if by_date else df.groupBy()
        parts.append(g.agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit(kind)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    cols = ["kind", "date", "rows"] if by_date else ["kind", "rows"]
    return out.select(*cols)


def failed_and_all(txs: DataFrame) -> DataFrame:
    """Failed txs and all txs of each day."""
    return (txs.groupBy("date")
               .agg(F.count_if(F.col("status") == 0).alias("failed_txs"), F.count(F.lit(1)).alias("txs")))


def prefix_sums(per_day: DataFrame, day: str, sums: dict[str, str], base: dict[str, int] | None = None) -> DataFrame:
    """Running sums over days in two levels: within a month by a window, then the months'
    offsets, which are as many rows as the calendar has months and are summed on the
    driver.  ``sums`` names the result of each column, ``base`` what came before.
    ``per_day`` (a row a day) is materialised once.
    """
    from pyspark.sql import Window

    from ledgerlake.session import scratch_root
    spark = per_day.sparkSession
    scratch_root(spark)
    days = per_day.withColumn("_month", F.trunc(F.col(day), "month")).checkpoint()
    months = days.groupBy("_month").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    total, rows = dict(base or {}), []
    for r in sorted(months, key=lambda r: (r["_month"] is not None, r["_month"])):
        rows.append((r["_month"], *[total.get(c, 0) for c in sums]))
        total = {c: total.get(c, 0) + (r[c] or 0) for c in sums}
    offsets = spark.createDataFrame(rows, "_of date, " + ", ".join(f"_before_{c} long" for c in sums))
    w = Window.partitionBy("_month").orderBy(F.asc_nulls_first(day)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = days.join(F.broadcast(offsets), F.col("_month").eqNullSafe(F.col("_of")))
    return joined.select(*per_day.columns, *[(F.sum(c).over(w) + F.col(f"_before_{c}")).cast("bigint").alias(name)
                                             for c, name in sums.items()])


def running_totals(txs: DataFrame) -> DataFrame:
    """H3 (batch): per-day failed txs and the running total up to that day.

    Sums run over the one-row-per-day aggregate, never over raw rows, and in two levels
    (:func:`prefix_sums`), so no window has all days in one partition.
    """
    return prefix_sums(failed_and_all(txs), "date", {"failed_txs": "failed_running", "txs": "txs_running"})
