"""Contract checks on rows (D3).

Reports violations with a count and one example key; never stops the job.
Every check aggregates before it joins: events are reduced to distinct
``(tx_hash, block_number)`` pairs with their counts map-side, so a hot tx or
block never lands whole in one shuffle partition.

:class:`ContractState` keeps the checks of an ingested lake up to date from the days that
changed.  Its tables are mergeable summaries: counts per day and block, and, for
events against txs, the mismatches of every pair of days (nearly all of a day with
itself).  A changed day replaces its summaries; events of other days meet only its
txs, cut by a Bloom filter before any shuffle.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import bloom
from ledgerlake.plans.joins import DEFAULT_LIMIT, measure
from ledgerlake.session import shuffles_dropped

# Check names (fixed values, in report order).
CHECKS = ("dup_block_number", "dup_event_key", "tx_without_block",
          "event_without_block", "event_block_mismatch")


def _report(name: str, df: DataFrame, weight: str | None, example) -> DataFrame:
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("violations"),
                  F.min(example).alias("example")).select(
        F.lit(name).alias("check"), "violations", "example")


def contract_checks(blocks: DataFrame, txs: DataFrame, events: DataFrame) -> DataFrame:
    """D3: (check, violations, example) for the five row-level rules.

    * ``dup_block_number``: block numbers appearing more than once (keys);
    * ``dup_event_key``: ``(block_number, log_index)`` pairs repeated (keys);
    * ``tx_without_block`` / ``event_without_block``: rows whose block is absent;
    * ``event_block_mismatch``: events whose ``block_number`` differs from
      their tx's.
    """
    block_keys = blocks.select(F.col("number").alias("block_number")).distinct()

    dup_blocks = (blocks.groupBy("number").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1"))
    dup_events = (events.groupBy("block_number", "log_index").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1"))
    tx_blocks = (txs.groupBy("block_number")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("tx_hash").alias("ex")))
    # Events are read once more for their blocks alone, a small key; only the
    # mismatch check shuffles the wide (tx_hash, block_number).
    ev_blocks = (events.groupBy("block_number")
                       .agg(F.count(F.lit(1)).alias("n"), F.min("tx_hash").alias("ex")))
    ev_pairs = (events.groupBy("tx_hash", F.col("block_number").alias("ev_block"))
                      .agg(F.count(F.lit(1)).alias("n")))
    mismatch = (ev_pairs.join(txs.select("tx_hash", "block_number"), "tx_hash", "inner")
                        .filter(F.col("ev_block") != F.col("block_number")))

    parts = [
        _report("dup_block_number", dup_blocks, None, F.col("number").cast("string")),
        _report("dup_event_key", dup_events, None,
                F.concat_ws(":", F.col("block_number").cast("string"),
                            F.col("log_index").cast("string"))),
        _report("tx_without_block", tx_blocks.join(block_keys, "block_number", "left_anti"),
                "n", F.col("ex")),
        _report("event_without_block", ev_blocks.join(block_keys, "block_number", "left_anti"),
                "n", F.col("ex")),
        _report("event_block_mismatch", mismatch, "n", F.col("tx_hash")),
    ]
    return reduce(DataFrame.unionByName, parts)


_STATE = {
    "blocks": "date date, version string, number long, n long",
    "txs": "date date, version string, block_number long, n long, ex string",
    "events": "date date, version string, block_number long, n long, ex string, dup_keys long, dup_ex string",
    "pairs": "event_date date, tx_date date, n long, ex string",
    "days": "date string, kind string, md5 string, version string",
}


class ContractState:
    """D3 kept up to date for a lake of H1, under ``lake/_contract``.

    ``update`` finds the days whose ledger entry changed since the last update and does
    their part again; ``report`` gives the rows of :func:`contract_checks`.  Summaries are
    only ever appended, each under its update's version, and the list of days, written
    last, says which version of a day counts: an update that breaks off leaves nothing
    behind that is read.

    Rows meet by their tx hash packed (:func:`_packed`); what an update shuffles goes step by
    step, and its keys and filters go within it.
    """

    def __init__(self, spark: SparkSession, lake: str):
        self.spark, self.lake = spark, lake.rstrip("/")

    def _stored(self, name: str) -> DataFrame:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.lake}/_contract/{name}")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return self.spark.createDataFrame([], _STATE[name])
        return self.spark.read.schema(_STATE[name]).parquet(p.toString())

    def _state(self, name: str) -> DataFrame:
        """The summaries that count: a row a day of the calendar tells their versions."""
        days = self._stored("days").select(F.col("date").cast("date").alias("date"), "version").distinct()
        return self._stored(name).join(F.broadcast(days), ["date", "version"], "left_semi")

    def changed(self) -> tuple[list[str], DataFrame]:
        """Days to do again, and the ledger's latest entries."""
        from ledgerlake.streaming.ingest import latest_entries
        now = latest_entries(self.spark, self.lake).select("date", "kind", "md5").checkpoint()
        old = self._stored("days")
        moved = now.join(old, ["date", "kind", "md5"], "left_anti").select("date").union(
            old.join(now, ["date", "kind"], "left_anti").select("date"))
        return sorted(r[0] for r in moved.distinct().collect()), now

    def update(self) -> list[str]:
        """Bring the state up to the lake; returns the days done."""
        with shuffles_dropped(self.spark):
            return self._update()

    def _update(self) -> list[str]:
        from ledgerlake.streaming.ingest import _fs, read_lake
        days, now = self.changed()
        if not days:
            return []
        version = uuid.uuid4().hex
        blocks, txs, events = (read_lake(self.spark, self.lake, k) for k in ("blocks", "txs", "events"))
        of = lambda c: F.col(c).isin(*[F.lit(d).cast("date") for d in days])
        b, t, e = (x.where(of("date")) for x in (blocks, txs, events))
        new = {"blocks": b.groupBy("date", "number").agg(F.count(F.lit(1)).alias("n")),
               "txs": t.groupBy("date", "block_number").agg(F.count(F.lit(1)).alias("n"), F.min("tx_hash").alias("ex")),
               "events": _event_keys(e)}
        for name, df in new.items():
            df.withColumn("version", F.lit(version)).write.mode("append").parquet(f"{self.lake}/_contract/{name}")
        filters = f"{self.lake}/_contract/_filters-{version}"
        try:
            pairs = self._mismatches(t, e, txs, events.where(~of("date")), filters)
            kept = self._stored("pairs").where(~of("event_date") & ~of("tx_date"))
            kept.union(pairs).checkpoint().write.mode("overwrite").parquet(f"{self.lake}/_contract/pairs")
        finally:
            fs, p = _fs(self.spark, filters)
            fs.delete(p, True)
        same = self._stored("days").where(~F.col("date").isin(*days))
        done = now.where(F.col("date").isin(*days)).withColumn("version", F.lit(version))
        same.unionByName(done).checkpoint().write.mode("overwrite").parquet(f"{self.lake}/_contract/days")
        return days

    def _mismatches(self, changed_txs: DataFrame, changed_events: DataFrame, txs: DataFrame,
                    other_events: DataFrame, filters: str) -> DataFrame:
        """(event_date, tx_date, n, ex) of pairs of days with a changed one among them; the
        Bloom filters it needs are written under ``filters``."""
        from ledgerlake.streaming.ingest import _fs
        hashed = F.col("tx_hash").isNotNull()

        def tx_side(df):
            return df.where(hashed).select(_packed("tx_hash").alias("tx"), F.col("block_number").alias("tx_block"),
                                           F.col("date").alias("tx_date"))

        def event_side(df):
            return df.where(hashed).groupBy(_packed("tx_hash").alias("tx"), "block_number", F.col("date").alias(
                "event_date")).agg(F.count(F.lit(1)).alias("n"))

        def cut(df, keys, name):
            path = f"{filters}/{name}"
            (keys.where(hashed).select(_packed("tx_hash").alias("tx")).distinct()
             .write.option("compression", "zstd").parquet(f"{path}-keys"))
            used = self.spark.read.schema("tx binary").parquet(f"{path}-keys")
            blocks = bloom.blocks_for(used.count())
            if blocks * bloom.BLOCK_BYTES <= DEFAULT_LIMIT:
                bloom.build(used.select(_unpacked("tx").alias("tx_hash")), "tx_hash", blocks).write.parquet(path)
                df = bloom.may_hold(df, "tx_hash", self.spark.read.parquet(path), blocks)
            fs, p = _fs(self.spark, f"{path}-keys")
            fs.delete(p, True)
            return df

        both = event_side(changed_events).join(tx_side(cut(txs, changed_events, "events")), "tx").union(
            event_side(cut(other_events, changed_txs, "txs")).join(tx_side(changed_txs), "tx"))
        return (both.where(F.col("block_number") != F.col("tx_block")).groupBy("event_date", "tx_date")
                .agg(F.sum("n").alias("n"), F.min(_unpacked("tx")).alias("ex")))

    def report(self) -> DataFrame:
        """(check, violations, example), equal to :func:`contract_checks` over the lake."""
        with shuffles_dropped(self.spark):
            return self._report()

    def _report(self) -> DataFrame:
        from ledgerlake.streaming.ingest import read_lake
        blocks, txs, events = (self._state(k) for k in ("blocks", "txs", "events"))
        pairs = self._stored("pairs")
        keys = blocks.select(F.col("number").alias("block_number")).distinct()
        dup = blocks.groupBy("number").agg(F.sum("n").alias("n")).where("n > 1")
        # A block on several days: its keys are counted over all of them.
        spread, n, _ = measure(events.groupBy("block_number").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                               .select("block_number"))
        once = events.join(spread, events.block_number.eqNullSafe(spread.block_number), "left_anti").select("dup_keys", "dup_ex")
        if n:
            raw = read_lake(self.spark, self.lake, "events")
            raw = raw.join(spread, raw.block_number.eqNullSafe(spread.block_number), "left_semi")
            once = once.union(_event_keys(raw.withColumn("date", F.lit(None).cast("date"))).select("dup_keys", "dup_ex"))
        parts = [
            _report("dup_block_number", dup, None, F.col("number").cast("string")),
            _report("dup_event_key", once, "dup_keys", F.col("dup_ex")),
            _report("tx_without_block", txs.join(keys, "block_number", "left_anti"), "n", F.col("ex")),
            _report("event_without_block", events.join(keys, "block_number", "left_anti"), "n", F.col("ex")),
            _report("event_block_mismatch", pairs, "n", F.col("ex")),
        ]
        return reduce(DataFrame.unionByName, parts)


def _packed(column: str) -> Column:
    """The text as bytes, half as long where it is lower-case hex after ``0x``; the first byte
    tells which, so different texts stay different.  Null is no bytes at all."""
    text = F.col(column)
    hexed = text.startswith("0x") & (F.length(text) % 2 == 0) & (F.lower(text) == text)
    raw = F.unhex(F.substring(text, F.lit(3), F.length(text)))
    return F.coalesce(F.concat(F.lit(b"\x01"), F.when(hexed, raw)), F.concat(F.lit(b"\x00"), text.cast("binary")), F.lit(b""))


def _unpacked(column: str) -> Column:
    """The text that :func:`_packed` was given."""
    first, rest = (F.hex(F.substring(column, 1, 1)), F.substring(column, 2, 1 << 30))
    return F.when(first == "01", F.concat(F.lit("0x"), F.lower(F.hex(rest)))).when(first == "00", rest.cast("string"))


def _event_keys(events: DataFrame) -> DataFrame:
    """Per day and block: rows, an example, keys that occur more than once and the least."""
    key = F.concat_ws(":", F.col("block_number").cast("string"), F.col("log_index").cast("string"))
    each = events.groupBy("date", "block_number", "log_index").agg(
        F.count(F.lit(1)).alias("c"), F.min("tx_hash").alias("ex"))
    return each.groupBy("date", "block_number").agg(
        F.sum("c").alias("n"), F.min("ex").alias("ex"), F.count_if(F.col("c") > 1).alias("dup_keys"),
        F.min(F.when(F.col("c") > 1, key)).alias("dup_ex"))
