"""Selector and topic labels (E2-E7) over normalised candidate tables.

A candidate table has one row per ``(key, pos)``: ``key`` (lower-case hex),
``pos`` (position in the published list), ``signature``, ``count``, ``abi``
(JSON text).  It is produced from the lookup JSON by
:func:`ledgerlake.sources.lookups.read_lookup`.

Join strategy for labelling (E4, E5, E6): the lookup is reduced to the best
candidate per key (E3, an aggregate over the lookup, not the data) and joined by
:func:`ledgerlake.plans.joins.left_join_keyed`: broadcast under a measured size; over
it (the ~650 MB selector file) cut to the keys the data uses and measured again;
beyond that split, so that hot selectors, value transfers, ``transfer`` and rows
without a selector are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.hexnum import norm_key
from ledgerlake.functions import bloom
from ledgerlake.plans.joins import DEFAULT_LIMIT, left_join_keyed, measure

# Keys that never resolve (fixed values: value-only transfer markers).
NO_SELECTOR = ("", "0x")


def _key(c) -> Column:
    return norm_key(F.col(c) if isinstance(c, str) else c)


def rank_candidates(cands: DataFrame) -> DataFrame:
    """Add ``rank`` (1 = best): ``count`` descending (missing is 0), then
    list position; stable on ties."""
    w = Window.partitionBy("key").orderBy(
        F.coalesce(F.col("count"), F.lit(0)).desc(), F.col("pos").asc())
    return cands.withColumn("rank", F.row_number().over(w).cast("bigint"))


def lookup(cands: DataFrame, keys: list[str]) -> DataFrame:
    """E2 for literal keys (the CLI form): ranked candidates of each key,
    case-insensitive; an unknown key gives no rows."""
    wanted = [k.lower() for k in keys]
    return rank_candidates(cands.filter(F.col("key").isin(wanted)))


def resolve_keys(cands: DataFrame, data: DataFrame, key_col: str) -> DataFrame:
    """E2 for the keys used in ``data``: ranked candidates of every key that
    appears in ``data[key_col]`` (left-semi join, keys lower-cased).  A Bloom filter of
    the used keys cuts the candidates before they are shuffled."""
    used, n, _ = measure(data.select(_key(key_col).alias("key")).where(F.col("key").isNotNull()).distinct())
    return rank_candidates(bloom.cut(cands, "key", used, n, DEFAULT_LIMIT).join(used, "key", "left_semi"))


def best_candidates(cands: DataFrame) -> DataFrame:
    """The first candidate of the highest count, per key.

    ``min_by`` over ``(-count, pos)`` is an aggregate, so it combines
    map-side; no window sort over the whole lookup.
    """
    order = F.struct(-F.coalesce(F.col("count"), F.lit(0)), F.col("pos"))
    best = F.min_by(F.struct("signature", "count", "abi"), order)
    return (cands.groupBy("key").agg(best.alias("b"))
                 .select("key", F.col("b.signature").alias("signature"),
                         F.col("b.count").alias("count"), F.col("b.abi").alias("abi")))


def label(data: DataFrame, key_col: str, cands: DataFrame, prefix: str = "",
          limit: int | None = None) -> DataFrame:
    """Add ``signature`` (and ``abi``) of the best candidate for
    ``data[key_col]``.  Unresolved, empty and ``0x`` keys stay, with null.
    ``limit`` is the broadcast limit in bytes, the session's by default."""
    best = best_candidates(cands).select(
        F.col("key").alias("_lk"), F.col("signature").alias(f"{prefix}signature"),
        F.col("abi").alias(f"{prefix}abi"))
    return left_join_keyed(data, _key(key_col), best, NO_SELECTOR, limit)


def label_txs(txs: DataFrame, selectors: DataFrame, limit: int | None = None) -> DataFrame:
    """``txs.input_prefix`` to a function signature."""
    return label(txs, "input_prefix", selectors, limit=limit)


def label_events(events: DataFrame, topics: DataFrame, limit: int | None = None) -> DataFrame:
    """E5: ``events.topic0`` to an event signature."""
    return label(events, "topic0", topics, limit=limit)


def all_candidates(data: DataFrame, key_col: str, cands: DataFrame, limit: int | None = None) -> DataFrame:
    """Every candidate per row as ``candidates``
    (``array<struct<signature, count, abi>>``), in E2's rank order.

    The array is built per key from the lookup's own list (bounded by what
    the published JSON held for that key), then left-joined like E4.
    """
    per_key = (cands.groupBy("key")
                    .agg(F.array_sort(F.collect_list(F.struct(
                        (-F.coalesce(F.col("count"), F.lit(0))).alias("neg_count"),
                        F.col("pos").alias("pos"),
                        F.col("signature").alias("signature"),
                        F.col("count").alias("count"),
                        F.col("abi").alias("abi")))).alias("ranked"))
                    .select(F.col("key").alias("_lk"),
                            F.transform("ranked", lambda x: F.struct(
                                x["signature"].alias("signature"), x["count"].alias("count"),
                                x["abi"].alias("abi"))).alias("candidates")))
    return left_join_keyed(data, _key(key_col), per_key, NO_SELECTOR, limit)


def unresolved(data: DataFrame, key_col: str, cands: DataFrame) -> DataFrame:
    """Keys with no candidate and how many rows carry them.

    Not an error; null, empty and ``0x`` keys are excluded.  Counting per key
    happens before the anti join, so a hot key costs one row in the shuffle; a Bloom
    filter of these keys cuts the lookup before its keys are shuffled.
    """
    k = _key(key_col)
    per_key = (data.filter(F.col(key_col).isNotNull() & ~F.col(key_col).isin(*NO_SELECTOR))
                   .groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("rows")))
    per_key, n, _ = measure(per_key)
    known = bloom.cut(cands.select("key"), "key", per_key.select("key"), n, DEFAULT_LIMIT).distinct()
    return per_key.join(known, "key", "left_anti")
