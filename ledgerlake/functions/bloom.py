"""A mergeable Bloom filter over string keys, in built-in functions.

The filter is a table ``(block, bits)`` of bitmaps of 32,768 bits.  A key belongs to one
block and sets a few bits there, so tasks build partial bitmaps that merge in the
exchange, and a test reads one row.  It cuts a large table to the keys another one uses
before anything is shuffled: keys that are there always pass, of the others about
one in a hundred does, and the join that follows removes those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of one of Spark's bitmaps, and their bytes.
BLOCK_BITS, BLOCK_BYTES = 32768, 4096
HASHES = 6
BITS_A_KEY = 10


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_A_KEY // BLOCK_BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.hash(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter over ``keys[key]``, with ``blocks`` bitmaps; repeated keys do no harm."""
    k = F.col(key)
    each = keys.where(k.isNotNull()).select(_block(k, blocks).alias("block"), F.explode(F.array(*_bits(k))).alias("bit"))
    return each.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def may_hold(df: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key the filter may hold; the filter is broadcast."""
    k = F.col(key)
    side = F.broadcast(bloom.select(F.col("block").alias("_bloom_block"), F.col("bits").alias("_bloom_bits")))
    joined = df.join(side, _block(k, blocks) == F.col("_bloom_block"))
    for bit in _bits(k):
        byte = F.conv(F.hex(F.substring(F.col("_bloom_bits"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("long")
        joined = joined.where(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1)
    return joined.drop("_bloom_block", "_bloom_bits")


def cut(df: DataFrame, key: str, used: DataFrame, n: int, limit: int) -> DataFrame:
    """``df`` without most rows whose key is not among the ``n`` keys of ``used`` (same
    column name); unchanged where the filter itself would exceed ``limit`` bytes."""
    blocks = blocks_for(n)
    return may_hold(df, key, build(used, key, blocks), blocks) if blocks * BLOCK_BYTES <= limit else df
