"""Key filters: a blocked Bloom filter of a column's values, built and tested with built-in functions.

A key belongs to one block of 64 Kbit (a row of 1,024 longs) and sets four bits of it.  The blocks are an ordinary
DataFrame, broadcast to the rows to test: their number follows from the measured number of keys, so the size is known before
anything is sent, and beyond the bound there is no filter.  A filter lets every held key and about one in a hundred others
through: an exact semi-join comes after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_LONGS = 1024
BLOCK_BYTES = 8 * BLOCK_LONGS
BITS_PER_KEY = 12
PROBES = 4
#: The blocks of a filter hold at most this many bytes (about 44 million keys).
MAX_FILTER_BYTES = 64 << 20
_ERROR = 0.02  # of the distinct count


@dataclass(frozen=True)
class KeyFilter:
    blocks: DataFrame   # __kf_block, __kf_bits
    n_blocks: int

    def __call__(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be held; rows with a NULL key go."""
        bits = F.lit(True)
        for place in _places(F.col(key)):
            bits = bits & (F.getbit(F.get("__kf_bits", F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))) == 1)
        joined = rows.filter(F.col(key).isNotNull()).withColumn("__kf_of", _block(F.col(key), self.n_blocks)).join(
            F.broadcast(self.blocks), F.col("__kf_of") == F.col("__kf_block"))
        return joined.filter(bits).select(*[F.col(f"`{c}`") for c in rows.columns])


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("bigint"))


def _places(key: Column) -> list[Column]:
    """Four bit numbers within the block, from a hash of their own."""
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 16 * i).bitwiseAND(F.lit(8 * BLOCK_BYTES - 1).cast("bigint")).cast("int") for i in range(PROBES)]


def key_filter(rows: DataFrame, key: str, max_bytes: int = MAX_FILTER_BYTES) -> KeyFilter | None:
    """The filter of the non-NULL values of ``key``; None if it would be larger than ``max_bytes``.

    One pass over the column counts its distinct values (a sketch for each task).  The bits are combined map-side, so repeated
    keys, however many, are one row for each task.
    """
    spark, held = rows.sparkSession, rows.select(F.col(key).alias("key")).filter(F.col(key).isNotNull())
    n = held.agg(F.approx_count_distinct("key", _ERROR)).first()[0]
    n_blocks = max(1, -(-int(n * (1 + 3 * _ERROR)) * BITS_PER_KEY // (8 * BLOCK_BYTES)))
    if n_blocks * BLOCK_BYTES > max_bytes:
        return None
    bits = held.select(_block(F.col("key"), n_blocks).alias("block"), F.explode(F.array(*_places(F.col("key")))).alias("place"))
    longs = bits.select("block", F.shiftright("place", 6).alias("at"),
                        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63))).alias("mask"))
    none = spark.range(n_blocks * BLOCK_LONGS).select(
        F.floor(F.col("id") / F.lit(BLOCK_LONGS)).cast("bigint").alias("block"), F.pmod("id", F.lit(BLOCK_LONGS)).cast("int").alias("at"),
        F.lit(0).cast("bigint").alias("mask"))
    filled = longs.unionByName(none).groupBy("block", "at").agg(F.bit_or("mask").alias("mask"))
    blocks = (filled.groupBy(F.col("block").alias("__kf_block"))
              .agg(F.array_sort(F.collect_list(F.struct("at", "mask"))).alias("row"))
              .select("__kf_block", F.col("row.mask").alias("__kf_bits")))
    return KeyFilter(blocks, n_blocks)
