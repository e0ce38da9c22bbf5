"""Rows of a large table whose key may occur in a smaller one, told before any shuffle.

A bitmap with ``BITS_PER_KEY`` bits for each of the smaller table's rows has the bit of every key's hash set (one
aggregation with map-side combine; buckets of 32,768 bits). It is broadcast, and the large table keeps the rows whose
bit is set: all that match, and a few that do not, which the join that follows drops. The bitmap has at most
``MOST_BITS`` bits (64 MB); beyond that it lets more rows through, and the result of the join is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 29


def bitmap_bits(keys: int) -> int:
    bits = LEAST_BITS
    while bits < keys * BITS_PER_KEY and bits < MOST_BITS:
        bits *= 2
    return bits


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap) of the keys' hashes."""
    at = _place(F.col(key), bits)
    return (keys.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bitmap")))


def possible_matches(rows: DataFrame, key: str, others: DataFrame, other_key: str, bits: int | None = None) -> DataFrame:
    """``rows`` without those whose ``key`` cannot be an ``other_key`` of ``others``."""
    bits = bits or bitmap_bits(others.count())
    at = _place(F.col(key), bits)
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, CAST(_position % 8 AS INT)) & 1") == 1
    found = rows.join(F.broadcast(key_bitmap(others, other_key, bits)), F.bitmap_bucket_number(at) == F.col("_bucket"))
    return found.withColumns({"_byte": byte, "_position": position}).where(hit).select(*rows.columns)
