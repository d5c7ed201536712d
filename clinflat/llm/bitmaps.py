"""Filters of a bounded size as tables of bitmaps, made and asked by Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.common import checkpointed

#: Bits that one bitmap of Spark's bitmap aggregate holds.
BITMAP_BITS = 32_768
#: Bits of a filter at most: 32 MB.
MAX_BITS = 1 << 28


def slot(key: str, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))


def filter_bits(rows: int, bits_per_row: int = 16, max_bits: int = MAX_BITS) -> int:
    """Size of a filter: a power of two for the rows, max_bits at most."""
    bits = BITMAP_BITS
    while bits < rows * bits_per_row and bits * 2 <= max_bits:
        bits *= 2
    return bits


def bitmaps(slots: DataFrame) -> DataFrame:
    """Bitmaps (bucket, bitmap) of rows (slot): a row of 4 KB for each 32768 slots at most."""
    bucket = (F.col("slot") / BITMAP_BITS).cast("long").alias("bucket")
    return slots.groupBy(bucket).agg(F.bitmap_construct_agg(F.col("slot") % BITMAP_BITS).alias("bitmap"))


def asked(rows: DataFrame, maps: DataFrame, key: str, seed: int, bits: int, name: str) -> DataFrame:
    """rows with a column name: whether the slot of key is set. The bitmaps are broadcast, bits / 8 bytes."""
    own = slot(key, seed, bits)
    place = own % BITMAP_BITS
    joined = rows.join(
        F.broadcast(maps.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))),
        (own / BITMAP_BITS).cast("long") == F.col("_bucket"),
        "left",
    )
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8 + 1).cast("int"))
    is_set = F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))
    return joined.select(*rows.columns, is_set.alias(name))


def possible_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among keys: all that are, and few others. No row shuffles for it."""
    bits = filter_bits(keys.count())
    maps = checkpointed(bitmaps(keys.select(slot(key, 3, bits).alias("slot"))))
    return asked(rows, maps, key, 3, bits, "_maybe").where("_maybe").drop("_maybe")
