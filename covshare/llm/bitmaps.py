"""Bloom filters as tables of bitmaps, built and asked with SQL functions only.

A filter has `hashes` ranges of `slots` bits each. It is held as rows of
(bucket, bits) with 32,768 bits a row, so that it never exceeds
`hashes * slots / 8` bytes however large the input is: 16 MB with the defaults.
That bound is what allows the broadcast in `maybe_in`. A filter that is too
small for its input lets more rows through to the exact step behind it; it
never loses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 26
HASHES = 2
BITS_PER_ROW = 32768


def _slot(key: Column, index: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(index)), F.lit(slots)) + F.lit(index * slots)


def slot_list(key: Column, slots: int = SLOTS, hashes: int = HASHES) -> Column:
    """The key's slot in each of the ranges."""
    return F.array(*[_slot(key, i, slots) for i in range(hashes)])


def _bitmaps(slot_rows: DataFrame) -> DataFrame:
    """Rows of (slot) as rows of (bucket, bits)."""
    return slot_rows.groupBy(
        F.floor(F.col("slot") / BITS_PER_ROW).cast("long").alias("bucket")
    ).agg(F.bitmap_construct_agg((F.col("slot") % BITS_PER_ROW)).alias("bits"))


def repeated(keys: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """The second of two filters: slots that two rows or more fall into.

    A key with two rows has all its slots in it. Counts are combined before the
    shuffle, so a key with a third of all rows is a few rows per task there.
    """
    return _bitmaps(
        keys.select(F.explode(slot_list(F.col(key), slots)).alias("slot"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def members(keys: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """A filter that holds every key of the column."""
    return _bitmaps(keys.select(F.explode(slot_list(F.col(key), slots)).alias("slot")))


def maybe_in(rows: DataFrame, key: Column, bitmaps: DataFrame, flag: str, slots: int = SLOTS) -> DataFrame:
    """`rows` with a boolean column that is true for every key in the filter.

    The filter is broadcast: its size is bounded by its number of slots.
    """
    out = rows.withColumn(flag, F.lit(True))
    for i in range(HASHES):
        bucket, bits, slot = f"{flag}_bucket", f"{flag}_bits", f"{flag}_slot"
        table = bitmaps.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))
        place = (F.col(slot) % BITS_PER_ROW).cast("int")
        byte = F.conv(F.hex(F.expr(f"substring({bits}, cast(floor(({slot} % {BITS_PER_ROW}) / 8) as int) + 1, 1)")), 16, 10).cast("int")
        hit = F.col(bits).isNotNull() & (F.expr(f"{flag}_byte & shiftleft(1, {flag}_place)") != 0)
        out = (
            out.withColumn(slot, _slot(key, i, slots))
            .withColumn(bucket, F.floor(F.col(slot) / BITS_PER_ROW).cast("long"))
            .join(F.broadcast(table), bucket, "left")
            .withColumn(f"{flag}_byte", byte)
            .withColumn(f"{flag}_place", place % 8)
            .withColumn(flag, F.col(flag) & F.coalesce(hit, F.lit(False)))
            .drop(slot, bucket, bits, f"{flag}_byte", f"{flag}_place")
        )
    return out
