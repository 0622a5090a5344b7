"""Bloom filters as tables of bitmaps, built and probed with built-in functions only.

A filter of ``bits`` slots is a table of blocks of 32,768 slots each: ``block``, ``bitmap``.
It is built by aggregation, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap of Spark's bitmap functions: a fixed value of theirs.
BLOCK_BITS = 32768
#: Bits of a filter per entry: the more, the fewer false hits.
BITS_PER_ENTRY = 16
#: Largest filter that is broadcast (bytes). A larger one is joined by shuffling.
BROADCAST_BYTES = 64 << 20
#: Rows of 64 slots that are broadcast at most: a few times their 16 bytes in memory.
BROADCAST_WORDS = 1 << 20


def filter_bits(entries: int, bits_per_entry: int = BITS_PER_ENTRY) -> int:
    """Bits of a filter for so many entries: a power of two, one block at least."""
    return max(BLOCK_BITS, 1 << max(0, entries * bits_per_entry - 1).bit_length())


def slot(value: Column, seed: int, bits: int) -> Column:
    """The filter slot of a value, from 1."""
    return F.pmod(F.xxhash64(F.lit(seed), value), F.lit(bits)) + 1


def bitmaps(slots: DataFrame) -> DataFrame:
    """The filter that holds the given slots (column ``slot``)."""
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def probe(rows: DataFrame, value: Column, filters: DataFrame, seed: int, bits: int) -> DataFrame:
    """Rows plus ``hit``: whether the filter holds the slot of the value."""
    if bits // 8 <= BROADCAST_BYTES:
        filters = F.broadcast(filters)
    here = slot(value, seed, bits)
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("bit_position") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.expr("shiftleft(1, cast(bit_position % 8 AS int))")
    return (
        rows.withColumn("block", F.bitmap_bucket_number(here))
        .withColumn("bit_position", F.bitmap_bit_position(here))
        .join(filters, "block", "left")
        .withColumn("hit", F.coalesce(byte.cast("int").bitwiseAND(bit) != 0, F.lit(False)))
        .drop("block", "bit_position", "bitmap")
    )


def words(slots: DataFrame) -> DataFrame:
    """A filter as a table of 64 slots a row: ``word``, ``bits``. Cheaper to test than a bitmap."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    return slots.groupBy(F.floor(F.col("slot") / 64).cast("long").alias("word")).agg(F.bit_or(bit).alias("bits"))


def maybe_among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value in ``column`` may be among those of ``wanted``, without moving a row.

    Keeps every row that is, and few that are not; a semi join of what is left settles it.
    ``wanted`` should be stored: it is counted. A filter of more than ``BROADCAST_WORDS``
    rows is not built; nothing is left out then, and the semi join does all the work.
    """
    bits = filter_bits(wanted.count())
    if bits // 64 > BROADCAST_WORDS:
        return rows
    filters = words(wanted.select(slot(F.col(column), 3, bits).alias("slot")))
    here = slot(F.col(column), 3, bits)
    met = rows.withColumn("filter_slot", here).withColumn("word", F.floor(F.col("filter_slot") / 64).cast("long")).join(F.broadcast(filters), "word")
    bit = F.call_function("shiftright", F.col("bits"), (F.col("filter_slot") % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return met.filter(bit != 0).select(*rows.columns)
