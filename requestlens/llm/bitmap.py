"""A bitmap of fixed size over hashes, to leave rows out of a shuffle that an exact join would leave out anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def mark(rows: DataFrame, key: Column, members: DataFrame, member_key: Column) -> DataFrame:
    """Adds ``_marked``: false only where no member's key hashes to the bit of the row's key.

    Keys are of type long. The bits, 2**26 at any input size, are broadcast in pieces of 4 KB: at most 8 MB. With very many
    members most bits are set and few rows are left out; an exact join has to follow in any case.
    """
    def bit(value: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(value, F.lit(0))), F.lit(BITS))

    bits = members.select(bit(member_key).alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits")
    )
    placed = rows.withColumn("_bit", bit(key)).withColumn("_piece", F.bitmap_bucket_number("_bit"))
    is_set = F.expr(
        "shiftright(cast(conv(hex(substring(_bits, cast(bitmap_bit_position(_bit) div 8 as int) + 1, 1)), 16, 10) as int), "
        "cast(bitmap_bit_position(_bit) % 8 as int)) % 2 = 1"
    )
    return placed.join(F.broadcast(bits), "_piece", "left").withColumn("_marked", F.coalesce(is_set, F.lit(False))).drop("_bit", "_piece", "_bits")
