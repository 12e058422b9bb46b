"""A bitmap of keys, of fixed size, that says which rows of a large table may matter.

A join of a large table with a list of keys shuffles the table whole once the list is too long to be
broadcast.  One bit per hashed key, ``BITS`` in all, is small enough whatever the number of keys.  Rows
whose bit is not set cannot match and pass by; only the others, all that match and a few that do not, need
the join.  The more keys, the more rows need it, up to all; no answer depends on it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB, in maps of 4096 bytes


def _bit(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def key_bits(keys: DataFrame, on: list[str], bits: int = BITS) -> DataFrame:
    """(_map, _bits): maps of 32768 bits, those without any key left out.  At most ``bits`` / 8 bytes."""
    bit = _bit(on, bits)
    return keys.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))


def with_maybe(rows: DataFrame, keys: DataFrame, on: list[str], name: str = "maybe", bits: int = BITS) -> DataFrame:
    """Adds ``name``: false only where no row of ``keys`` has the same values in ``on``.  No row is shuffled."""
    placed = rows.withColumn("_bit", _bit(on, bits)).withColumn("_map", F.bitmap_bucket_number("_bit"))
    found = placed.join(F.broadcast(key_bits(keys, on, bits)), "_map", "left")  # size bound by ``bits``
    at = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return found.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_bit", "_map", "_bits")
