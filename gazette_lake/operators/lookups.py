"""Joins that keep every row and spread what would pile up.

No side is forced to be broadcast.  Spark broadcasts a side whose size is below
its threshold; otherwise both are shuffled, and adaptive execution splits hot keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 256


def _joint_key(keys: list[str]) -> Column:
    """All keys as one string, null when one of them is."""
    parts = [part for key in keys for part in (F.lit("\u0001"), F.col(key).cast("string"))]
    return F.concat(*parts)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Left join to a table with at most one row per key.

    Rows without a complete key match nothing.  Sharing one hash value they would all
    meet in one task, so they get one of many keys that no table row has, made from
    ``spread_by``.

    Adaptive execution splits a hot key only where both sides come straight out of a
    shuffle for the join.  A table that was grouped by its keys would be joined where the
    grouping left it, unsplit; the joint key makes it shuffle again, which costs little
    beside one task with all rows of a hot key.
    """
    nobody = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD)).cast("string"))
    left = rows.withColumn("_mine", F.coalesce(_joint_key(keys), nobody))
    right = table.withColumn("_theirs", _joint_key(keys)).drop(*keys)
    return left.join(right, F.col("_mine") == F.col("_theirs"), "left").drop("_mine", "_theirs")
