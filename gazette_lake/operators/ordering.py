"""Positions in an ordered group of any size.

A window over a whole group would put the group into one task.  Here rows are
counted per bucket of the order (partial aggregation, so a hot group shrinks on
the map side), the counts are summed along the order one bucket level at a time,
and rows are numbered inside their own bucket only.  The largest thing one task
holds is one bucket, or the list of buckets below one parent.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    """A column that splits a group along its order, coarse to fine."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        column = F.col(self.name)
        return column.desc() if self.descending else column.asc()


def with_position(rows: DataFrame, group: list[str], buckets: list[Bucket], order: list[Column],
                  name: str = "search_pos") -> DataFrame:
    """Adds ``name``: 1, 2, 3, ... inside each group.

    ``buckets`` must agree with the wanted order: all rows of a bucket come before
    all rows of the next one.  ``order`` ranks rows inside the last bucket.  Group and
    buckets must not be null.
    """
    keys = group + [b.name for b in buckets]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    def before(level: DataFrame, depth: int, out: str) -> DataFrame:
        siblings = Window.partitionBy(*keys[: len(group) + depth - 1]).orderBy(buckets[depth - 1].order())
        earlier = F.sum("_n").over(siblings.rowsBetween(Window.unboundedPreceding, -1))
        return level.withColumn(out, F.coalesce(earlier, F.lit(0)))

    offsets = before(counts, len(buckets), "_before")
    level = counts
    for depth in range(len(buckets) - 1, 0, -1):
        level_keys = keys[: len(group) + depth]
        level = level.groupBy(*level_keys).agg(F.sum("_n").alias("_n"))
        above = before(level, depth, "_above").drop("_n")
        offsets = offsets.join(above, level_keys).withColumn(
            "_before", F.col("_before") + F.col("_above")).drop("_above")

    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = rows.withColumn("_inside", inside)
    return numbered.join(offsets.drop("_n"), keys).withColumn(
        name, F.col("_before") + F.col("_inside")).drop("_before", "_inside")
