"""One row per array element."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(rows: DataFrame, keep: list[str | Column], array: str | Column, item: str = "item",
           index: str = "_index") -> DataFrame:
    """Columns ``keep``, ``index`` (from 0) and ``item``; rows with an empty or null array vanish.

    Spark guards a plain explode by a filter on the array's size and pushes that filter
    down with the array's expression in it, so an expensive array would be worked out
    twice.  The outer form has no such guard, and the filter here stays above it.
    """
    out = rows.select(*keep, F.posexplode_outer(array).alias(index, item))
    return out.filter(F.col(index).isNotNull())
