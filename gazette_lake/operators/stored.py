"""What the lake already holds."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette_lake.functions.urls import local_path, store_path
from gazette_lake.operators.lookups import lookup
from gazette_lake.session import stage

KEYS = ["vat", "publication_number"]


def not_stored(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose (vat, publication_number) is not in the index."""
    return rows.join(index.select(*KEYS), KEYS, "left_anti")


def with_stored(rows: DataFrame, index: DataFrame, spread_by: list[str]) -> DataFrame:
    """All rows, with a flag ``stored``."""
    known = index.select(*KEYS).distinct().withColumn("stored", F.lit(True))
    return lookup(rows, known, KEYS, spread_by).withColumn("stored", F.coalesce("stored", F.lit(False)))


def stored_prefixes(rows: DataFrame, index: DataFrame) -> DataFrame:
    """(vat, publication_number) of ``rows`` whose company number begins one stored with the same publication number.

    All numbers that begin with p lie side by side in sorted order, from p itself on.  So p begins a stored
    one exactly if it begins the next stored one at or behind it.  Keys asked for and keys stored are put
    in one order and dealt out by ranges of it; each range is walked once.  Where the next one lies in a
    later range, it is that range's first.  No index row is copied, no pairs are made, and a publication
    number that very many share is spread over ranges too.

    ``rows`` should be a written table.  Empty and missing numbers match nothing.
    """
    spark, number = rows.sparkSession, "publication_number"
    asked = rows.select(*KEYS).filter(f"length(vat) > 0 and {number} is not null").distinct()
    kept = index.select(*KEYS).filter("length(vat) > 0").join(asked.select(number).distinct(), number, "left_semi").select(*KEYS).distinct()
    both = stage(asked.withColumn("_kept", F.lit(False)).unionAll(kept.withColumn("_kept", F.lit(True))), "keys")  # ranges are sampled first
    ranges = stage(both.repartitionByRange(number, "vat").withColumn("_part", F.spark_partition_id()), "ranges")
    place = F.struct(F.col(number).alias("number"), F.col("vat").alias("vat"))
    # One row per range.
    firsts = sorted((r["_part"], r["first"]) for r in ranges.filter("_kept").groupBy("_part").agg(F.min(place).alias("first")).collect())
    parts = range(ranges.agg(F.coalesce(F.max("_part"), F.lit(-1))).first()[0] + 1)
    following = [next((tuple(first) for at, first in firsts if at > part), (None, None)) for part in parts]
    later = spark.createDataFrame(
        [(part, *first) for part, first in zip(parts, following)], "_part int, _number string, _vat string")
    walk = Window.partitionBy("_part").orderBy(F.desc(number), F.desc("vat"), F.desc("_kept")).rowsBetween(Window.unboundedPreceding, 0)
    walked = ranges.withColumn("_next", F.last(F.when(F.col("_kept"), place), ignorenulls=True).over(walk))
    found = walked.filter("not _kept").join(later, "_part", "left")
    next_number, next_vat = F.coalesce("_next.number", "_number"), F.coalesce("_next.vat", "_vat")
    return found.filter((next_number == F.col(number)) & F.startswith(next_vat, F.col("vat"))).select(*KEYS)


def not_stored_prefix(rows: DataFrame, index: DataFrame) -> DataFrame:
    """As ``not_stored``, but a row's company number also matches longer ones that start with it."""
    return rows.join(stored_prefixes(rows, index), KEYS, "left_anti").select(*rows.columns)


def new_companies(before: DataFrame, after: DataFrame) -> DataFrame:
    """Companies of ``after`` that ``before`` does not have, each once."""
    return after.select("vat").distinct().join(before.select("vat"), "vat", "left_anti")


def not_downloaded(rows: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """Rows whose pdf is not among the files below ``root`` yet.

    ``manifest`` lists files as Spark names them, with a scheme in front.
    """
    wanted = rows.withColumn("_path", local_path(root, store_path(F.col("publication_link"))))
    present = manifest.select(F.regexp_replace("path", "^[a-z][a-z0-9+.-]*:(?://[^/]*)?(?=/)", "").alias("_path"))
    return wanted.join(present, "_path", "left_anti").drop("_path")
