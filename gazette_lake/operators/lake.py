"""The publication lake: keys, latest records, index, selection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.fixed import UNPROCESSED
from gazette_lake.functions import fields
from gazette_lake.functions.urls import path_stem
from gazette_lake.operators.bitfilter import with_maybe
from gazette_lake.schemas import PUBLICATION_FIELDS
from gazette_lake.session import stage


def lake_rows(rows: DataFrame, ingest_seq: Column) -> DataFrame:
    """Records as the lake keeps them.  The date is text in the record; year and month are real columns."""
    published = F.col("publication_date")
    return rows.select(
        fields.lake_key(F.col("vat"), published, F.col("publication_number")).alias("blob_key"),
        *[F.col(name).cast("string").alias(name) for name in PUBLICATION_FIELDS],
        "text", "is_digital",
        F.lit(UNPROCESSED).alias("status"),
        ingest_seq.cast("bigint").alias("ingest_seq"),
        F.year(published).alias("pub_year"), F.month(published).alias("pub_month"),
    )


FEW_KEYS = 1 << 17  # keys sent to all tasks at most: some 10 MB


def versions(lake: DataFrame) -> DataFrame:
    """(blob_key, _last, _tied) of keys that were written more than once; ``_tied``: several times by the last ingest.

    Two columns are read, and numbers are aggregated by hash; no text is touched.
    """
    writes = lake.groupBy("blob_key", "ingest_seq").agg(F.count(F.lit(1)).alias("_n"))
    packed = F.col("ingest_seq") * 2 + (F.col("_n") > 1).cast("bigint")
    keys = writes.groupBy("blob_key").agg(F.max(packed).alias("_packed"), F.sum("_n").alias("_n")).filter("_n > 1")
    return keys.select("blob_key", F.shiftright("_packed", 1).alias("_last"), (F.col("_packed").bitwiseAND(F.lit(1).cast("bigint")) == 1).alias("_tied"))


def latest(lake: DataFrame) -> DataFrame:
    """One row per key: the last one written.  ``lake`` should be a written table; it is read more than once.

    Most keys are written once, and their rows are passed on as they are.  Only for the others, found on narrow
    columns, rows are compared with the key's last ingest: few such keys are sent to every task, many are
    joined after a bitmap of them has picked the rows that may be concerned.  Texts of keys written once are
    never shuffled.  Rows that one ingest wrote under one key are told apart by content, so the answer
    does not depend on their order; equal ones are one.
    """
    several = stage(versions(lake), "versions")
    some = several.count()
    if not some:
        return lake
    several_by = several.withColumnRenamed("blob_key", "_key")
    same = F.col("blob_key").eqNullSafe(F.col("_key"))
    current = F.col("_last").isNull() | (F.col("ingest_seq") == F.col("_last"))
    if some <= FEW_KEYS:
        joined = lake.join(F.broadcast(several_by), same, "left")  # FEW_KEYS rows at most
    else:
        flagged = with_maybe(lake, several, ["blob_key"], "_maybe")
        passed = flagged.filter("not _maybe").drop("_maybe")
        joined = flagged.filter("_maybe").drop("_maybe").join(several_by, same, "left")
    kept = joined.filter(current)
    single = kept.filter(~F.coalesce("_tied", F.lit(False))).select(*lake.columns)
    found = single if some <= FEW_KEYS else passed.select(*lake.columns).unionAll(single)
    if several.filter("_tied").isEmpty():
        return found
    return found.unionAll(_one_by_content(kept.filter("_tied").select(*lake.columns)))


def _one_by_content(rows: DataFrame) -> DataFrame:
    """One row per key, the same whatever the order; combined before the shuffle."""
    others = [c for c in rows.columns if c != "blob_key"]
    best = rows.groupBy("blob_key").agg(F.max_by(F.struct(*others), F.xxhash64(*others)).alias("_row"))
    return best.select("blob_key", "_row.*").select(*rows.columns)


def index_from_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """(blob_key, vat, publication_number) out of bare paths: the path, its first part and its stem."""
    parts = F.split(F.col(path), "/", -1)
    return paths.select(
        F.col(path).alias("blob_key"),
        F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("vat"),
        path_stem(F.col(path)).alias("publication_number"))


def lake_counts(index: DataFrame) -> DataFrame:
    """Number of companies and of publications.  A publication is a key, however often it was written.

    A key has one company, so both are counted from the distinct keys: by company, then in all.
    """
    companies = index.select("vat", "blob_key").distinct().groupBy("vat").agg(F.count("blob_key").alias("_n"))
    return companies.agg(F.count("vat").alias("companies"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("publications"))


def select_by_tag(lake: DataFrame, status: str = UNPROCESSED) -> DataFrame:
    """Records whose newest version has the status."""
    return latest(lake).filter(F.col("status") == status)


def with_tags(lake: DataFrame) -> DataFrame:
    return lake.withColumn("tags", F.create_map(
        F.lit("vat"), F.col("vat"), F.lit("publication_date"), F.col("publication_date"),
        F.lit("status"), F.col("status")))
