"""Merging the lake's months that were written several times, and no others.

A month that one ingest wrote is as it should be: its files are left alone.  Which months need work follows
from folders and row counts, without reading a column.  Merged files are written aside, moved into the
folder of the month's last ingest, and only then the files they replace are deleted, those of the last
ingest first.  Whoever reads meanwhile finds every record, some of them twice but equal, which the
newest-version rule takes as one; a compaction that broke off is completed by the next.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake.operators.lake import latest
from gazette_lake.session import CODEC
from gazette_lake.sources.landed import read_lake

MONTH = ["pub_year", "pub_month"]


def months_to_merge(lake: DataFrame) -> DataFrame:
    """(pub_year, pub_month, n_ingests, n_rows, last) of months that several ingests wrote.  Only folder names are read."""
    written = lake.groupBy(*MONTH, "ingest_seq").agg(F.count(F.lit(1)).alias("n_rows"))
    return written.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("n_ingests"), F.sum("n_rows").alias("n_rows"), F.max("ingest_seq").alias("last")).filter("n_ingests > 1")


def compact_months(spark: SparkSession, path: str) -> int:
    """Merge, in place, the months of the lake at ``path`` that need it; returns how many.

    Each keeps the newest version of every key, under the month's last ingest.  The driver sees one row per
    month and the names of the files that go.
    """
    lake = read_lake(spark, path)
    months = [tuple(row) for row in months_to_merge(lake).select(*MONTH, "last").collect()]
    if not months:
        return 0
    plan = spark.createDataFrame(months, "pub_year int, pub_month int, _last bigint")
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    place = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
    folder = lambda year, month: [f"pub_year={_name(year)}", f"pub_month={_name(month)}"]
    ingests = [s.getPath().getName() for s in files.listStatus(place()) if s.getPath().getName().startswith("ingest_seq=")]
    old: dict[tuple, list] = {}
    for year, month, last in months:
        found = [(name, place(name, *folder(year, month))) for name in sorted(ingests, key=lambda name: name != f"ingest_seq={last}")]
        old[year, month] = [s.getPath() for _, at in found if files.exists(at) for s in files.listStatus(at)]

    # Whole months by folder name; null years or months (there are none in a lake of complete keys) compare as such.
    same = lake["pub_year"].eqNullSafe(plan["pub_year"]) & lake["pub_month"].eqNullSafe(plan["pub_month"])
    touched = lake.join(F.broadcast(plan), same, "left_semi")  # one row per month
    aside = f"_compaction-{uuid.uuid4().hex}"
    even = latest(touched).drop("ingest_seq").hint("rebalance", *MONTH).sortWithinPartitions(*MONTH, "vat")
    even.write.partitionBy(*MONTH).parquet(f"{path}/{aside}", compression=CODEC)
    for year, month, last in months:
        into, made = place(f"ingest_seq={last}", *folder(year, month)), place(aside, *folder(year, month))
        files.mkdirs(into)
        for status in files.listStatus(made):
            name = status.getPath().getName()
            if not files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(into, name)):
                raise OSError(f"cannot move {name} into {into}")
        for stale in old[year, month]:
            files.delete(stale, False)
    files.delete(place(aside), True)
    return len(months)


def _name(value: int | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
