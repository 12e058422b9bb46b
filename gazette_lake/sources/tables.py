"""Reading plain tables."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out to a task per core, before heavy work on each, where their files are fewer than the cores.

    For derived test inputs.  Rows of many files are spread as they are read: they, texts and all, need no shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if len(rows.inputFiles()) >= cores else rows.repartition(cores, *keys)
