"""Session settings and the shared work folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Join skew is left to adaptive execution, also where splitting costs one more shuffle.
# Small sides are broadcast by measured size (spark.sql.autoBroadcastJoinThreshold).  Code forces it only
# where a size is bounded by construction or was counted: bitmaps of keys (8 MB), versions of few keys,
# one row per month, the training-data operators' models and samples.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.maxMetadataStringLength": "1000",  # plans show paths whole, by which scans are told apart
}

CODEC = "zstd"  # of all tables the engine writes: texts take two thirds of what they take by Spark's default


def build_session(app: str = "gazette-lake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for written intermediates.

    Only a local session, as in tests, gets a folder of its own when none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="gazette-lake-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_open_jobs: list[list[str]] = []


@contextmanager
def cleared_stages(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the folders that ``stage`` made meanwhile, and no others."""
    made: list[str] = []
    _open_jobs.append(made)
    try:
        yield
    finally:
        _open_jobs[:] = [job for job in _open_jobs if job is not made]  # equal lists are not the same job
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str, usual: str) -> Iterator[None]:
    before = spark.conf.get(name, usual)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cleared_shuffles(spark: SparkSession):
    """Actions inside remove their shuffle files when they end.  For writes: behind them, the written table is read.

    Otherwise these files stay until the driver happens to collect garbage, those of all steps of a job side by side.
    """
    return _setting(spark, _CLEANUP, "true", "false")


def as_it_comes(spark: SparkSession):
    """Writes inside sort rows by folder only where the plan that ran does not have them in that order; otherwise Spark
    judges by the plan's outline, which knows no order behind a join."""
    return _setting(spark, "spark.sql.optimizer.plannedWrite.enabled", "false", "true")


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write rows that several later steps need, and read them back.

    A written table is computed once, survives a lost executor, prunes columns and has
    a real size, by which joins are planned.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    for made in _open_jobs:
        made.append(folder)
    with cleared_shuffles(spark):
        rows.write.parquet(folder, compression=CODEC)
    return spark.read.schema(rows.schema).parquet(folder)
