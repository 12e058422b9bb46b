"""What several operators share: narrowed inputs, broadcast encoders, the shared folder."""

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake.llm.encoders import Encoder, character_tables


def id_and_text(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads; other columns, whatever their names, are left out."""
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is installed; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def send_tables(spark: SparkSession) -> Broadcast:
    """Character tables for all workers: 5.5 MB, whatever the input."""
    return spark.sparkContext.broadcast(character_tables())


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, tables: Broadcast, word_level: bool) -> Encoder:
    """This worker's encoder with its cache, kept between tasks."""
    if (path, word_level) not in _encoders:
        _encoders[path, word_level] = Encoder(path, tables.value, word_level)
    return _encoders[path, word_level]


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")

