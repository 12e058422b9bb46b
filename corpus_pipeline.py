"""From raw documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept, as a written table.  The first four return
documents with their own columns; the last returns one row per packed piece.
"""

from pyspark.sql import DataFrame, SparkSession

from gazette_lake.llm import decontamination, packing, secrets, similarity, toxicity
from gazette_lake.llm.common import benchmark, documents, labels, tokenizer_file
from gazette_lake.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    return toxicity.without_rejected(docs, toxicity.grades(labels(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    return similarity.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.without_contaminated(docs, benchmark(spark, sf_dir))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.without_secrets(docs, n_chars="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.best_fit(docs, tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Trained models, hashes and tokens have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
