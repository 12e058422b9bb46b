"""Registered queries of this folder: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gazette_lake.llm import (
    binary, counting, decontamination, language, manifest, neighbours, packing, quality, secrets, sharding, similarity, spelling,
    toxicity)
from gazette_lake.llm.common import benchmark, documents, labels, tokenizer_file
from gazette_lake.llm.oracles import ORACLES as SQL

WORDS, BYTES, SUBWORDS = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_duplicates(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), toxicity.grades(labels(spark, sf_dir)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_tokens(documents(spark, sf_dir), tokenizer_file(BYTES))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), 40)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir), tokenizer_file(SUBWORDS))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.encode_to_files(documents(spark, sf_dir), tokenizer_file(WORDS), end_id=2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(documents(spark, sf_dir), tokenizer_file(WORDS), end_id=0, capacity=2048)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return manifest.manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", tampered=manifest.lowered_third(docs))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, k=20)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), least_length=7, least_n=2, times=10, spoilt=True)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_toxicity, op3_token_counts, op4_shards, op5_decontamination, op6_language, op7_secrets,
    op8_token_files, op9_quality, op10_packing, op11_manifest, op12_neighbours, op13_spelling)}

# Tokenizer files and trained models have no counterpart in SQL; tests compare with brute force.
ORACLES: dict[str, str] = dict(SQL)
