"""The pipeline and the registered queries."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_rows import prose

import __spark_entry__ as entry_module
import corpus_pipeline
from gazette_lake.llm.common import tokenizer_file
from gazette_lake.llm.encoders import load
from gazette_lake.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables whose result is known: 0-199 clean or toxic, then copies, a leak, secrets, odd rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    item = " ".join(f"item{i}" for i in range(20))
    rows = [(i, prose(60, i) + (" dreadfulx" if i % 4 == 0 else "")) for i in range(200)]
    rows += [(300, prose(60, 1)), (301, prose(60, 1) + " tail"), (302, f"{prose(20, 777)} {item} {prose(20, 778)}"),
             (303, f"{prose(30, 779)} password=abcdef123 {prose(30, 780)}"), (304, None), (305, ""), (None, prose(60, 781)), (303, prose(60, 782))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def test_pipeline_beside_brute_force(spark, folder):
    path, rows = folder
    kept = [(i, t) for i, t in rows if not (i is not None and i < 200 and i % 4 == 0) and i not in (300, 301, 302)]
    kept = [(i, (t or "").replace("password=abcdef123", "[secret]")) for i, t in kept if not (i == 305)]  # 305 is a text of its own
    kept += [(305, "")]
    want, encoder = Counter(), load(tokenizer_file("word_bpe_49k.json"))
    for i, t in kept:
        ids = np.array(encoder.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want[i, 0, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == want


def test_stages_keep_the_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        nothing = step(spark, docs.limit(0), path)
        assert nothing.dtypes == docs.dtypes and nothing.count() == 0


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in REGISTRY} == set(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"op5_decontamination", "op10_packing", "op12_neighbours", "op13_spelling"}))
def test_one_row_per_document(spark, sf, name):
    assert REGISTRY[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
