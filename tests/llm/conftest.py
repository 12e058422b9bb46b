"""Fixtures of the training-data tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from tests_llm_rows import CLASH, ODD  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = rows.withColumns({name: F.lit("clash") for name in CLASH})
    return rows.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
