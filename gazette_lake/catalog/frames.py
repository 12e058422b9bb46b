"""Inputs shared by the registered queries.  All are derived from the given tables."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake.derived import layout as layout_data
from gazette_lake.derived import listing as listing_data
from gazette_lake.operators import blocks, lake, layout
from gazette_lake.plans.listing import Rules, decide
from gazette_lake.plans.publish import Extractions, publications, with_text, with_text_place
from gazette_lake.session import stage

RULES = Rules(default_threshold=date(1996, 1, 1))
RULES_NO_OCR = Rules(default_threshold=date(1996, 1, 1), ocr=False)


def typed_rows(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """Typed publication rows of the derived listing."""
    return blocks.typed_fields(listing_data.parts(listing_data.listing(spark, sf, orders)))


def stored_index(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """(blob_key, vat, publication_number) of what is stored already."""
    return lake.index_from_paths(listing_data.lake_paths(listing_data.listing_rows(spark, sf, orders)))


def fetched(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    return listing_data.fetch_results(listing_data.listing_rows(spark, sf, orders))


def decided(spark: SparkSession, sf: str, rules: Rules = RULES, orders: DataFrame | None = None) -> DataFrame:
    orders = listing_data.staged_orders(spark, sf) if orders is None else orders
    rows = stage(typed_rows(spark, sf, orders), "typed")
    return decide(rows, stored_index(spark, sf, orders), fetched(spark, sf, orders), rules)


def extractions(spark: SparkSession, sf: str, rules: Rules = RULES, orders: DataFrame | None = None) -> Extractions:
    texts = layout.with_text(layout_data.layouts(spark, sf), ocr=rules.ocr).select("doc_id", "text", "is_digital")
    return Extractions(texts, listing_data.pdf_documents(listing_data.listing_rows(spark, sf, orders)))


def placed(spark: SparkSession, sf: str, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    orders = listing_data.staged_orders(spark, sf)
    rows = stage(decided(spark, sf, rules, orders), "decided")
    return with_text_place(rows, extractions(spark, sf, rules, orders), rules)


def extracted(spark: SparkSession, sf: str, rules: Rules = RULES) -> DataFrame:
    return with_text(*placed(spark, sf, rules))


def published(spark: SparkSession, sf: str) -> DataFrame:
    rows, texts = placed(spark, sf)
    return publications(with_text(rows.filter("reject_reason is null"), texts), F.lit(1))


def plain_records(spark: SparkSession, sf: str) -> DataFrame:
    """Lake rows straight from the listing, without text: what the lake operators need.

    Pages do not matter to them, so nothing is ranked.
    """
    rows = listing_data.listing_rows(spark, sf).withColumns({"page": F.lit(1), "pos": F.lit(1)})
    typed = blocks.typed_fields(listing_data.parts(rows)).filter(
        "vat is not null and publication_date is not null and rel is not null")
    texts = typed.withColumns({"text": F.concat(F.lit("text of "), "pubid"), "is_digital": F.lit(True)})
    return lake.lake_rows(texts, F.lit(1))
