"""What is moved and written: texts once, rows once, short lists never."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from test_ingest import block, land, link, world  # noqa: F401

from gazette_lake import schemas
from gazette_lake.operators import cutoff
from gazette_lake.plans import listing, publish, summarize
from gazette_lake.plans.publish import Extractions, with_extraction
from gazette_lake.session import stage
from gazette_lake.streaming import ingest

TEXTS = "doc_id string, text string, is_digital boolean"
LINKS = "publication_link string, doc_id string"


@pytest.fixture
def staged(monkeypatch):
    """Frames that were staged, by name."""
    seen = {}

    def noted(rows, name):
        seen[name] = stage(rows, name)
        return seen[name]

    for module in (publish, listing, ingest, summarize):
        monkeypatch.setattr(module, "stage", noted)
    return seen


def accepted(spark, links):
    rows = [("s", 1, pos, to, None) for pos, to in enumerate(links, 1)]
    return spark.createDataFrame(rows, "search_id string, page int, pos int, publication_link string, reject_reason string")


def test_a_text_that_many_addresses_show_is_written_once(spark, staged):
    links = [(f"u{n}", f"d{n % 3}") for n in range(60)] + [(None, "d0"), ("u1", None)]
    texts = spark.createDataFrame([(f"d{n}", f"text {n}", n != 1) for n in range(4)] + [(None, "nobody's", True)], TEXTS)
    both = Extractions(texts, spark.createDataFrame(links, LINKS))
    rows = accepted(spark, [f"u{n}" for n in range(61)] + [None])
    found = with_extraction(rows, both)
    got = {r.publication_link: (r.text, r.is_digital, r.reject_reason) for r in found.collect()}
    want = {f"u{n}": (f"text {n % 3}", n % 3 != 1, None) for n in range(60)}
    assert got == want | {"u60": (None, None, "not_extracted"), None: (None, None, "not_extracted")} and found.count() == 62
    assert staged["texts"].count() == 4 and "text" not in staged["heads"].columns


def test_shared_and_plain_texts_agree_where_keys_repeat(spark):
    texts = spark.createDataFrame(
        [("a", "a", False), ("a", "A", True), ("a", "A", True), ("b", "b", False), ("b", "B", False), ("c", None, None), ("d", "d", None), ("e", None, False)], TEXTS)
    links = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b"), ("2", "a"), ("3", "b"), ("4", "c"), ("5", "d"), ("6", "e"), ("7", "x")], LINKS)
    rows = accepted(spark, [str(n) for n in range(1, 9)] + ["1"])
    plain = links.join(texts, "doc_id").drop("doc_id")
    both = [sorted(map(str, with_extraction(rows, texts_of).select(*rows.drop("reject_reason").columns, "text", "is_digital", "reject_reason").collect()))
            for texts_of in (Extractions(texts, links), plain)]
    assert both[0] == both[1] and len(both[0]) == 9
    first = {r.pos: r.text for r in with_extraction(rows, plain).collect()}
    assert (first[1], first[2], first[9]) == ("A", "A", "A") and first[3] in ("b", "B")


def test_rows_are_not_shuffled_for_the_stops(spark, staged):
    rows = [(f"s{n % 3}", None, None, 1, n, "r", False, "1", str(n), date(2020, 1, 1) if n % 20 else None, f"u{n}") for n in range(100)]
    rows += [(f"s{n % 3}", None, None, 2, n, "r", False, "1", str(n), date(1990, 1, 1), f"u{n}") for n in range(5)]
    frame = stage(spark.createDataFrame(rows, "search_id string, search_vat string, start_date date, page int, pos int, rel string, "
                                              "multiple_pdf boolean, vat string, publication_number string, publication_date date, publication_link string"), "rows")
    fetched = spark.createDataFrame([(f"u{n}", True, f"/{n}") for n in range(100)], schemas.FETCH_RESULTS)
    index = spark.createDataFrame([("1", "7")], "vat string, publication_number string")
    got = {(r.page, r.pos): r.reject_reason for r in listing.decide(frame, index, fetched, listing.Rules(default_threshold=date(2000, 1, 1))).collect()}
    assert got == {(1, n): "already_stored" if n == 7 else None if n % 20 else "no_date" for n in range(100)} | {(2, n): "below_cutoff" for n in range(5)}
    assert sorted(r.search_id for r in staged["stops"].collect()) == ["s0", "s1", "s2"]
    limit = F.lit(date(2000, 1, 1))
    cut = cutoff.with_cutoff(frame, limit, F.col("publication_date"), stopping=staged["stops"])
    assert "Exchange hashpartitioning" not in cut._jdf.queryExecution().executedPlan().toString()


def test_an_ingest_stages_no_rows_with_texts(world, staged):  # noqa: F811
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000002"), block("0000006")])])
    by_document = Extractions(
        spark.createDataFrame([("d", "both", True)], TEXTS), spark.createDataFrame([(link("0000001"), "d"), (link("0000002"), "d")], LINKS))
    ingest.ingest_batch(spark.read.schema(schemas.PAGES).parquet(pages), 0, fetched, by_document, out, listing.Rules(default_threshold=date(2010, 1, 1)))
    rows = spark.read.parquet(f"{out}/lake").select("publication_number", "text").collect()
    assert {tuple(r) for r in rows} == {("0000001", "both"), ("0000002", "both")}
    assert "text" not in staged["extracted"].columns and [r.pubid for r in ingest.waiting_rows(spark, out).collect()] == ["0000006"]


def test_texts_stay_where_they_are_when_keys_are_left_out(spark):
    rows = stage(spark.createDataFrame([(f"k{n}", f"t{n}") for n in range(500)] + [(None, "null")], "blob_key string, text string"), "rows")
    taken = lambda most: spark.range(most).select(F.concat(F.lit("k"), "id").alias("blob_key")).unionAll(spark.sql("select cast(null as string)"))
    for most in (0, 499, 500):
        left = summarize.without(rows, stage(taken(most), "taken"))
        assert {r.text for r in left.collect()} == {f"t{n}" for n in range(most, 500)} | {"null"}
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(blob_key" in line]


def test_rows_a_bitmap_takes_for_others_are_kept(spark, monkeypatch):
    monkeypatch.setattr(summarize, "with_maybe", lambda rows, keys, on, name: rows.withColumn(name, F.lit(True)))  # every row is suspected
    rows = stage(spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4")], "blob_key string, text string"), "rows")
    assert sorted(r.text for r in summarize.without(rows, spark.createDataFrame([("b",), (None,)], "blob_key string")).collect()) == ["1", "2", "4"]
