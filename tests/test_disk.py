"""What a job leaves on disk while it goes on: no shuffle files behind a write, no text or page written twice."""

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_ingest import block, land, link, world  # noqa: F401
from test_volume import LINKS, TEXTS, accepted, staged  # noqa: F401

from gazette_lake import schemas
from gazette_lake.catalog.queries import REGISTRY
from gazette_lake.derived import layout as layout_data
from gazette_lake.derived import listing as listing_data
from gazette_lake.plans import listing, publish
from gazette_lake.plans.publish import Extractions, with_extraction
from gazette_lake.session import cleared_stages, shared_folder, stage
from gazette_lake.sources import sinks
from gazette_lake.streaming import ingest


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).select((F.col("id") % 7).alias("k")).repartition(5).groupBy("k").count()
    table = stage(rows, "counts")
    sinks.write_rows(table, f"{tmp_path}/rows", 1)
    sinks.write_rejects(table.withColumn("reject_reason", F.lit("no_pdf")), f"{tmp_path}/rejects", 1)
    end = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_jobs_in_jobs_remove_what_they_staged(spark):
    with cleared_stages(spark):
        with cleared_stages(spark):
            inner = stage(spark.range(3), "inner").inputFiles()[0]
        outer = stage(spark.range(3), "outer").inputFiles()[0]
        assert not os.path.exists(inner.removeprefix("file://")) and os.path.exists(outer.removeprefix("file://"))
    assert not os.path.exists(outer.removeprefix("file://"))


def test_texts_of_several_ingests_are_written_once(spark, staged):  # noqa: F811
    texts = spark.createDataFrame([("a", "a", False), ("a", "A", True), ("b", "b", None), (None, "nobody's", True)], TEXTS)
    both = Extractions(texts, spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "x"), (None, "a")], LINKS))
    rows = accepted(spark, ["1", "2", "3", None])
    want = sorted(map(str, with_extraction(rows, both).collect()))
    once = both.staged()
    written = staged["texts"]
    for _ in range(2):
        assert sorted(map(str, with_extraction(rows, once).collect())) == want and staged["texts"] is written


def test_an_ingest_moves_only_the_texts_it_stores(world, monkeypatch):  # noqa: F811
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000002")])])
    moved = []
    plain = ingest.with_text
    monkeypatch.setattr(ingest, "with_text", lambda rows, shown: moved.append(sorted(r.text for r in shown.collect())) or plain(rows, shown))
    by_document = Extractions(
        spark.createDataFrame([("d", "one", True), ("e", "two", True), ("f", "other", True)], TEXTS),
        spark.createDataFrame([(link("0000001"), "d"), (link("0000002"), "e"), ("elsewhere", "f")], LINKS))
    ingest.ingest_batch(spark.read.schema(schemas.PAGES).parquet(pages), 0, fetched, by_document, out, listing.Rules(default_threshold=date(2010, 1, 1)))
    assert moved == [["one", "two"]] and sorted(r.text for r in spark.read.parquet(f"{out}/lake").collect()) == ["one", "two"]


@pytest.fixture
def tables(spark, tmp_path):
    """Two searches of 130 orders each."""
    day = lambda n: date(1998, 1, 1 + n % 28)
    given = {
        "orders": ([(n, n % 4, day(n)) for n in range(1, 261)], "o_orderkey bigint, o_custkey bigint, o_orderdate date"),
        "customer": ([(n, n % 2 + 1) for n in range(4)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(1, "ONE"), (2, "TWO")], "n_nationkey int, n_name string"),
        "documents": ([(n, f"First of {n}. Second.") for n in range(18)], "doc_id bigint, text string"),
    }
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_pages_of_an_unfinished_search_are_made_once_and_nothing_staged_is_left(spark, tables, monkeypatch):
    made, plain = [], listing_data.result_pages
    monkeypatch.setattr(listing_data, "result_pages", lambda listed: made.append(1) or plain(listed))
    before = set(os.listdir(shared_folder(spark)))
    late = REGISTRY["ingest_unfinished_search"](spark, tables).drop("ingest_seq").collect()
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_folder(spark))) - before}
    assert len(made) == 1 and left <= {"unfinished", "versions"}
    once = REGISTRY["stream_ingest"](spark, tables).drop("ingest_seq").collect()
    assert len(late) > 100 and sorted(map(str, late)) == sorted(map(str, once))


def test_rows_that_cannot_be_stored_are_not_shuffled_for_the_index(spark, monkeypatch):
    rows = [("s", None, None, 1, n, "r", False, "1", str(n) if n % 9 else None, date(2020, 1, 1), f"u{n}") for n in range(300)]
    frame = stage(spark.createDataFrame(rows, "search_id string, search_vat string, start_date date, page int, pos int, rel string, "
                                              "multiple_pdf boolean, vat string, publication_number string, publication_date date, publication_link string"), "rows")
    index = spark.createDataFrame([("1", "7"), ("1", "8"), ("1", "8"), ("2", "10"), (None, "11")], "vat string, publication_number string")
    asked, plain = [], listing.stored.with_stored
    monkeypatch.setattr(listing.stored, "with_stored", lambda some, *rest: asked.append(some.count()) or plain(some, *rest))
    fetched = spark.createDataFrame([(f"u{n}", True, f"/{n}") for n in range(300)], schemas.FETCH_RESULTS)
    got = {r.pos: r.reject_reason for r in listing.decide(frame, index, fetched, listing.Rules(default_threshold=date(2000, 1, 1))).collect()}
    assert got == {n: "already_stored" if n in (7, 8) else None if n % 9 else "missing_key" for n in range(300)}
    assert len(asked) == 1 and asked[0] < 10


def test_rows_of_many_files_are_not_shuffled_to_be_spread(spark, tmp_path):
    docs = [(n, f"First of {n}. Second.\nThird {n}.") for n in range(60)]
    found = []
    for files in (1, spark.sparkContext.defaultParallelism):
        folder = f"{tmp_path}/{files}"
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(files).write.parquet(f"{folder}/documents.parquet")
        laid = layout_data.layouts(spark, folder)
        assert ("Exchange" in laid._jdf.queryExecution().executedPlan().toString()) == (files == 1)
        found.append(sorted(map(str, laid.collect())))
    assert found[0] == found[1] and len(found[0]) == 60


def typed(spark, rows):
    """Typed rows with the place of their text: (search, page, pos, vat, date, number, text_at)."""
    given = spark.createDataFrame(rows, "search_id string, page int, pos int, vat string, publication_date date, publication_number string, text_at bigint")
    names = [name.split()[0] for name in schemas.TYPED.split(", ")]
    others = [F.lit(None).cast("string").alias(name) for name in names if name not in given.columns]
    return stage(given.select("*", *others, F.lit(True).alias("is_digital"), F.lit(None).cast("string").alias("reject_reason")), "rows")


@pytest.mark.parametrize("crowd", [1 << 18, 3])
def test_a_lake_is_written_without_moving_or_sorting_rows_with_texts(spark, tmp_path, monkeypatch, crowd):
    monkeypatch.setattr(publish, "CROWD", crowd)
    monkeypatch.setattr(publish, "SHARE_BYTES", 4000)
    at = lambda n: None if n % 50 == 0 else 7 if n % 3 == 0 else n % 40
    rows = typed(spark, [("s", 1, n, str(n * 7919 % 1000), date(2000 + n % 3, 1 + n % 5, 1), str(n), at(n)) for n in range(600)])
    texts = stage(spark.range(30).select(F.col("id").alias("text_at"), F.repeat(F.col("id").cast("string"), 500).alias("text")), "texts")
    records = publish.publications(publish.with_text(rows, texts), F.lit(1))
    records.collect()
    plan = records._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    above, below = plan.split("ShuffledHashJoin")
    assert "Exchange" not in above and "Sort" not in above and below.count("Sort [year(") == 1
    sinks.write_lake(records, f"{tmp_path}/lake", 1, dealt=True)
    assert spark.conf.get("spark.sql.optimizer.plannedWrite.enabled") == "true"
    written = spark.read.parquet(f"{tmp_path}/lake").withColumn("file", F.input_file_name()).collect()
    got = {int(r.publication_number): (r.text, r.pub_year, r.pub_month) for r in written}
    shown = lambda to: None if to is None or to >= 30 else str(to) * 500
    assert got == {n: (shown(at(n)), 2000 + n % 3, 1 + n % 5) for n in range(600)} and len(written) == 600
    files = {}
    for r in written:
        files.setdefault(r.file, []).append(r.vat)
    assert len(files) > 30 and all(vats == sorted(vats) for vats in files.values())


def test_only_rows_whose_key_comes_again_are_compared(spark):
    day = lambda n: date(2020, 1, 1 + n % 3)
    rows = [("s", 1 + n % 2, n, str(n), day(n), str(n), n) for n in range(60)] + [("t", 1, n, str(n), day(n), str(n), n) for n in range(5)]
    rows += [("t", 1, 4, "4", day(4), "4", 99), ("s", 1, 2, "x", day(0), "x", 98), (None, 1, 7, "7", day(7), "7", 97), (None, 1, 1, "alone", day(0), "1", 96)]
    frame, key = typed(spark, rows), ["vat", "publication_date", "publication_number"]
    last = frame.groupBy(*key).agg(F.max(F.struct(*listing.PLACE)).alias("_last")).select("_last.*")
    want = frame.join(last, listing.PLACE, "left_semi")
    got = listing.last_of_key(frame)
    assert sorted(map(str, got.select(*frame.columns).collect())) == sorted(map(str, want.select(*frame.columns).collect())) and got.count() == 63
    alone = listing.last_of_key(typed(spark, rows[:60]))
    assert alone.count() == 60 and "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["stream_ingest", "ingest_late_text", "ingest_unfinished_search", "publications", "reject_report"])
def test_orders_are_joined_once(spark, tables, monkeypatch, name):
    made, plain = [], listing_data._orders
    monkeypatch.setattr(listing_data, "_orders", lambda *of: made.append(1) or plain(*of))
    assert REGISTRY[name](spark, tables).count() > 1 and len(made) == 1


def test_held_blocks_are_not_parsed(world, monkeypatch):  # noqa: F811
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("done", 1, None, [block("0000001")]), (None, 1, None, [block("0000003")]), ("held", 2, None, [block("0000002")])])
    parsed, plain = [], ingest.rows_from_cut
    monkeypatch.setattr(ingest, "rows_from_cut", lambda cut, rules: parsed.append({r.search_id for r in cut.collect()}) or plain(cut, rules))
    ingest.ingest_batch(spark.read.schema(schemas.PAGES).parquet(pages), 0, fetched, texts, out, listing.Rules(default_threshold=date(2010, 1, 1)))
    assert parsed == [{"done", None}] and [r.search_id for r in ingest.held_searches(spark, out).collect()] == ["held"]


def test_waiting_rows_move_only_their_own_results(spark, monkeypatch):
    waiting = typed(spark, [("s", 1, n, "1", date(2020, 1, 1), str(n), n) for n in range(3)]).drop("text_at", "is_digital", "reject_reason")
    waiting = stage(waiting.withColumn("publication_link", F.concat(F.lit("u"), "pos")).withColumn("rel", F.lit("r")).withColumn("multiple_pdf", F.lit(False)), "waiting")
    fetched = stage(spark.range(1, 3000).select(F.concat(F.lit("u"), "id").alias("url"), (F.col("id") != 2).alias("ok"), F.lit("/p").alias("path")), "fetched")
    moved, plain = [], listing.rejects.with_download
    monkeypatch.setattr(listing.rejects, "with_download", lambda rows, results, by: moved.append(results.count()) or plain(rows, results, by))
    index = spark.createDataFrame([], "vat string, publication_number string")
    got = {r.pos: r.reject_reason for r in listing.decide_again(waiting, index, fetched, listing.Rules(obey_robots=False)).collect()}
    assert got == {0: "not_fetched", 1: None, 2: "download_failed"} and 2 <= moved[0] < 10
