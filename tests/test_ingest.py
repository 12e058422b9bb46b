"""Whole runs: parse, decide, publish, re-run, replace."""

import json
from datetime import date

import pytest

from gazette_lake import schemas
from gazette_lake.operators import lake, prompts
from gazette_lake.plans.listing import Rules
from gazette_lake.sources import landed, sinks
from gazette_lake.streaming.ingest import ingest_stream

RULES = Rules(default_threshold=date(2010, 1, 1))


def block(number, day="2020-01-02", vat="0471.938.850", links=1):
    pdfs = "".join(f'<a href="/tsv_pdf/{day}/{number}{i or ""}.pdf">p</a>' for i in range(links))
    return (f'<div class="list-item"><div><p> <font>CO {number}</font> BV<br></p><a href="/x.html">'
            f"STREET 1 1000 CITY<br>{vat}<br>ACT<br>{day} / {number}</a>{pdfs}</div></div>")


def land(spark, path, pages):
    rows = [(s, p, vat, None, "u", f"<html><body><main>{''.join(blocks)}</main>") for s, p, vat, blocks in pages]
    spark.createDataFrame(rows, schemas.PAGES).coalesce(1).write.mode("append").parquet(path)


def link(number, day="2020-01-02"):
    return f"https://www.ejustice.just.fgov.be/tsv_pdf/{day}/{number}.pdf"


@pytest.fixture
def world(spark, tmp_path):
    numbers = [f"{n:07d}" for n in range(1, 40)]
    fetched = spark.createDataFrame([(link(n), n != "0000005", f"/{n}.pdf") for n in numbers], schemas.FETCH_RESULTS)
    texts = spark.createDataFrame([(link(n), f"text {n}", n != "0000006") for n in numbers],
                                  "publication_link string, text string, is_digital boolean")
    return spark, str(tmp_path / "pages"), fetched, texts, str(tmp_path / "out")


def run(world, rules=RULES):
    spark, pages, fetched, texts, out = world
    stream = ingest_stream(spark, pages, fetched, texts, out, rules)
    stream.awaitTermination()
    assert stream.exception() is None


def keys(world):
    spark, out = world[0], world[4]
    return {r.blob_key: r for r in lake.latest(landed.read_lake(spark, f"{out}/lake")).collect()}


def rejected(world):
    spark, out = world[0], world[4]
    frame = spark.read.schema(schemas.REJECTS).parquet(f"{out}/rejects")
    return {(r.search_id, r.page, r.pos): r.reject_reason for r in frame.collect()}


def test_runs(world):
    spark, pages, _, _, out = world
    land(spark, pages, [
        ("vat", 1, "471938850", [block("0000001"), block("0000002", links=0), block("0000003", links=2), block("0000005"),
                                 block("0000006")]),
        ("day", 1, None, [block("0000007", vat="0123.456.789"), block("0000008", day="2009-12-31"), block("0000009")]),
    ])
    run(world)
    first = keys(world)
    assert set(first) == {"471938850/2020/01/02/0000001.json", "471938850/2020/01/02/0000006.json",
                          "123456789/2020/01/02/0000007.json"}
    row = first["123456789/2020/01/02/0000007.json"]
    assert (row.vat, row.street, row.zipcode, row.city, row.company_name, row.text, row.is_digital, row.status) == (
        "123456789", "STREET 1", "1000", "CITY", "CO 0000007", "text 0000007", True, "unprocessed")
    assert rejected(world) == {
        ("vat", 1, 2): "no_pdf", ("vat", 1, 3): "multiple_pdf", ("vat", 1, 4): "robots",
        ("day", 1, 2): "below_cutoff", ("day", 1, 3): "below_cutoff"}

    run(world)  # nothing new landed
    assert keys(world) == first

    land(spark, pages, [("again", 1, "471938850", [block("0000001"), block("0000011")])])
    run(world)
    assert set(keys(world)) - set(first) == {"471938850/2020/01/02/0000011.json"}
    assert rejected(world)[("again", 1, 1)] == "already_stored"
    reports = spark.read.parquet(f"{out}/reports").orderBy("ingest_seq").collect()
    assert [(r.new_companies, r.new_publications) for r in reports] == [(2, 3), (2, 3), (0, 0), (0, 1)]  # the run without pages tried the failed pdf again
    assert {r.company for r in reports} == {"471938850", "123456789", None}


def test_repeated_batch_writes_the_same(world):
    from gazette_lake.streaming.ingest import ingest_batch

    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001")])])
    for _ in range(2):
        ingest_batch(landed.read_pages(spark, pages), 0, fetched, texts, out, RULES)
    assert landed.read_lake(spark, f"{out}/lake").count() == 1


def test_text_still_missing(world):
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000006")])])
    run((spark, pages, fetched, texts.filter("is_digital"), out))
    assert set(keys(world)) == {"471938850/2020/01/02/0000001.json"}
    assert rejected(world) == {}
    run((spark, pages, fetched, texts.filter("is_digital"), out))
    assert len(keys(world)) == 1
    run(world)
    assert set(keys(world)) == {"471938850/2020/01/02/0000001.json", "471938850/2020/01/02/0000006.json"}
    assert rejected(world) == {}


def test_downloads_still_missing(world):
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000005"), block("0000007")])])
    run((spark, pages, fetched.filter("path <> '/0000007.pdf'"), texts, out))
    assert set(keys(world)) == {"471938850/2020/01/02/0000001.json"}
    assert rejected(world) == {("vat", 1, 2): "robots"}
    later = fetched.unionAll(spark.createDataFrame([(link("0000005"), True, "/0000005.pdf")], schemas.FETCH_RESULTS))
    land(spark, pages, [("other", 1, "471938850", [block("0000008")])])
    run((spark, pages, later, texts, out))
    assert {k[-12:-5] for k in keys(world)} == {"0000001", "0000005", "0000007", "0000008"}
    assert rejected(world) == {("vat", 1, 2): "robots"}


def test_a_search_is_decided_as_a_whole(world):
    spark, pages, _, _, _ = world
    full = [block(f"{n:07d}") for n in range(1, 4)] + [block("0000009", day="2009-12-31")] + [block("0000010", links=0)] * 96
    land(spark, pages, [("vat", 1, "471938850", full)])
    run(world)
    assert not keys(world)
    land(spark, pages, [("vat", 2, "471938850", [block("0000012")])])
    run(world)
    assert {k[-12:-5] for k in keys(world)} == {"0000001", "0000002", "0000003"}
    assert rejected(world)[("vat", 2, 1)] == "below_cutoff"


def test_page_texts_that_are_no_numbers(world):
    land(world[0], world[1], [("day", 1, None, [block("0000001", vat="BE0471.938.850")])])
    run(world)
    assert set(keys(world)) == {"BE0471938850/2020/01/02/0000001.json"}


def test_doubled_inputs_store_once(world):
    spark, pages, fetched, texts, out = world
    land(spark, pages, [("a", 1, "471938850", [block("0000001")]), ("b", 1, "471938850", [block("0000001")])])
    doubled = texts.unionAll(texts)
    run((spark, pages, fetched.unionAll(fetched), doubled, out))
    assert landed.read_lake(spark, f"{out}/lake").count() == 1
    assert spark.read.parquet(f"{out}/reports").first().new_publications == 1


def test_scans_without_ocr(world):
    land(world[0], world[1], [("vat", 1, "471938850", [block("0000001"), block("0000006")])])
    run(world, Rules(ocr=False))
    assert set(keys(world)) == {"471938850/2020/01/02/0000001.json"}
    assert rejected(world) == {("vat", 1, 2): "scan_without_ocr"}


def test_compaction_and_status(world, tmp_path):
    spark, out = world[0], world[4]
    land(spark, world[1], [("vat", 1, "471938850", [block("0000001"), block("0000002")])])
    run(world)
    stored = landed.read_lake(spark, f"{out}/lake")
    done = sinks.mark_status(stored.filter("publication_number = '0000001'"), "summarized", 1)
    sinks.write_lake(done, f"{out}/lake", 1)
    sinks.compact_lake(landed.read_lake(spark, f"{out}/lake"), str(tmp_path / "compact"))
    compact = landed.read_lake(spark, str(tmp_path / "compact"))
    assert {(r.publication_number, r.status) for r in compact.collect()} == {("0000001", "summarized"), ("0000002", "unprocessed")}
    assert [r.publication_number for r in lake.select_by_tag(compact).collect()] == ["0000002"]
    assert lake.with_tags(compact.limit(1)).first().tags.keys() == {"vat", "publication_date", "status"}


def test_export_and_read_back(world, tmp_path):
    spark, out = world[0], world[4]
    land(spark, world[1], [("vat", 1, "471938850", [block("0000001")])])
    run(world)
    sinks.export_json(landed.read_lake(spark, f"{out}/lake"), str(tmp_path / "json"))
    row = landed.read_publications(spark, str(tmp_path / "json"), per_line=True).first()
    assert row.zipcode == "1000" and row.publication_number == "0000001" and row.is_digital is True
    whole = tmp_path / "one.json"
    whole.write_text(json.dumps(row.asDict(), indent=2))
    assert landed.read_publications(spark, str(whole)).first() == row


def test_prompts(spark):
    record = {name: f"<{name}>" for name in schemas.PUBLICATION_FIELDS}
    frame = spark.createDataFrame([("key", *record.values(), "te\"xt", True)], f"blob_key string, {schemas.PUBLICATION}")
    table = prompts.prompt_table(frame)
    messages = table.first().messages
    assert [m.role for m in messages] == ["system", "user"]
    head = "Summarize me the following publication: "
    assert messages[1].content.startswith(head)
    assert json.loads(messages[1].content[len(head):]) == {**record, "text": "te\"xt", "is_digital": True}
    answered = prompts.complete_with(table, lambda m: m[0]["role"] + str(len(m)), tasks=2)
    assert [r.summary for r in prompts.summaries(frame, answered).collect()] == ["system2"]


def test_pages_and_pdfs_as_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.html").write_text("<html>\n1</html>")
    (tmp_path / "a" / "2.pdf").write_bytes(b"%PDF")
    page = landed.read_page_files(spark, str(tmp_path / "a" / "*.html")).first()
    assert page.html == "<html>\n1</html>" and page.path.endswith("1.html")
    manifest = landed.list_pdf_files(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.n_bytes) for r in manifest] == [("2.pdf", 4)]


def test_ingest_job(world, tmp_path, monkeypatch):
    from gazette_lake.__main__ import main

    spark, pages, fetched, _, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000006")])])
    line = ("scan", [(20.0, 50.0), (30.0, 50.0), (30.0, 52.0), (20.0, 52.0)])
    page = (100.0, 100.0, [line], [])
    documents = spark.createDataFrame(
        [(link("0000001"), "d1", [page], [(100.0, 100.0)], ["digital"]), (link("0000006"), "d6", [page], [(100.0, 100.0)], [""])],
        schemas.DOCUMENTS)
    fetched.write.parquet(str(tmp_path / "fetched"))
    documents.write.parquet(str(tmp_path / "documents"))
    monkeypatch.setattr("sys.argv", ["gazette_lake", "ingest", pages, str(tmp_path / "fetched"), str(tmp_path / "documents"), out])
    main()
    assert {(r.pubid, r.text, r.is_digital) for r in keys(world).values()} == {
        ("0000001", "digital", True), ("0000006", "scan", False)}


def test_other_jobs(world, tmp_path, monkeypatch):
    from gazette_lake.__main__ import main

    def job(*arguments):
        monkeypatch.setattr("sys.argv", ["gazette_lake", *arguments])
        main()

    spark, pages, fetched, texts, out = world
    land(spark, pages, [("vat", 1, "471938850", [block("0000001"), block("0000007")]), ("full", 1, "1", [block("0000002")] * 100)])
    run((spark, pages, fetched.filter("path <> '/0000007.pdf'"), texts, out))
    job("next", pages, str(tmp_path / "next"))
    assert [(r.search_id, r.page) for r in spark.read.parquet(str(tmp_path / "next")).collect()] == [("full", 2)]
    spark.createDataFrame([], schemas.PDF_MANIFEST).write.parquet(str(tmp_path / "manifest"))
    job("pdfs", out, str(tmp_path / "manifest"), "/data", str(tmp_path / "pdfs"))
    assert [r.publication_link for r in spark.read.parquet(str(tmp_path / "pdfs")).collect()] == [link("0000007")]
    job("compact", f"{out}/lake", str(tmp_path / "compact"))
    assert landed.read_lake(spark, str(tmp_path / "compact")).count() == 1


def test_an_ingest_leaves_no_staged_folders(world):
    import os

    spark, shared = world[0], world[0].conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    land(spark, world[1], [("vat", 1, "471938850", [block("0000001")])])
    run(world)
    assert set(os.listdir(shared)) == before and keys(world)
