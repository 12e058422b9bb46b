"""Cut-off, positions, joins, rejects, lake and reports against brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gazette_lake import schemas
from gazette_lake.operators import blocks, cutoff, frontier, lake, rejects, reports, stored
from gazette_lake.operators.bitfilter import with_maybe
from gazette_lake.operators.ordering import Bucket, with_position
from gazette_lake.session import stage


def listing(rng, searches=6, size=300):
    """(search, page, pos, day) rows; one search holds most of them."""
    rows = []
    for search in range(searches):
        pages = rng.randrange(1, 5) if search else 40
        for page in range(1, pages + 1):
            for pos in range(1, rng.randrange(1, 12)):
                day = None if rng.random() < 0.1 else date(2010, 1, 1) + timedelta(rng.randrange(-3, 400))
                rows.append((str(search), page, pos, day))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cutoff(spark, seed):
    rows = listing(random.Random(seed))
    frame = spark.createDataFrame(rows, "search_id string, page int, pos int, d date")
    cut = cutoff.with_cutoff(frame, F.lit(date(2010, 1, 1)), F.col("d"))
    kept = {(r.search_id, r.page, r.pos) for r in cut.filter("not below_cutoff").collect()}
    left = {r.search_id: r.remaining for r in cutoff.cutoff_remaining(cut).collect()}
    expected, behind = set(), {}
    for search in {r[0] for r in rows}:
        walk = sorted(r for r in rows if r[0] == search)
        for i, row in enumerate(walk):
            if row[3] is not None and row[3] < date(2010, 1, 1):
                behind[search] = len(walk) - (i + 1)
                break
            expected.add(row[:3])
    assert kept == expected and left == behind
    assert cut.count() == len(rows)
    plain = cutoff.with_cutoff(frame, F.lit(date(2010, 1, 1)), F.col("d"), ordered=False)
    assert plain.filter("not below_cutoff").count() == sum(r[3] is None or r[3] >= date(2010, 1, 1) for r in rows)


def test_year_only_date_stops_a_search_by_day(spark):
    frame = spark.createDataFrame(
        [("s", 1, 1, date(2024, 7, 4)), ("s", 1, 2, date(2024, 1, 1)), ("s", 1, 3, date(2024, 7, 4))],
        "search_id string, page int, pos int, d date")
    cut = cutoff.with_cutoff(frame, cutoff.threshold(F.lit(date(2024, 7, 4))), F.col("d"))
    assert [r.pos for r in cut.filter("not below_cutoff").collect()] == [1]


def html_pages(spark, sizes):
    rows = [(search, page, "u", '<div class="list-item"><p>x</p></div>' * n) for (search, page), n in sizes.items()]
    return spark.createDataFrame(rows, "search_id string, page int, url string, html string")


def test_gather(spark):
    rng = random.Random(4)
    sizes = {(search, page): rng.randrange(4) for search in "ab" for page in rng.sample(range(1, 3000), 40)}
    sizes |= {("unpaged", None): 3}
    got = {(r.search_id, r.page, r.pos): r.search_pos for r in blocks.gather(blocks.page_blocks(html_pages(spark, sizes))).collect()}
    for search in ("a", "b", "unpaged"):
        walk = [(search, page or 1, pos) for (s, page), n in sorted(sizes.items(), key=str if search == "unpaged" else lambda x: (x[0][0], x[0][1] or 1))
                if s == search for pos in range(1, n + 1)]
        assert [got.pop(place) for place in walk] == list(range(1, len(walk) + 1))
    assert not got


def test_positions_over_two_bucket_levels(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(20), k) for k in rng.sample(range(10_000), 700)]
    frame = spark.createDataFrame(rows, "g string, day int, k int").withColumn("bucket", F.expr("k div 1000"))
    placed = with_position(frame, ["g"], [Bucket("day", descending=True), Bucket("bucket")], [F.col("k")], "n")
    got = {(r.g, r.day, r.k): r.n for r in placed.collect()}
    for g in "ab":
        walk = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[r] for r in walk] == list(range(1, len(walk) + 1))


def test_no_window_over_a_whole_search(spark):
    frame = spark.createDataFrame([], "search_id string, page int, pos int, d date")
    plan = cutoff.with_cutoff(frame, F.lit(date(2010, 1, 1)), F.col("d"))._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window")
    assert "Aggregate" in plan[window:]  # it runs over segments, which are aggregated below it
    parsed = stage(blocks.page_blocks(html_pages(spark, {("a", 1): 1})).drop("block"), "parsed")
    gathered = blocks.gather(parsed)._jdf.queryExecution()
    windows = [x for x in gathered.optimizedPlan().toString().splitlines() if " Window " in x]
    assert len(windows) == 2 and not any("row_number" in x for x in windows)
    assert "html" not in gathered.executedPlan().toString()


INDEX = [("4711", "1"), ("4711", "1"), ("4712", "2"), ("", "3"), (None, "4")]
ROWS = [(1, "4711", "1"), (2, "4711", "2"), (3, None, "1"), (4, "47", "1"), (5, "47", "2"), (6, "47", "9"),
        (7, "47110", "1"), (8, "4712", None)]


@pytest.fixture(scope="module")
def new_and_index(spark):
    return (spark.createDataFrame(ROWS, "id int, vat string, publication_number string"),
            spark.createDataFrame(INDEX, "vat string, publication_number string"))


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_incremental_join(new_and_index):
    rows, index = new_and_index
    assert ids(stored.not_stored(rows, index)) == [2, 3, 4, 5, 6, 7, 8]
    flagged = stored.with_stored(rows, index, ["id"])
    assert ids(flagged) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert ids(flagged.filter("stored")) == [1]


def test_prefix_join(new_and_index):
    rows, index = new_and_index
    assert ids(stored.not_stored_prefix(rows, index)) == [2, 3, 6, 7, 8]
    assert ids(stored.not_stored_prefix(rows, index.limit(0))) == [1, 2, 3, 4, 5, 6, 7, 8]


@pytest.mark.parametrize("parts", ["1", "7", "64"])
def test_prefixes_of_any_length_over_many_ranges(spark, parts):
    rng = random.Random(int(parts))
    word = lambda most: "".join(rng.choice("12\u00e9\U0001f600") for _ in range(rng.randint(0, most)))
    known = [(word(6), rng.choice("ab")) for _ in range(60)] + [(word(9), "hot") for _ in range(200)]
    rows = [(i, word(4), rng.choice(["a", "b", "hot", "hot", None])) for i in range(500)]
    frame = stage(spark.createDataFrame(rows, "id int, vat string, publication_number string"), "rows")
    index = spark.createDataFrame(known, "vat string, publication_number string")
    settings = {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        got = ids(stored.not_stored_prefix(frame, index))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == [i for i, vat, n in rows if not (vat and any(m == n and v.startswith(vat) for v, m in known))]


def test_rows_without_key_are_spread(spark):
    rows = spark.range(10_000).select(
        F.col("id"), F.lit(None).cast("string").alias("vat"), F.lit("1").alias("publication_number"))
    index = spark.createDataFrame(INDEX, "vat string, publication_number string")
    assert stored.with_stored(rows, index, ["id"]).filter("not stored").count() == 10_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in stored.with_stored(rows, index, ["id"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 6_000


def test_downloads(spark):
    rows = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, None)], "id int, publication_link string")
    results = spark.createDataFrame(
        [("u1", False, None), ("u1", True, "/p1"), ("u2", False, None)], "url string, ok boolean, path string")
    got = {r.id: (r.downloaded, r.file_path) for r in rejects.with_download(rows, results, ["id"]).collect()}
    assert got == {1: (True, "/p1"), 2: (False, None), 3: (None, None), 4: (None, None)}


REASONS = [
    # below, several, rel, stored, downloaded, date, vat, number -> reason
    ((True, True, None, True, False, None, None, None), "below_cutoff"),
    ((False, True, None, True, False, None, None, None), "multiple_pdf"),
    ((False, False, None, True, False, None, None, None), "no_pdf"),
    ((False, False, "r", True, False, None, None, None), "already_stored"),
    ((False, False, "r", False, False, None, None, None), "robots"),
    ((False, False, "r", False, None, None, None, None), "not_fetched"),
    ((False, False, "r", False, True, None, None, None), "no_date"),
    ((False, False, "r", False, True, date(2020, 1, 1), "", "1"), "missing_key"),
    ((False, False, "r", False, True, date(2020, 1, 1), "1", None), "missing_key"),
    ((False, False, "r", False, True, date(2020, 1, 1), "1", "1"), None),
]


def test_first_reason_wins(spark):
    frame = spark.createDataFrame(
        [(i, *r) for i, (r, _) in enumerate(REASONS)],
        "id int, below_cutoff boolean, multiple_pdf boolean, rel string, stored boolean, downloaded boolean, "
        "publication_date date, vat string, publication_number string")
    reason = F.coalesce(rejects.listing_reason(), rejects.download_reason())
    got = [r.x for r in frame.select("id", reason.alias("x")).orderBy("id").collect()]
    assert got == [reason for _, reason in REASONS]
    plain = frame.select("id", rejects.download_reason(obey_robots=False).alias("x")).filter("id = 4").first().x
    assert plain == "download_failed"


def test_text_reason(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,)], "is_digital boolean")
    read = lambda ocr: [r[0] for r in frame.select(rejects.text_reason(ocr)).collect()]
    assert read(True) == [None, None, "not_extracted"]
    assert read(False) == [None, "scan_without_ocr", "not_extracted"]


def lake_of(spark, rows):
    return stage(spark.createDataFrame(rows, "blob_key string, ingest_seq bigint, text string, n string"), "lake")


@pytest.mark.parametrize("few", [1 << 17, 0])
def test_latest_with_a_hot_key(spark, monkeypatch, few):
    monkeypatch.setattr(lake, "FEW_KEYS", few)
    rows, want = [], {}
    for i in range(5_000):
        key = "hot" if i % 3 == 0 else f"k{i % 50}" if i % 2 else f"once{i}"
        rows.append((key, i, f"t{i}", None))
        want[key] = f"t{i}"
    frame = lake_of(spark, rows)
    newest = lake.latest(frame)
    assert {r.blob_key: r.text for r in newest.collect()} == want and newest.count() == len(want)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "SortAggregate" in line and "bitmap_construct_agg" not in line]
    assert not sorts and "Window" not in plan and "max_by" not in plan and ("bitmap_construct_agg" in plan) == (not few)
    lookup = lake.versions(frame)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in lookup and "text" not in lookup


@pytest.mark.parametrize("few", [1 << 17, 0])
def test_latest_of_tied_and_single_writes(spark, monkeypatch, few):
    monkeypatch.setattr(lake, "FEW_KEYS", few)
    tied = [("a", 1, "old", None), ("a", 2, "x", None), ("a", 2, "y", "z"), ("a", 2, "x", None), ("b", 5, "same", "s"), ("b", 5, "same", "s"),
            ("c", 1, "one", None), ("d", 3, "d3", None), ("d", 4, "d4", None), (None, 1, "n1", None), (None, 2, "n2", None), ("e", 2, "e2", None), ("e", 2, "e2", None), ("e", 1, None, None)]
    first = sorted(map(str, lake.latest(lake_of(spark, tied)).collect()))
    assert first == sorted(map(str, lake.latest(lake_of(spark, tied[::-1])).collect()))
    rows = lake.latest(lake_of(spark, tied)).collect()
    assert {r.blob_key: r.text for r in rows if r.blob_key not in ("a", None)} == {"b": "same", "c": "one", "d": "d4", "e": "e2"}
    assert [r.text in ("x", "y") for r in rows if r.blob_key == "a"] == [True]
    once = lake_of(spark, [("a", 1, "t", None), ("b", 1, "u", None)])
    assert lake.latest(once) is once
    assert lake.latest(lake_of(spark, []).limit(0)).count() == 0


def test_a_bitmap_loses_no_key(spark):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), "id").unionAll(spark.sql("select null, -1L"))
    for bits, most in ((1 << 26, 3), (1 << 15, 150)):
        flagged = with_maybe(rows, keys, ["key"], bits=bits).collect()
        assert len(flagged) == 3001 and all(r.maybe for r in flagged if r.id % 3 == 0 and r.id >= 0)
        assert sum(r.maybe for r in flagged if r.id % 3) <= most
    assert not with_maybe(rows, keys.limit(0), ["key"]).filter("maybe").count()


def test_counts(spark):
    frame = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), ("2", "c"), (None, "d")], "vat string, blob_key string")
    assert tuple(lake.lake_counts(frame).first()) == (2, 4)
    assert tuple(lake.lake_counts(frame.limit(0)).first()) == (0, 0)
    assert tuple(reports.counts_of_reports(spark.createDataFrame([], schemas.REPORTS)).first()) == (0, 0)


def test_index_from_paths(spark):
    paths = spark.createDataFrame([("0471/2020/01/02/0007.json",), ("lonely.json",)], "path string")
    assert {tuple(r) for r in lake.index_from_paths(paths).collect()} == {
        ("0471/2020/01/02/0007.json", "0471", "0007"), ("lonely.json", None, "lonely")}


def test_run_report(spark):
    schema = "vat string, blob_key string"
    before = spark.createDataFrame([("1", "a"), ("2", "b")], schema)
    after = spark.createDataFrame([("1", "a"), ("1", "c"), ("3", "d"), ("3", "d"), ("4", "e")], schema)
    rows = lambda a, b, **k: sorted(tuple(r) for r in reports.run_report(a, b, "r", **k).collect())
    assert rows(before, after) == [("r", 2, 3, "3"), ("r", 2, 3, "4")]
    assert rows(before, before) == [("r", 0, 0, None)]
    assert rows(before, after, finished=False) == []
    assert sorted(r.vat for r in stored.new_companies(before, after).collect()) == ["3", "4"]


def test_days(spark):
    ranges = spark.createDataFrame([
        (1, date(2024, 1, 1), date(2024, 1, 7)), (2, date(2024, 1, 1), date(2024, 1, 1)),
        (3, date(2024, 1, 2), date(2024, 1, 1)), (4, date(2024, 1, 6), None)], "id int, start_date date, end_date date")
    rows = frontier.day_frontier(ranges, date(2024, 1, 7)).collect()
    count = {i: sum(r.id == i for r in rows) for i in (1, 2, 3, 4)}
    assert count == {1: 7, 2: 1, 3: 0, 4: 2}
    assert all(r.start_date == r.end_date and r.page == 1 and r.search_id == str(r.start_date) for r in rows)


def test_company_searches(spark):
    seeds = spark.createDataFrame([("a", "0123456789", None, None)], "search_id string, vat string, start_date date, end_date date")
    row = frontier.company_frontier(seeds).first()
    assert row.search_vat == "123456789" and row.url.endswith("language=nl&btw=0123456789")


def test_not_downloaded(spark):
    rows = spark.createDataFrame([("http://h/tsv_pdf/2020/a.pdf",), ("http://h/tsv_pdf/2020/b.pdf",)], "publication_link string")
    manifest = spark.createDataFrame([("file:/store/2020/a.pdf",), ("s3://bucket/store/2020/c.pdf",)], "path string")
    left = stored.not_downloaded(rows, manifest, "/store").collect()
    assert [r.publication_link[-5:] for r in left] == ["b.pdf"]
