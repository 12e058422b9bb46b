"""Page layout against a small row-by-row model of the rules, on random and on border cases."""

import random

import pytest
from pyspark.sql import functions as F

from gazette_lake import schemas
from gazette_lake.functions import geometry as g
from gazette_lake.operators import layout

SCHEMA = f"doc_id string, pages {schemas.OCR_PAGES}, geometry {schemas.GEOMETRY}, page_texts array<string>"
BODY = {True: (0.15966, 0.20485, 0.95, 0.9195), False: (0.15966, 0.04899, 0.95, 0.9195)}


def line(content, *corners):
    x0, y0, x1, y1 = map(float, corners)
    return (content, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def page(lines, width=100.0, height=100.0):
    return (width, height, lines, [])


def frame(spark, documents):
    rows = [(str(i), pages, geometry, texts) for i, (pages, geometry, texts) in enumerate(documents)]
    return spark.createDataFrame(rows, SCHEMA)


def model(pages, geometry, sort=True, tabs=True):
    out = ""
    for number, (ocr, (width, height)) in enumerate(zip(pages, geometry)):
        fx, fy = width / ocr[0], height / ocr[1]
        boxes = []
        for content, polygon in ocr[2]:
            xs, ys = [p[0] for p in polygon], [p[1] for p in polygon]
            boxes.append((min(ys), min(xs), max(ys), max(xs), content))
        if not boxes:
            continue
        tally = {}
        for top, _, bottom, _, _ in boxes:
            tally[bottom - top] = tally.get(bottom - top, 0) + 1
        usual = max(tally, key=tally.get) * fy  # dicts keep first-seen order, max takes the first of equals
        if sort:
            boxes.sort(key=lambda b: b[:2])
        left, upper, right, lower = (f * s for f, s in zip(BODY[number == 0], (width, height, width, height)))
        above = None
        for top, x0, bottom, x1, content in boxes:
            top, bottom, x0, x1 = top * fy, bottom * fy, x0 * fx, x1 * fx
            if x0 < left or x1 > right or top < upper or bottom > lower:
                continue
            level = False
            if tabs and above and above[0] and above[1]:
                level = (abs(above[0] - top) / top <= 0.05 and abs(above[1] - bottom) / bottom <= 0.05
                         and max(bottom, above[1]) - min(top, above[0]) <= usual * 1.25)
            if level:
                out += "\t"
            elif out and not out.endswith("\n") and not content.startswith("\n"):
                out += "\n"
            out += content
            above = top, bottom
    return out


def random_document(rng):
    pages, geometry = [], []
    for _ in range(rng.randrange(0, 4)):
        lines = []
        for _ in range(rng.randrange(0, 30)):
            y0 = rng.randrange(0, 190) / 2
            x0 = rng.randrange(0, 80)
            content = rng.choice(["a", "bb", "", "c\n", "\nd", "\n", "é f"])
            lines.append(line(content, float(x0), y0, x0 + rng.choice([5.0, 20.0]), y0 + rng.choice([1.0, 1.5, 2.0])))
        pages.append(page(lines))
        geometry.append((rng.choice([100.0, 595.0]), rng.choice([100.0, 842.0])))
    if rng.random() < 0.3 and geometry:
        geometry.pop()
    return pages, geometry, []


@pytest.mark.parametrize("options", [{}, {"sort": False, "tabs": False}, {"sort": False}, {"tabs": False}])
def test_random_layouts(spark, options):
    rng = random.Random(7)
    documents = [random_document(rng) for _ in range(300)]
    got = {int(r.doc_id): r.t for r in layout.with_scan_text(frame(spark, documents), "t", **options).select("doc_id", "t").collect()}
    for i, (pages, geometry, _) in enumerate(documents):
        assert got[i] == model(pages, geometry, **options), i


def scan(spark, *pages, geometry=None):
    geometry = geometry or [(100.0, 100.0)] * len(pages)
    return layout.with_scan_text(frame(spark, [(list(pages), geometry, [])]), "t").first()["t"]


def test_one_height_gives_a_tab(spark):
    assert scan(spark, page([line("a", 20, 50, 30, 52), line("b", 40, 50, 50, 52)])) == "a\tb"


@pytest.mark.parametrize("y, same", [(50.0, True), (47.5, True), (47.4, False)])
def test_five_percent_of_the_current_line(spark, y, same):
    # Tall lines, so that only the 5 % rule decides.
    text = scan(spark, page([line("a", 20, y, 30, y + 30), line("b", 40, 50, 50, 80)]))
    assert text == ("a\tb" if same else "a\nb")


@pytest.mark.parametrize("bottom, same", [(52.5, True), (52.75, False)])
def test_union_height_limit(spark, bottom, same):
    lines = [line("x", 1, 60, 2, 62), line("y", 1, 64, 2, 66), line("a", 20, 50, 30, 52), line("b", 40, 50, 50, bottom)]
    assert scan(spark, page(lines)) == ("a\tb" if same else "a\nb")


def test_crop_border_is_inside(spark):
    left, top, right, bottom = 15.966, 20.485, 95.0, 91.95
    lines = [line("in", left, top, right, bottom), line("out", left - 0.001, 30, 40, 32)]
    assert scan(spark, page(lines)) == "in"


def test_line_outside_the_crop_does_not_come_between(spark):
    lines = [line("a", 20, 50, 30, 52), line("out", 1, 50.1, 2, 52.1), line("b", 40, 50.2, 50, 52.2)]
    assert scan(spark, page(lines)) == "a\tb"


def test_first_seen_height_wins_a_tie(spark):
    values = F.array(*[F.lit(v) for v in (3.0, 1.0, 1.0, 3.0, 2.0)])
    assert spark.range(1).select(g.most_frequent(values)).first()[0] == 3.0
    empty = F.array().cast("array<double>")
    assert spark.range(1).select(g.most_frequent(empty)).first()[0] is None


def test_no_tab_over_a_page_change(spark):
    one = page([line("a", 20, 50, 30, 52)])
    assert scan(spark, one, one) == "a\na"


def test_contents_with_newlines(spark):
    lines = [line("a\n", 20, 30, 30, 31), line("b", 20, 40, 30, 41), line("\nc", 20, 60, 30, 61), line("", 20, 80, 30, 81)]
    assert scan(spark, page(lines)) == "a\nb\nc\n"


def test_empty_and_surplus_pages(spark):
    one = page([line("a", 20, 50, 30, 52)])
    assert scan(spark, page([])) == ""
    assert scan(spark, one, one, geometry=[(100.0, 100.0)]) == "a"


def test_dispatch(spark):
    pages, geometry = [page([line("scan", 20, 50, 30, 52)])], [(100.0, 100.0)]
    documents = frame(spark, [(pages, geometry, ["d1", "", "\nd2"]), (pages, geometry, [""]), (pages, geometry, [" "]), (pages, geometry, [])])
    read = lambda df: {r.doc_id: (r.text, r.is_digital) for r in df.collect()}
    assert read(layout.with_text(documents)) == {
        "0": ("d1\n\nd2", True), "1": ("scan", False), "2": (" ", True), "3": ("scan", False)}
    assert read(layout.with_text(documents, ocr=False))["1"] == (None, False)


def test_same_height_boxes_ignore_the_crop(spark):
    pages = [page([line("a", 1, 50, 2, 52), line("b", 4, 50.5, 5, 52.5)])]
    row = layout.same_height_boxes(frame(spark, [(pages, [(200.0, 100.0)], [])])).first()
    assert (row.page_idx, row.content, row.x0, row.y0, row.x1, row.y1) == (0, "b", 2.0, 50.0, 10.0, 52.5)


def test_word_boxes_use_corners_0_and_2_of_the_first_page(spark):
    words = [("w", [(1.0, 2.0), (9.0, 9.0), (3.0, 4.0), (0.0, 0.0)])]
    pages = [(10.0, 10.0, [], words), (10.0, 10.0, [], words)]
    rows = layout.word_boxes(frame(spark, [(pages, [(20.0, 30.0), (20.0, 30.0)], [])])).collect()
    assert [tuple(r) for r in rows] == [("0", 0, "w", 2.0, 6.0, 6.0, 12.0)]


def test_narrow_right_edge(spark):
    lines = [line("a", 20, 50, 94, 52)]
    documents = frame(spark, [([page(lines)], [(100.0, 100.0)], [])])
    assert layout.with_scan_text(documents, "t").first()["t"] == "a"
    narrow = (0.15966, 0.20485, 0.93277, 0.9195)
    assert layout.with_scan_text(documents, "t", first=narrow).first()["t"] == ""


def test_no_shuffle_in_text_assembly(spark):
    plan = layout.with_text(frame(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("segment, options", [(64, {}), (2, {}), (1, {"sort": False, "tabs": False})])
def test_pages_in_rows_of_their_own(spark, monkeypatch, segment, options):
    monkeypatch.setattr(layout, "PAGES_PER_SEGMENT", segment)
    rng = random.Random(segment)
    documents = [random_document(rng) for _ in range(60)]
    long = [random_document(rng) for _ in range(12)]
    documents.append(([p for d in long for p in d[0]], [q for d in long for q in d[1]], []))
    whole = frame(spark, documents)
    want = {r.doc_id: r.text for r in layout.with_scan_text(whole, "text", **options).collect()}
    rows = layout.page_rows(whole, ["doc_id"])
    got = {r.doc_id: r.text for r in layout.scan_text_of_pages(rows.repartition(5), **options).collect()}
    assert set(want) - set(got) == {d for d, text in want.items() if not documents[int(d)][0] or not documents[int(d)][1]}
    assert all(want[d] == text for d, text in got.items()) and any("\n" in text for text in got.values())


def test_parts_join_in_any_groups(spark):
    lines = [("a", False), ("", False), ("b", True), ("c\n", False), ("\n", False), ("", True), ("d", False), (None, False), ("e", False)]
    rows = spark.createDataFrame([(lines[:i], lines[i:j], lines[j:]) for i in range(10) for j in range(i, 10)],
                                 "a array<struct<content:string,same_line:boolean>>, b array<struct<content:string,same_line:boolean>>, c array<struct<content:string,same_line:boolean>>")
    part = lambda name: g.line_part(F.col(name))
    both = lambda x, y: g.join_parts(F.array(x, y))
    for r in rows.select(both(both(part("a"), part("b")), part("c")).alias("l"), both(part("a"), both(part("b"), part("c"))).alias("r"),
                         g.join_parts(F.array(part("a"), part("b"), part("c"))).alias("m")).collect():
        assert r.l == r.r == r.m
