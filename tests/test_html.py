"""Blocks of a page and parts of a block, on hand-made HTML."""

import pytest
from pyspark.sql import functions as F

from gazette_lake.operators import blocks, frontier

PAGE = """<!DOCTYPE html><html><body><a href="/nav.pdf">nav</a><main>
<div class="list-item">
 <div class="c"><p class=x> <font color="blue">A &amp; B &eacute;</font> BV <br>more</p>
 <a class="t" href="/x.html">STREET 1 1000 CITY<br> 0471.938.850 <br>ACT<b>bold</b><br>2024-06-05 / 0402585</a>
 <a href='/tsv_pdf/a.pdf?x=1&amp;y=2'>1</a><A HREF="/tsv_pdf/2024/06/05/1.pdf">2</A></div>
</div>
<div class="list-item">only text</div>
<div class="list-item"><div><p>no font</p><a href=/bare.pdf> <br>v<!-- c -->w</a></div></div>
<div class="list-item"><p>nothing inside</p></div>
<div class="list-item"><div><p>note</p><p> <font></font><font>CO &#0000000065;&#x000041;&#99999999999999999999;</font> BV</p></div></div>
</main><footer><a href="/foot.pdf">f</a></footer>"""


@pytest.fixture(scope="module")
def parsed(spark):
    pages = spark.createDataFrame([("s", None, None, None, "u", PAGE)],
                                  "search_id string, page int, search_vat string, start_date date, url string, html string")
    return blocks.block_parts(blocks.page_blocks(pages)).orderBy("pos").collect()


def test_blocks_need_an_element_and_end_with_the_list(parsed):
    assert [(r.page, r.pos) for r in parsed] == [(1, 1), (1, 2), (1, 3), (1, 4)]


def test_links(parsed):
    assert parsed[0].urls == ["/x.html", "/tsv_pdf/a.pdf?x=1&y=2", "/tsv_pdf/2024/06/05/1.pdf"]
    assert parsed[1].urls == ["/bare.pdf"]
    assert parsed[2].urls == []


def test_name_and_form(parsed):
    assert parsed[0].company_name == "A & B é"
    assert parsed[0].company_juridical_form == "BV"
    assert parsed[1].company_name is None and parsed[1].company_juridical_form == ""
    assert parsed[2].company_name is None and parsed[2].company_juridical_form == ""


def test_any_paragraph_counts_and_references_have_any_length(parsed):
    assert parsed[3].company_name == "CO AA&#99999999999999999999;"
    assert parsed[3].company_juridical_form == "BV"


def test_metadata_keeps_blank_texts_and_skips_child_elements(parsed):
    assert parsed[0].meta == ["STREET 1 1000 CITY", "0471.938.850", "ACT", "2024-06-05 / 0402585"]
    assert parsed[1].meta == ["", "v", "w"]
    assert parsed[2].meta == []


@pytest.mark.parametrize("size, named", [(4, True), (6, True), (3, False), (5, False), (0, False)])
def test_unpack(spark, size, named):
    from gazette_lake.functions.fields import unpack_meta

    meta = F.slice(F.array(*[F.lit(x) for x in "abcdef"]), 1, size)
    row = spark.range(1).select(*[c.alias(n) for n, c in unpack_meta(meta).items()]).first()
    assert tuple(row) == (("a", "b", "c", "d") if named else (None,) * 4)


def test_no_results_ends_an_unpaged_search_only(spark):
    marker = "Geen tekst komt overeen met uw zoekopdracht"
    block = '<div class="list-item"><p>x</p></div>'
    pages = spark.createDataFrame(
        [("a", None, marker + block), ("b", 1, marker + block), ("c", None, block)], "search_id string, page int, html string")
    assert {r.search_id for r in blocks.page_blocks(pages).collect()} == {"b", "c"}


def test_next_page_after_a_full_last_page_only(spark):
    block = '<div class="list-item"><p>x</p></div>'
    rows = [("full", 1, 100), ("full", 2, 100), ("done", 1, 100), ("done", 2, 0), ("short", 1, 99), ("first", None, 100)]
    pages = spark.createDataFrame([(s, p, "1", block * n) for s, p, n in rows],
                                  "search_id string, page int, vat string, html string")
    counted = frontier.blocks_per_page(pages)
    assert {(r.search_id, r.page): r.n_blocks for r in counted.collect()} == {(s, p): n for s, p, n in rows}
    found = frontier.next_pages(counted, vat="vat").collect()
    assert {(r.search_id, r.page) for r in found} == {("full", 3), ("first", 2)}
    assert all(r.url.endswith(f"page={r.page}&btw=1") for r in found)
