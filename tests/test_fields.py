"""Scalar fields and links on literal values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from gazette_lake.functions import fields, text, urls


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def s(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize("address, expected", [
    ("RUE JACQUES JORDAENS 32A, BTE6 1000 BRUXELLES", ("RUE JACQUES JORDAENS 32A, BTE6", "1000", "BRUXELLES")),
    ("X 1234 Y 5678 Z", ("X 1234 Y", "5678", "Z")),
    ("A 1000 B", ("A", "1000", "B")),
    ("A\x1c1000 B", ("A", "1000", "B")),
    ("A 1000 ", ("A", "1000", "")),
    (" 1000 B", ("", "1000", "B")),
    ("A 10000 B", (None, None, None)),
    ("A 1000", (None, None, None)),
    ("A\n1 1000 B", (None, None, None)),
    ("A\r1 1000 B", ("A\r1", "1000", "B")),
    ("", (None, None, None)),
    (None, (None, None, None)),
])
def test_address(spark, address, expected):
    assert tuple(value(spark, fields.address_parts(s(address)))) == expected


@pytest.mark.parametrize("raw, day, number", [
    ("2024-06-05 / 0402585", date(2024, 6, 5), "0402585"),
    ("2010-01-02 / 20100102-123", date(2010, 1, 2), "20100102-123"),
    ("2010-01-02 / -123", date(2010, 1, 2), "-123"),
    ("1998 / 0012345", date(1998, 1, 1), "0012345"),
    ("2024-13-45 / 1", None, "1"),
    ("2023-02-29 / 1", None, "1"),
    ("0000 / 1", None, "1"),
    ("0000-01-01 / 1", None, "1"),
    ("2024-06-05 / 7", date(2024, 6, 5), "7"),
    ("2024-06-05  / 7", None, None),
    ("2024-06-05/7", None, None),
    ("2024-06-05 / ", None, None),
    ("2024-06-05 / 7x", None, None),
    ("n/a", None, None),
    ("", None, None),
    (None, None, None),
])
def test_date_and_number(spark, raw, day, number):
    assert value(spark, fields.publication_date(s(raw))) == day
    assert value(spark, fields.publication_number(s(raw))) == number


@pytest.mark.parametrize("raw, clean, normal", [
    ("0471.938.850", "0471938850", "471938850"),
    (" 0471.938.850 \t", "0471938850", "471938850"),
    ("000", "000", "0"),
    ("BE1", "BE1", None),
    ("", None, None),
    (None, None, None),
])
def test_company_number(spark, raw, clean, normal):
    cleaned = fields.clean_vat(s(raw))
    assert value(spark, cleaned) == clean
    assert value(spark, fields.normalize_vat(cleaned)) == normal


def test_strip_knows_all_white_space(spark):
    spaces = "".join(filter(str.isspace, map(chr, range(0x3001))))
    assert value(spark, text.strip(s(spaces + "a b" + spaces))) == "a b"
    assert value(spark, text.strip(s("​a"))) == "​a"


@pytest.mark.parametrize("raw, expected", [
    ("a &amp; b", "a & b"),
    ("&amp;lt;", "&lt;"),
    ("&eacute;&#233;&#xE9;&#x1F600;", "ééé\U0001f600"),
    ("&nothing; &#0; &#xD800; &", "&nothing; &#0; &#xD800; &"),
    ("plain", "plain"),
    (None, None),
])
def test_entities(spark, raw, expected):
    assert value(spark, text.decode_entities(s(raw))) == expected


@pytest.mark.parametrize("links, only, several, first", [
    (["/x.html", "/a/b.pdf"], "/a/b.pdf", False, "/a/b.pdf"),
    (["/x.html"], None, False, None),
    (["/a.pdf", "/b.pdf"], None, True, "/a.pdf"),
    (["/a.PDF"], None, False, None),
    ([], None, False, None),
])
def test_pdf_links(spark, links, only, several, first):
    column = F.from_json(F.lit(str(links).replace("'", '"')), "array<string>")
    assert value(spark, urls.only_pdf(column)) == only
    assert value(spark, urls.has_several_pdfs(column)) is several
    base = "http://base"
    assert value(spark, urls.first_pdf_url(column, base)) == (base + first if first else "")


@pytest.mark.parametrize("path, stem", [
    ("/tsv_pdf/2023/05/31/23070228.pdf", "23070228"),
    ("471/2023/05/31/0070228.json", "0070228"),
    ("a.tar.gz", "a.tar"),
    ("/x/.pdf", ".pdf"),
    ("/x/..pdf", "."),
    ("/x/a.", "a."),
    ("/x/a/", "a"),
    ("", None),
])
def test_stem(spark, path, stem):
    assert value(spark, urls.path_stem(s(path))) == stem


def test_paths(spark):
    url = s("https://host.example/tsv_pdf/2023/05/31/23070228.pdf?x=1")
    assert value(spark, urls.store_path(url)) == "/2023/05/31/23070228.pdf"
    assert value(spark, urls.local_path("/data/", urls.store_path(url))) == "/data/2023/05/31/23070228.pdf"
    assert value(spark, urls.store_path(s("not a url"))) is None


def test_search_urls(spark):
    day = F.lit(date(2024, 7, 4))
    page = lambda n: F.lit(n).cast("int")
    make = lambda *a: value(spark, urls.search_url(*a, base="http://b"))
    assert make(page(None), s("0123"), None, None) == "http://b/cgi_tsv/rech_res.pl?language=nl&btw=0123"
    assert make(page(0), s("0123"), None, None) == "http://b/cgi_tsv/rech_res.pl?language=nl&btw=0123"
    assert make(page(2), s("123"), None, None) == "http://b/cgi_tsv/list.pl?language=nl&page=2&btw=123"
    assert make(page(1), None, day, day) == (
        "http://b/cgi_tsv/list.pl?language=nl&page=1&pdd=2024-07-04&pdf=2024-07-04")
    missing = urls.missing_pdf_url(s(None), F.lit(None).cast("date"), "http://b")
    assert value(spark, missing) == "http://b/cgi_tsv/rech_res.pl?btw=None&pdd=&pdf="


def test_key_tags_and_json(spark):
    day = F.lit(date(2023, 5, 1))
    assert value(spark, fields.lake_key(s("123"), day, s("0070228"))) == "123/2023/05/01/0070228.json"
    assert value(spark, fields.lake_key(s(None), day, s("1"))) is None
    assert value(spark, fields.tags(s("123"), day)) == {
        "vat": "123", "publication_date": "2023-05-01", "status": "unprocessed"}
    row = F.struct(s("é").alias("a"), s(None).alias("b"))
    assert value(spark, fields.as_json(row)) == '{"a":"é","b":null}'


def test_record_is_twelve_strings(spark):
    columns = {name: s(name) for name in fields.PUBLICATION_FIELDS}
    columns["publication_date"] = F.lit(date(2023, 5, 1))
    record = value(spark, fields.record(**columns))
    assert len(record) == 12 and record["publication_date"] == "2023-05-01" and record["city"] == "city"


def test_effective_company(spark):
    assert value(spark, fields.effective_vat(s("1"), s("2"))) == "1"
    assert value(spark, fields.effective_vat(s(None), s("2"))) == "2"
