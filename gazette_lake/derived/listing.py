"""Listings derived from ``orders``, ``customer`` and ``nation``.

Every order is one publication block of its customer; every nation is one search.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake.functions import urls
from gazette_lake.operators.ordering import Bucket, with_position
from gazette_lake.session import stage
from gazette_lake.sources.tables import read_table, spread

KEYS_PER_BUCKET = 1 << 20


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation: a few narrow columns, of which everything else is made."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = spread(orders, "o_orderkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
    )
    return joined.select(
        F.col("c_nationkey").cast("string").alias("search_id"),
        F.col("o_orderkey").alias("k"), F.col("c_custkey").alias("ck"), "n_name",
        F.col("o_orderdate").cast("date").alias("d"),
    )


def _with_texts(orders: DataFrame, *places: str) -> DataFrame:
    digits = "cast(471000000 + ck as string)"
    return orders.selectExpr(
        "search_id", "k", "ck", "d",
        "case when k % 13 = 0 then 'NO ZIP HERE' else concat('STREET ', cast(ck as string), ' ', "
        "cast(1000 + ck % 9000 as string), ' ', n_name) end as address",
        "case when k % 43 = 0 then '' else "
        f"concat(case when k % 41 = 0 then 'BE0' else '0' end, substr({digits}, 1, 3), '.', substr({digits}, 4, 3), '.', substr({digits}, 7)) end as vat_raw",
        "case when k % 19 = 0 then 'n/a' when k % 17 = 0 "
        "then concat(date_format(d, 'yyyy'), ' / ', lpad(cast(k as string), 7, '0')) "
        "else concat(cast(d as string), ' / ', lpad(cast(k as string), 7, '0')) end as pub_raw",
        "concat('/tsv_pdf/', date_format(d, 'yyyy/MM/dd'), '/', cast(10000000 + k as string), '.pdf') as rel",
        "case when k % 11 = 0 then 0 when k % 23 = 0 then 2 else 1 end as n_pdf",
        "case when k % 7 = 0 then 6 when k % 31 = 0 then 3 else 4 end as arity",
        *places,
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that listings are made of, joined and written once for jobs that make several."""
    return stage(_orders(spark, sf_dir), "orders")


def listing_rows(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One row per order, not yet placed on result pages."""
    return _with_texts(_orders(spark, sf_dir) if orders is None else orders)


def listing(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``listing_rows`` newest first: ``search_pos`` in the search, ``page`` of 100, ``pos`` on the page.

    Rows are placed while they are narrow; their texts are made behind the last exchange.
    """
    rows = (_orders(spark, sf_dir) if orders is None else orders).withColumns({
        "_day": F.coalesce("d", F.lit("0001-01-01").cast("date")),
        "_keys": F.expr(f"k div {KEYS_PER_BUCKET}"),
    })
    placed = with_position(rows, ["search_id"], [Bucket("_day", descending=True), Bucket("_keys")], [F.col("k")])
    return _with_texts(
        placed, "search_pos", "cast((search_pos - 1) div 100 + 1 as int) as page", "cast((search_pos - 1) % 100 + 1 as int) as pos")


def link_array() -> Column:
    """Link targets of a block: the company's own page, then no, one or two pdfs."""
    return F.expr("""
      case n_pdf when 0 then array('/x.html') when 1 then array('/x.html', rel)
      else array('/x.html', rel, '/dup.pdf') end""")


def meta_array() -> Column:
    return F.expr("""
      case arity when 3 then array(vat_raw, 'ACT', pub_raw)
      when 6 then array(address, vat_raw, 'ACT', pub_raw, 'e1', 'e2')
      else array(address, vat_raw, 'ACT', pub_raw) end""")


def parts(listed: DataFrame) -> DataFrame:
    """Block parts, as parsing the block's HTML yields them."""
    return listed.withColumns({
        "search_vat": F.lit(None).cast("string"),
        "start_date": F.when(F.col("search_id").cast("int") % 2 == 0, F.lit("1997-07-01").cast("date")),
        "urls": link_array(),
        "company_name": F.concat(F.lit("CO "), F.col("k").cast("string")),
        "company_juridical_form": F.when(F.col("k") % 3 == 0, "BV").otherwise("NV"),
        "meta": meta_array(),
    })


def _page_url(page: Column) -> Column:
    return F.concat(F.lit("https://gazette.example/list?s="), F.col("search_id"), F.lit("&p="), page.cast("string"))


def result_pages(listed: DataFrame) -> DataFrame:
    """HTML result pages of at most 100 blocks, left open at the end like real ones."""
    pdf = lambda target: F.concat(F.lit('<a href="'), target, F.lit('">pdf</a>'))
    links = F.when(F.col("n_pdf") == 0, F.lit("")).when(F.col("n_pdf") == 1, pdf(F.col("rel"))).otherwise(
        F.concat(pdf(F.col("rel")), pdf(F.lit("/dup.pdf"))))
    note = F.when(F.col("k") % 6 == 0, "<p>note</p>").otherwise("")
    meta = F.array_join(meta_array(), " <br>\n ")
    padded = F.when(F.col("k") % 5 == 0, F.replace(meta, F.lit("ACT"), F.lit("&#00000065;&#x0000043;T"))).otherwise(meta)
    block = F.concat(
        F.lit('<div class="list-item"><div class="c">'), note, F.lit("<p> <font>CO "), F.col("k").cast("string"),
        F.lit("</font> "), F.when(F.col("k") % 3 == 0, "BV").otherwise("NV"),
        F.lit(' <br></p><a href="/x.html">'), padded, F.lit("</a>"),
        links, F.lit("</div></div>"),
    )
    blocks = listed.select("search_id", "page", F.struct("pos", block.alias("block")).alias("_b"))
    # A page holds at most 100 blocks, by the way pages are numbered.
    grouped = blocks.groupBy("search_id", "page").agg(F.sort_array(F.collect_list("_b")).alias("_b"))
    body = F.array_join(F.transform("_b", lambda b: b["block"]), "\n")
    start = F.when(F.col("search_id").cast("int") % 2 == 0, F.lit("1997-07-01").cast("date"))
    return grouped.select(
        "search_id", "page", F.lit(None).cast("string").alias("search_vat"), start.alias("start_date"),
        _page_url(F.col("page")).alias("url"),
        F.concat(F.lit("<html><body><main>"), body, F.lit("</main>")).alias("html"),
    )


def fetched_pages(listed: DataFrame) -> DataFrame:
    """``crawled_pages`` in the middle of a crawl: odd searches still lack their last page."""
    pages = stage(crawled_pages(listed), "crawled")
    return pages.join(late_pages(pages), ["search_id", "page"], "left_anti")


def late_pages(pages: DataFrame) -> DataFrame:
    """(search_id, page) of the last pages of odd searches."""
    last = pages.groupBy("search_id").agg(F.max("page").alias("_last"))
    return last.filter(F.col("search_id").cast("int") % 2 == 1).select("search_id", F.col("_last").alias("page"))


def crawled_pages(listed: DataFrame) -> DataFrame:
    """``result_pages``, and behind the last page of every fourth search an empty one."""
    listed = stage(listed, "listed")
    last = listed.groupBy("search_id").agg(F.max("page").alias("_last"))
    number = F.col("search_id").cast("int")
    behind = last.filter(number % 4 == 0).select(
        "search_id", (F.col("_last") + 1).alias("page"), F.lit(None).cast("string").alias("search_vat"),
        F.lit("1997-07-01").cast("date").alias("start_date"), _page_url(F.col("_last")).alias("url"),
        F.lit("<html><body><main></main>").alias("html"))
    return result_pages(listed).unionAll(behind)


def lake_paths(rows: DataFrame) -> DataFrame:
    """Paths of records already stored: every fifth order."""
    return rows.filter("k % 5 = 0").selectExpr(
        "concat(cast(471000000 + ck as string), '/', date_format(d, 'yyyy/MM/dd'), '/', "
        "lpad(cast(k as string), 7, '0'), '.json') as path")


def fetch_results(rows: DataFrame) -> DataFrame:
    """Download results: every 37th pdf has none, every 29th failed."""
    url = urls.absolute_url(F.col("rel"))
    return rows.filter("k % 37 <> 0").select(
        url.alias("url"), F.expr("k % 29 <> 0").alias("ok"), urls.store_path(url).alias("path"))


def pdf_manifest(rows: DataFrame) -> DataFrame:
    """Files of the pdfs that were fetched, as a file system lists them."""
    stored = fetch_results(rows.select("*")).filter("ok").select("path")
    numbered = rows.select(urls.store_path(urls.absolute_url(F.col("rel"))).alias("path"), "k", "d").join(stored, "path")
    return numbered.select(
        F.concat(F.lit("file:///data/pdfs"), "path").alias("path"), F.col("d").cast("timestamp").alias("modified"),
        (1000 + F.col("k") % 9000).cast("bigint").alias("n_bytes"))


def pdf_documents(rows: DataFrame) -> DataFrame:
    """Which document is behind a pdf: fifteen publications share one."""
    return rows.select(
        urls.absolute_url(F.col("rel")).alias("publication_link"),
        F.expr("cast(k div 15 as string)").alias("doc_id"))
