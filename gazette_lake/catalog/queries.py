"""Registered queries: one per operator, each over the whole given tables."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake import fixed
from gazette_lake.catalog import frames
from gazette_lake.derived import layout as layout_data
from gazette_lake.derived import listing as listing_data
from gazette_lake.functions import fields, html, urls
from gazette_lake.functions import geometry as g
from gazette_lake.operators import blocks, cutoff, frontier, lake, layout, prompts, rejects, reports, stored
from gazette_lake.operators.unnest import unnest
from gazette_lake.plans import summarize as summarizing
from gazette_lake.plans.bookkeeping import ENTRY, record_rewrites
from gazette_lake.plans.bookkeeping import lake_counts as kept_counts
from gazette_lake.plans.listing import cut_pages
from gazette_lake.plans.listing import unfinished_searches as find_unfinished
from gazette_lake.plans.publish import with_text_place
from gazette_lake.session import cleared_shuffles, cleared_stages, new_folder, stage
from gazette_lake.sources import compaction, landed, sinks
from gazette_lake.sources.files import read_files
from gazette_lake.sources.index import entries_of, write_entries
from gazette_lake.sources.tables import read_table, spread
from gazette_lake.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


def _parts(spark, sf):
    """Block parts without page numbers, for row-wise operators."""
    return listing_data.parts(listing_data.listing_rows(spark, sf))


# Sources and frontier


@query
def scan_pages(spark, sf):
    pages = listing_data.crawled_pages(listing_data.listing(spark, sf))
    folder = new_folder(spark, "pages")
    pages.write.parquet(folder)
    return landed.read_pages(spark, folder).select(
        "search_id", "page", "url", F.length("html").cast("bigint").alias("n_chars"))


@query
def scan_files_by_prefix(spark, sf):
    """Lines of many small files, a folder for each search, listed where they are read."""
    folder = new_folder(spark, "files")
    rows = listing_data.listing_rows(spark, sf).select("search_id", F.concat_ws("|", "k", "pub_raw").alias("value"))
    rows.write.partitionBy("search_id").text(folder)
    files = read_files(spark, folder, "*.txt")
    lines = F.explode(F.split(F.rtrim(F.decode("content", "UTF-8"), F.lit("\n")), "\n"))
    return files.select(F.replace("prefix", F.lit("search_id="), F.lit("")).alias("search_id"), lines.alias("line"))


@query
def scan_ocr(spark, sf):
    folder = new_folder(spark, "ocr")
    layout_data.layouts(spark, sf).select("doc_id", "pages").write.json(folder)
    pages = unnest(landed.read_ocr(spark, folder), ["doc_id"], "pages", "page", "page_idx")
    return pages.select(
        "doc_id", "page_idx", "page.width", "page.height",
        F.size("page.lines").cast("bigint").alias("n_lines"),
        F.array_join("page.lines.content", "|").alias("contents"))


@query
def scan_digital_layout(spark, sf):
    folder = new_folder(spark, "digital")
    data = layout_data.layouts(spark, sf)
    data.select("doc_id", "pages", "geometry").write.json(folder)
    landed_layouts = landed.read_digital_layout(spark, folder)
    texts = layout.with_digital_page_texts(landed_layouts)
    return texts.select("doc_id", layout.digital_text(F.col("page_texts")).alias("text"))


@query
def scan_pdf_manifest(spark, sf):
    return _manifest(spark, sf).select("path", _day("modified").alias("day"), "n_bytes")


def _manifest(spark, sf):
    folder = new_folder(spark, "manifest")
    listing_data.pdf_manifest(listing_data.listing_rows(spark, sf)).write.parquet(folder)
    return landed.read_pdf_manifest(spark, folder)


@query
def not_downloaded(spark, sf):
    rows = frames.typed_rows(spark, sf).filter("publication_link is not null")
    return stored.not_downloaded(rows, _manifest(spark, sf), "/data/pdfs").select("search_id", "page", "pos", "publication_link")


@query
def scan_publications(spark, sf):
    folder = new_folder(spark, "publications")
    sinks.export_json(frames.plain_records(spark, sf), folder)
    return landed.read_publications(spark, folder, per_line=True).select("vat", "zipcode", "publication_number", "is_digital", "text")


@query
def frontier_vat(spark, sf):
    seeds = read_table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("search_id"),
        F.concat(F.lit("0"), (471000000 + F.col("c_custkey")).cast("string")).alias("vat"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("1997-07-01").cast("date")).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"))
    return frontier.company_frontier(seeds).select("search_id", "search_vat", "url")


@query
def frontier_date(spark, sf):
    day = F.col("o_orderdate").cast("date")
    ranges = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), day.alias("start_date"),
        F.when(F.col("o_orderkey") % 7 != 6, F.date_add(day, (F.col("o_orderkey") % 5 - 1).cast("int"))).alias("end_date"))
    searches = frontier.day_frontier(ranges, F.add_months("start_date", 1))
    return searches.select("k", _day("start_date").alias("day"), "page", "url")


@query
def frontier_next_page(spark, sf):
    counted = frontier.blocks_per_page(listing_data.fetched_pages(listing_data.listing(spark, sf)))
    days = counted.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("search_id").cast("int")))
    return frontier.next_pages(days, start="day", end="day")


@query
def blocks_per_page(spark, sf):
    pages = listing_data.crawled_pages(listing_data.listing(spark, sf))
    return frontier.blocks_per_page(pages).select("search_id", "page", "n_blocks")


@query
def gather_pages(spark, sf):
    rows = _blocks(spark, sf).select(
        "search_id", "page", "pos", html.company_name(html.paragraphs(F.col("block"))).alias("company_name"))
    return blocks.gather(stage(rows, "rows"))


@query
def lake_index(spark, sf):
    return frames.stored_index(spark, sf).select("vat", "publication_number")


# Blocks of a page


def _blocks(spark, sf):
    return blocks.page_blocks(listing_data.result_pages(listing_data.listing(spark, sf)))


@query
def html_blocks(spark, sf):
    return _blocks(spark, sf).select(
        "search_id", "page", "pos", F.regexp_replace("block", r"\s+$", "").alias("block"))


@query
def html_links(spark, sf):
    return _blocks(spark, sf).select(
        "search_id", "page", "pos", F.array_join(html.link_targets(F.col("block")), " ").alias("links"))


@query
def page_links(spark, sf):
    pages = spread(read_table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", F.array_join(html.link_targets(F.col("html"), inner_only=False), " ").alias("links"))


@query
def html_company_name(spark, sf):
    return _blocks(spark, sf).select(
        "search_id", "page", "pos", html.company_name(html.paragraphs(F.col("block"))).alias("company_name"))


@query
def html_juridical_form(spark, sf):
    return _blocks(spark, sf).select(
        "search_id", "page", "pos", html.juridical_form(html.paragraphs(F.col("block"))).alias("juridical_form"))


@query
def html_metadata(spark, sf):
    return _blocks(spark, sf).select(
        "search_id", "page", "pos", F.array_join(html.metadata(F.col("block")), "|").alias("meta"))


@query
def metadata_unpack(spark, sf):
    unpacked = fields.unpack_meta(F.col("meta"))
    return _parts(spark, sf).select("k", *[column.alias(name) for name, column in unpacked.items()])


@query
def no_results_filter(spark, sf):
    pages = read_table(spark, sf, "pages").select(
        "page_id", "url",
        F.when(F.col("page_id") % 2 == 1, F.lit(1)).alias("page"),
        F.when(F.col("page_id") % 7 < 3, F.concat("html", F.lit(fixed.NO_RESULTS_TEXT))).otherwise(
            F.col("html")).alias("html"))
    return pages.filter(html.has_results(F.col("html"), F.col("page"))).select("page_id", "url")


# Fields


@query
def pdf_link_first(spark, sf):
    return _parts(spark, sf).select("k", urls.first_pdf_url(F.col("urls")).alias("url"))


@query
def pdf_link_unique(spark, sf):
    return _parts(spark, sf).select(
        "k", urls.only_pdf(F.col("urls")).alias("pdf"), urls.has_several_pdfs(F.col("urls")).alias("multiple_pdf"))


@query
def pdf_url_absolute(spark, sf):
    return _parts(spark, sf).select("k", urls.absolute_url(urls.only_pdf(F.col("urls"))).alias("url"))


@query
def pubid(spark, sf):
    return _parts(spark, sf).select("k", urls.path_stem(urls.only_pdf(F.col("urls"))).alias("pubid"))


@query
def vat_clean(spark, sf):
    return _parts(spark, sf).select("k", fields.clean_vat(F.col("vat_raw")).alias("vat"))


@query
def vat_normalize(spark, sf):
    return _parts(spark, sf).select(
        "k", fields.normalize_vat(fields.clean_vat(F.col("vat_raw"))).alias("vat"),
        fields.normalize_vat(F.col("address")).alias("not_a_number"))


@query
def vat_effective(spark, sf):
    searched = F.when(F.col("k") % 3 == 0, F.lit("123456789"))
    page_vat = fields.clean_vat(F.col("vat_raw"))
    return _parts(spark, sf).select("k", fields.effective_vat(searched, page_vat).alias("vat"))


@query
def address_split(spark, sf):
    return _parts(spark, sf).select("k", fields.address_parts(F.col("address")).alias("a")).select("k", "a.*")


@query
def pub_date_number(spark, sf):
    return _parts(spark, sf).select("k", "pub_raw").select(
        "k", F.date_format(fields.publication_date(F.col("pub_raw")), "yyyy-MM-dd").alias("publication_date"),
        fields.publication_number(F.col("pub_raw")).alias("publication_number"))


@query
def pub_date_year_only(spark, sf):
    year = F.concat(F.substring("pub_raw", 1, 4), F.lit(" / "), F.col("k").cast("string"))
    return _parts(spark, sf).select(
        "k", F.date_format(fields.publication_date(year), "yyyy-MM-dd").alias("publication_date"),
        fields.publication_number(year).alias("publication_number"))


@query
def search_url(spark, sf):
    page = F.when(F.col("k") % 5 != 4, (F.col("k") % 5).cast("int"))
    return _parts(spark, sf).select(
        "k",
        urls.search_url(page, F.col("vat_raw"), None, None).alias("by_company"),
        urls.search_url(page, None, F.col("d"), F.date_add("d", 1)).alias("by_day"))


@query
def missing_pdf_url(spark, sf):
    searched = F.when(F.col("k") % 2 == 0, F.col("ck").cast("string"))
    published = fields.publication_date(F.col("pub_raw"))
    return _parts(spark, sf).select("k", urls.missing_pdf_url(searched, published).alias("url"))


@query
def pdf_store_path(spark, sf):
    return _parts(spark, sf).select("k", urls.store_path(urls.absolute_url(F.col("rel"))).alias("path"))


@query
def pdf_local_path(spark, sf):
    path = urls.store_path(urls.absolute_url(F.col("rel")))
    return _parts(spark, sf).select("k", urls.local_path("/data/pdfs", path).alias("path"))


@query
def publication_meta(spark, sf):
    record = fields.record(**{name: F.col(name) for name in fields.PUBLICATION_FIELDS})
    return frames.typed_rows(spark, sf).select("search_id", "page", "pos", record.alias("r")).select(
        "search_id", "page", "pos", "r.*")


@query
def publication_json(spark, sf):
    record = fields.record(**{name: F.col(name) for name in fields.PUBLICATION_FIELDS})
    return frames.typed_rows(spark, sf).select("search_id", "page", "pos", fields.as_json(record).alias("json"))


@query
def lake_key(spark, sf):
    return frames.typed_rows(spark, sf).select(
        "search_id", "page", "pos",
        fields.lake_key(F.col("vat"), F.col("publication_date"), F.col("publication_number")).alias("blob_key"))


@query
def lake_tags(spark, sf):
    tags = fields.tags(F.col("vat"), F.col("publication_date"))
    return frames.typed_rows(spark, sf).select("search_id", "page", "pos", tags.alias("t")).select(
        "search_id", "page", "pos", F.col("t")["vat"].alias("vat"),
        F.col("t")["publication_date"].alias("publication_date"), F.col("t")["status"].alias("status"))


# Cut-off, rejects, joins


def _cut(spark, sf):
    limit = cutoff.threshold(F.col("start_date"), frames.RULES.default_threshold)
    return cutoff.with_cutoff(frames.typed_rows(spark, sf), limit, F.col("publication_date"))


@query
def date_cutoff(spark, sf):
    return _cut(spark, sf).filter("not below_cutoff").select("search_id", "page", "pos", "company_name")


@query
def cutoff_remaining(spark, sf):
    return cutoff.cutoff_remaining(_cut(spark, sf))


@query
def reject_no_pdf(spark, sf):
    rows = frames.typed_rows(spark, sf).filter("rel is null")
    return rows.select(
        "search_id", "page", "pos", "multiple_pdf",
        urls.missing_pdf_url(F.col("search_vat"), F.col("publication_date")).alias("detail"))


@query
def skip_stored(spark, sf):
    flagged = stored.with_stored(frames.typed_rows(spark, sf), frames.stored_index(spark, sf), ["search_id", "page", "pos"])
    return flagged.select("search_id", "page", "pos", "stored")


@query
def skip_stored_indexed(spark, sf):
    """``skip_stored`` by the index in buckets, written in two ingests."""
    out = new_folder(spark, "indexed")
    entries = stage(frames.stored_index(spark, sf), "entries")
    for seq, half in enumerate(("not endswith(blob_key, '0.json')", "endswith(blob_key, '0.json')")):
        write_entries(entries.filter(half), "index", out, seq)
    rows = stage(frames.typed_rows(spark, sf).select("search_id", "page", "pos", *stored.KEYS), "rows")
    index = entries_of(spark, "index", out, 2, rows)
    return stored.with_stored(rows, index, ["search_id", "page", "pos"]).select("search_id", "page", "pos", "stored")


@query
def incremental_anti(spark, sf):
    fresh = stored.not_stored(frames.typed_rows(spark, sf), frames.stored_index(spark, sf))
    return fresh.select("search_id", "page", "pos", "vat", "publication_number")


@query
def incremental_anti_prefix(spark, sf):
    short = F.when(F.length("company_name") % 2 == 0, F.substring("vat", 1, 6)).otherwise(F.col("vat"))
    rows = frames.typed_rows(spark, sf).select("search_id", "page", "pos", short.alias("vat"), "publication_number")
    return stored.not_stored_prefix(stage(rows, "rows"), frames.stored_index(spark, sf))


def _downloads(spark, sf):
    rows = frames.typed_rows(spark, sf)
    return rejects.with_download(rows, frames.fetched(spark, sf), ["search_id", "page", "pos"])


@query
def join_downloads(spark, sf):
    return _downloads(spark, sf).select("search_id", "page", "pos", "publication_link", "downloaded", "file_path")


@query
def reject_download(spark, sf):
    rows = _downloads(spark, sf).filter("rel is not null").select(
        "search_id", "page", "pos",
        rejects.download_reason(obey_robots=True).alias("obeying"),
        rejects.download_reason(obey_robots=False).alias("ignoring"))
    return rows.filter("ignoring = 'download_failed'")


@query
def reject_no_date(spark, sf):
    return frames.decided(spark, sf).filter("reject_reason = 'no_date'").select(
        "search_id", "page", "pos", rejects.detail().alias("detail"))


@query
def reject_missing_key(spark, sf):
    return frames.decided(spark, sf).filter("reject_reason = 'missing_key'").select(
        "search_id", "page", "pos", rejects.detail().alias("detail"))


@query
def reject_scan(spark, sf):
    return frames.placed(spark, sf, frames.RULES_NO_OCR)[0].filter("reject_reason is not null").select(
        "search_id", "page", "pos", "reject_reason", "publication_link")


@query
def reject_report(spark, sf):
    rules = frames.RULES_NO_OCR
    orders = listing_data.staged_orders(spark, sf)
    decided = frames.decided(spark, sf, rules, orders).select("page", "pos", "publication_link", "reject_reason")
    decided = stage(decided, "decided")
    extractions = frames.extractions(spark, sf, rules, orders)
    scans, _ = with_text_place(decided, replace(extractions, texts=extractions.texts.drop("text")), rules)
    early = decided.filter("reject_reason is not null").select("reject_reason")
    return reports.reject_report(early.unionAll(scans.select("reject_reason")))


# Page layout


def _kept(spark, sf):
    return layout.with_kept_lines(layout_data.layouts(spark, sf))


def _boxes(spark, sf):
    return layout.with_page_boxes(layout_data.layouts(spark, sf))


@query
def page_zip(spark, sf):
    zipped = layout.with_zipped_pages(layout_data.layouts(spark, sf), "pages", "geometry", "lines")
    return unnest(zipped, ["doc_id"], "zipped", "p", "page_idx").select(
        "doc_id", "page_idx", "p.ocr_width", "p.ocr_height", "p.width", "p.height",
        F.size("p.pieces").cast("bigint").alias("n_lines"))


@query
def polygon_bbox(spark, sf):
    pages = unnest(layout_data.layouts(spark, sf), ["doc_id"], "pages.lines", "lines", "page_idx")
    lines = unnest(pages, ["doc_id", "page_idx"], "lines", "line", "line_idx")
    return lines.select("doc_id", "page_idx", "line_idx", g.bounding_box(F.col("line")).alias("b")).select(
        "doc_id", "page_idx", "line_idx", "b.x0", "b.y0", "b.x1", "b.y1")


@query
def line_height_mode(spark, sf):
    return unnest(_boxes(spark, sf), ["doc_id"], "boxed").select("doc_id", "item.page_idx", "item.line_height")


@query
def crop_rect(spark, sf):
    return unnest(_boxes(spark, sf), ["doc_id"], "boxed").select("doc_id", "item.page_idx", "item.body.*")


@query
def scale_lines(spark, sf):
    lines = F.flatten(F.transform("boxed", lambda p: layout.page_lines(p, sort=False, crop=False)))
    return unnest(_boxes(spark, sf), ["doc_id"], lines).select(
        "doc_id", "item.page_idx", "item.content", "item.x0", "item.y0", "item.x1", "item.y1")


@query
def sort_lines(spark, sf):
    ordered = lambda p: F.struct(p["page_idx"].alias("page_idx"), g.reading_order(p["boxes"]).alias("lines"))
    pages = unnest(_boxes(spark, sf), ["doc_id"], F.transform("boxed", ordered), "page")
    return unnest(pages, ["doc_id", "page.page_idx"], "page.lines", "line", "rank").select(
        "doc_id", "page_idx", "rank", "line.content")


@query
def lines_in_crop(spark, sf):
    return unnest(_kept(spark, sf), ["doc_id"], "kept.line", "line").select("doc_id", "line.*").drop("line_height")


@query
def prev_line(spark, sf):
    return unnest(_kept(spark, sf), ["doc_id"], "kept", "k").select(
        "doc_id", "k.line.page_idx", "k.line.content", F.col("k.before.content").alias("before"),
        F.col("k.before.y0").alias("py0"), F.col("k.before.y1").alias("py1"))


@query
def same_line(spark, sf):
    marked = layout.with_same_line(_kept(spark, sf))
    return unnest(marked, ["doc_id"], "marked").select("doc_id", "item.page_idx", "item.content", "item.same_line")


@query
def text_assemble(spark, sf):
    """The joining rule on its own: every second piece of a document shares the height of the one before."""
    documents = spread(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    pieces = F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(
        t.alias("content"), (i % 2 == 1).alias("same_line")))
    return documents.select(F.col("doc_id"), pieces.alias("_p")).select("doc_id", g.join_lines(F.col("_p")).alias("text"))


@query
def text_digital(spark, sf):
    return layout_data.layouts(spark, sf).select("doc_id", layout.digital_text(F.col("page_texts")).alias("text"))


@query
def text_scan(spark, sf):
    return layout.with_scan_text(layout_data.layouts(spark, sf), "text").select("doc_id", "text")


@query
def text_scan_pages(spark, sf):
    """``text_scan`` from one row per page."""
    documents = layout_data.layouts(spark, sf)
    texts = layout.scan_text_of_pages(layout.page_rows(documents, ["doc_id"]))
    return documents.select("doc_id").join(texts, "doc_id", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


@query
def text_scan_plain(spark, sf):
    return layout.with_scan_text(layout_data.layouts(spark, sf), "text", sort=False, tabs=False).select("doc_id", "text")


@query
def extract_text(spark, sf):
    return layout.with_text(layout_data.layouts(spark, sf)).select("doc_id", "text", "is_digital")


@query
def same_line_rects(spark, sf):
    return layout.same_height_boxes(layout_data.layouts(spark, sf))


@query
def word_boxes(spark, sf):
    return layout.word_boxes(layout_data.layouts(spark, sf, words=True))


# Lake, reports, ingest


@query
def latest_by_key(spark, sf):
    first = stage(frames.plain_records(spark, sf).select("blob_key", "pubid", "text", "ingest_seq"), "first")
    again = first.filter("cast(pubid as bigint) % 4 = 0").withColumns({
        "text": F.concat("text", F.lit(", again")), "ingest_seq": F.lit(2).cast("bigint")})
    return lake.latest(first.unionAll(again)).select("blob_key", "text", "ingest_seq")


@query
def select_by_tag(spark, sf):
    first = stage(frames.plain_records(spark, sf), "first")
    done = sinks.mark_status(first.filter("cast(pubid as bigint) % 3 = 0"), "summarized", 2)
    return lake.select_by_tag(first.unionAll(done)).select("blob_key", "vat", "publication_date", "status")


def _written_twice(spark, sf):
    """Keys of records, every fourth one rewritten with another status."""
    first = stage(frames.plain_records(spark, sf).select("blob_key", "vat", "pubid", "publication_number", "status", "ingest_seq"), "first")
    return first.unionAll(sinks.mark_status(first.filter("cast(pubid as bigint) % 4 = 0"), "summarized", 2))


@query
def lake_counts(spark, sf):
    return lake.lake_counts(_written_twice(spark, sf).select("blob_key", "vat"))


@query
def lake_counts_kept(spark, sf):
    """``lake_counts`` as the sum of what three ingests report, the later ones rewriting keys of the earlier."""
    out = new_folder(spark, "kept")
    records = stage(frames.plain_records(spark, sf).select("pubid", *ENTRY), "records")
    turn = F.col("pubid").cast("bigint") % 3
    for seq in range(3):
        written = records.filter((turn == seq) | ((turn < seq) & F.col("pubid").endswith("7")))
        record_rewrites(spark, out, seq, stage(written, "written"))
    return kept_counts(spark, out)


@query
def compact_months(spark, sf):
    """All rows of a lake, after a second ingest rewrote some records of March and the months in two ingests were merged."""
    path = new_folder(spark, "months")
    first = stage(frames.plain_records(spark, sf), "first")
    sinks.write_lake(first, path, 1)
    again = first.filter("pub_month = 3 and cast(pubid as bigint) % 5 = 0")
    sinks.write_lake(sinks.mark_status(again, "summarized", 2), path, 2)
    compaction.compact_months(spark, path)
    return landed.read_lake(spark, path).select("blob_key", "status", "text", "ingest_seq")


def _added(spark, sf):
    """Records of a run, some of them written twice."""
    records = stage(frames.plain_records(spark, sf).select("blob_key", "vat"), "added")
    return records.unionAll(records.filter("substr(vat, -1) = '7'"))


@query
def new_companies(spark, sf):
    return stored.new_companies(frames.stored_index(spark, sf), _added(spark, sf))


@query
def run_report(spark, sf):
    return reports.run_report(frames.stored_index(spark, sf), _added(spark, sf), "run-1")


@query
def publications(spark, sf):
    return frames.published(spark, sf)


@query
def stream_ingest(spark, sf):
    out = new_folder(spark, "stream")
    with cleared_stages(spark):
        orders = listing_data.staged_orders(spark, sf)
        _land(listing_data.crawled_pages(listing_data.listing(spark, sf, orders)), out)
        _ingest(spark, sf, out, frames.extractions(spark, sf, orders=orders), orders)
    return _ingested(spark, out)


def _land(pages, out):
    with cleared_shuffles(pages.sparkSession):
        pages.write.mode("append").parquet(f"{out}/pages")


def _ingest(spark, sf, out, texts, orders):
    run = ingest_stream(spark, f"{out}/pages", frames.fetched(spark, sf, orders), texts, f"{out}/tables", frames.RULES)
    run.awaitTermination()
    if run.exception():
        raise run.exception()


def _ingested(spark, out):
    return lake.latest(landed.read_lake(spark, f"{out}/tables/lake")).select(
        "blob_key", "pubid", "company_juridical_form", "zipcode", "text", "is_digital", "ingest_seq", "pub_year", "pub_month")


@query
def unfinished_searches(spark, sf):
    """Searches that cannot be decided in the middle of a crawl."""
    cut = stage(cut_pages(listing_data.fetched_pages(listing_data.listing(spark, sf))).drop("blocks"), "cut")
    return find_unfinished(cut).select("search_id", "last_page", "n_pages")


@query
def ingest_late_text(spark, sf):
    """Texts of every other document land after the pages' run."""
    out = new_folder(spark, "late")
    with cleared_stages(spark):
        orders = listing_data.staged_orders(spark, sf)
        _land(listing_data.crawled_pages(listing_data.listing(spark, sf, orders)), out)
        pdfs = listing_data.pdf_documents(listing_data.listing_rows(spark, sf, orders)).filter("cast(doc_id as bigint) % 2 = 0")
        texts = frames.extractions(spark, sf, orders=orders).staged()
        _ingest(spark, sf, out, replace(texts, links=texts.links.join(pdfs.select("publication_link"), "publication_link", "left_semi")), orders)
        _ingest(spark, sf, out, texts, orders)
    return _ingested(spark, out)


@query
def ingest_unfinished_search(spark, sf):
    """Last pages of every other search land one run later."""
    out = new_folder(spark, "unfinished")
    with cleared_stages(spark):
        orders = listing_data.staged_orders(spark, sf)
        whole = stage(listing_data.crawled_pages(listing_data.listing(spark, sf, orders)), "whole")
        late = stage(listing_data.late_pages(whole), "late")
        texts = frames.extractions(spark, sf, orders=orders).staged()
        _land(whole.join(late, ["search_id", "page"], "left_anti"), out)
        _ingest(spark, sf, out, texts, orders)
        _land(whole.join(late, ["search_id", "page"], "left_semi"), out)
        _ingest(spark, sf, out, texts, orders)
    return _ingested(spark, out)


# Prompts


@query
def prompt_table(spark, sf):
    return prompts.prompt_table(frames.published(spark, sf)).select(
        "blob_key", F.array_join("messages.role", ",").alias("roles"),
        F.get("messages.content", F.lit(0)).alias("instructions"),
        F.get("messages.content", F.lit(1)).alias("question"))


def stand_in(messages: list[dict]) -> str:
    """A completion function for tests: says how much it was given."""
    return f"{len(messages)} messages, {len(messages[-1]['content'])} characters"


@query
def complete_with(spark, sf):
    return prompts.complete_with(prompts.prompt_table(frames.published(spark, sf)), stand_in)


@query
def summaries(spark, sf):
    published = frames.published(spark, sf)
    done = prompts.complete_with(prompts.prompt_table(published), stand_in)
    return prompts.summaries(published, done).select("blob_key", "company_name", "summary")


@query
def summarize(spark, sf):
    """Two runs over a lake; the second finds nothing left to ask."""
    out = new_folder(spark, "summarize")
    with cleared_stages(spark):
        sinks.write_lake(frames.published(spark, sf), f"{out}/lake", 1, dealt=True)
    for _ in range(2):
        summarizing.run(spark, out, stand_in)
    return summarizing.summarized(spark, out).select("blob_key", "status", "summary")
