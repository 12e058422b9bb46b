"""From result pages to typed publication rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette_lake.functions import fields, html, urls
from gazette_lake.operators.cutoff import segment
from gazette_lake.operators.lookups import lookup
from gazette_lake.operators.unnest import unnest


def page_blocks(pages: DataFrame, **grammar) -> DataFrame:
    """One row per block, ``pos`` counting from 1 on each page."""
    kept = pages.filter(html.has_results(F.col("html"), F.col("page")))
    others = [c for c in pages.columns if c not in ("html", "url", "page")]
    columns = [*others, F.coalesce("page", F.lit(1)).alias("page")]
    found = unnest(kept, columns, html.page_blocks(F.col("html"), **grammar), "block")
    return found.withColumn("pos", F.col("_index") + 1).drop("_index")


def gather(rows: DataFrame, name: str = "search_pos") -> DataFrame:
    """Rows of parsed pages, with the place of each among all blocks of its search, in page order.

    ``rows`` (search_id, page, pos and what was read from the block) should be a written table: pages are
    cut once, and their HTML is gone before anything is exchanged.  Blocks are not ranked.  A page's count
    of rows is added up along the search in two levels, over the segments before its own and over the
    pages of its segment, and put beside its rows.
    """
    counted = rows.groupBy("search_id", segment().alias("_segment"), "page").agg(F.count(F.lit(1)).alias("_n"))
    earlier = lambda window: F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    segments = counted.groupBy("search_id", "_segment").agg(F.sum("_n").alias("_n")).select(
        "search_id", "_segment", earlier(Window.partitionBy("search_id").orderBy("_segment")).alias("_above"))
    within = counted.withColumn("_inside", earlier(Window.partitionBy("search_id", "_segment").orderBy("page"))).drop("_n")
    before = within.join(segments, ["search_id", "_segment"]).select("search_id", "page", (F.col("_above") + F.col("_inside")).alias("_before"))
    return lookup(rows, before, ["search_id", "page"], ["pos"]).withColumn(name, F.col("_before") + F.col("pos")).drop("_before")


def block_parts(blocks: DataFrame) -> DataFrame:
    """Raw parts of a block in place of its HTML."""
    block, paragraphs = F.col("block"), F.col("_paragraphs")
    return blocks.withColumn("_paragraphs", html.paragraphs(block)).withColumns({
        "urls": html.link_targets(block),
        "company_name": html.company_name(paragraphs),
        "company_juridical_form": html.juridical_form(paragraphs),
        "meta": html.metadata(block),
    }).drop("block", "_paragraphs")


def typed_fields(parts: DataFrame, normalize: bool = True) -> DataFrame:
    """Typed fields of block parts.  Expects ``search_vat`` (null for a search by day).

    ``normalize`` stores company numbers without leading zeros, whichever search found
    them; without it a number read from a page keeps its zeros.  A text on a page that is no
    number is kept as it stands.
    """
    unpacked = parts.withColumns({
        f"_{name}": column for name, column in fields.unpack_meta(F.col("meta")).items()})
    page_vat = fields.clean_vat(F.col("_vat"))
    typed = unpacked.withColumns({
        "rel": urls.only_pdf(F.col("urls")),
        "multiple_pdf": urls.has_several_pdfs(F.col("urls")),
        "vat": fields.effective_vat(
            F.col("search_vat"), F.coalesce(fields.normalize_vat(page_vat), page_vat) if normalize else page_vat),
        "_place": fields.address_parts(F.col("_address")),
        "publication_date": fields.publication_date(F.col("_date_number")),
        "publication_number": fields.publication_number(F.col("_date_number")),
    })
    return typed.select(
        "search_id", "search_vat", "start_date", "page", "pos",
        "rel", "multiple_pdf", "vat",
        urls.path_stem(F.col("rel")).alias("pubid"),
        F.col("_act_description").alias("act_description"),
        "company_name", "company_juridical_form",
        F.col("_address").alias("address"), "_place.street", "_place.zipcode", "_place.city",
        "publication_date", "publication_number",
        urls.absolute_url(F.col("rel")).alias("publication_link"),
    )
