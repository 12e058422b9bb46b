"""Reading-order text from positioned lines, one document per row.

All steps are array expressions on the document's own row: the plan has no
exchange, and a document is never gathered from other rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake import fixed
from gazette_lake.functions import geometry as g
from gazette_lake.functions.text import let, previous
from gazette_lake.operators.unnest import unnest


def with_zipped_pages(documents: DataFrame, pages: str, geometry: str, part: str) -> DataFrame:
    """Adds ``zipped``: OCR pages beside pdf pages, by position, as far as both go.

    Only one part of a page (``lines`` or ``words``) is touched, so a Parquet scan
    reads just that one.
    """
    columns = {
        "ocr_width": F.col(pages)["width"], "ocr_height": F.col(pages)["height"],
        "pieces": F.col(pages)[part],
        "width": F.col(geometry)["width"], "height": F.col(geometry)["height"],
    }
    both = F.least(F.size(pages), F.size(geometry))
    split = documents.withColumns({**columns, "_both": both})
    zipped = F.slice(F.arrays_zip(*columns), F.lit(1), F.col("_both"))
    return split.withColumn("zipped", zipped).drop(*columns, "_both")


def with_page_boxes(documents: DataFrame, pages: str = "pages", geometry: str = "geometry",
                    first=fixed.FIRST_PAGE_BODY, later=fixed.LATER_PAGE_BODY, page_from: str | None = None) -> DataFrame:
    """Adds ``boxed``: per page its body, usual line height, scale and unscaled line boxes.

    ``page_from`` names the index of a row's first page, where a row holds part of a document.
    """

    def page(pair: Column, at: Column) -> Column:
        idx = at + F.col(page_from) if page_from else at
        boxes = F.transform(pair["pieces"], g.bounding_box)
        return F.struct(
            idx.alias("page_idx"),
            F.try_divide(pair["width"], pair["ocr_width"]).alias("by_x"),
            F.try_divide(pair["height"], pair["ocr_height"]).alias("by_y"),
            g.body_box(idx, pair["width"], pair["height"], first, later).alias("body"),
            boxes.alias("boxes"),
        )

    def with_height(page: Column) -> Column:
        return page.withField("line_height", g.usual_line_height(page["boxes"]) * page["by_y"])

    zipped = with_zipped_pages(documents, pages, geometry, "lines")
    boxed = zipped.withColumn("_boxed", F.transform("zipped", page))
    return boxed.withColumn("boxed", F.transform("_boxed", with_height)).drop("zipped", "_boxed")


def page_lines(page: Column, sort: bool = True, crop: bool = True) -> Column:
    """Lines of one ``boxed`` page in page units, ordered and cropped."""
    boxes = g.reading_order(page["boxes"]) if sort else page["boxes"]
    scaled = F.transform(boxes, lambda box: g.scale(box, page["by_x"], page["by_y"]))
    if crop:
        scaled = F.filter(scaled, lambda box: g.inside(box, page["body"]))
    return F.transform(scaled, lambda box: F.struct(
        page["page_idx"].alias("page_idx"), page["line_height"].alias("line_height"),
        box["content"].alias("content"),
        box["x0"].alias("x0"), box["y0"].alias("y0"), box["x1"].alias("x1"), box["y1"].alias("y1"),
    ))


def with_kept_lines(documents: DataFrame, sort: bool = True, crop: bool = True, **boxes) -> DataFrame:
    """Adds ``kept``: the document's lines, page after page, each beside the line ``before`` it.

    ``before`` is null on the first kept line of a page.
    """
    boxed = with_page_boxes(documents, **boxes)
    lines = boxed.withColumn("_lines", F.flatten(F.transform("boxed", lambda p: page_lines(p, sort, crop))))

    def beside(line: Column, before: Column) -> Column:
        same_page = before["page_idx"] == line["page_idx"]
        return F.struct(line.alias("line"), F.when(same_page, before).alias("before"))

    paired = F.zip_with("_lines", previous(F.col("_lines")), beside)
    return lines.withColumn("kept", paired).drop("_lines", "boxed")


def with_same_line(documents: DataFrame) -> DataFrame:
    """Adds ``marked``: struct(page_idx, content, same_line, line, before) per kept line."""
    return documents.withColumn("marked", F.transform("kept", lambda k: F.struct(
        k["line"]["page_idx"].alias("page_idx"),
        k["line"]["content"].alias("content"),
        g.share_height(k["before"], k["line"], k["line"]["line_height"]).alias("same_line"),
        k["line"].alias("line"), k["before"].alias("before"),
    )))


def _with_joined_lines(documents: DataFrame, sort: bool = True, tabs: bool = True, **boxes) -> DataFrame:
    """Adds ``_out``: content and same_line of the kept lines."""
    lines = with_kept_lines(documents, sort=sort, **boxes)

    def line(k: Column) -> Column:
        same = g.share_height(k["before"], k["line"], k["line"]["line_height"]) if tabs else F.lit(False)
        return F.struct(k["line"]["content"].alias("content"), same.alias("same_line"))

    return lines.withColumn("_out", F.transform("kept", line)).drop("kept")


def with_scan_text(documents: DataFrame, name: str = "scan_text", sort: bool = True,
                   tabs: bool = True, **boxes) -> DataFrame:
    """Adds the text of scanned pages.  ``sort=False, tabs=False`` keeps the OCR's own order."""
    lines = _with_joined_lines(documents, sort, tabs, **boxes)
    return lines.withColumn(name, F.coalesce(g.join_lines(F.col("_out")), F.lit(""))).drop("_out")


PAGES_PER_SEGMENT = 64


def page_rows(documents: DataFrame, keep: list[str], pages: str = "pages", geometry: str = "geometry") -> DataFrame:
    """One row per page: ``keep``, page_idx, page (OCR) and its place in the pdf, as far as both go."""
    both = F.slice(F.arrays_zip(F.col(pages).alias("page"), F.col(geometry).alias("geometry")), F.lit(1), F.least(F.size(pages), F.size(geometry)))
    return unnest(documents, keep, both, "_page", "page_idx").select(*keep, "page_idx", "_page.page", "_page.geometry")


def scan_text_of_pages(pages: DataFrame, sort: bool = True, tabs: bool = True, **boxes) -> DataFrame:
    """(doc_id, text) of scanned documents that come as rows of pages: doc_id, page_idx, page, geometry.

    The text is the one that ``with_scan_text`` gives a document in one row, but no task needs a document's
    layout.  A page is put together where it is, into a part that knows how it begins and ends
    (``geometry.line_part``); what is exchanged are parts.  Joining parts is associative, so those of a
    segment of pages are joined first and a document's segments then.  Documents without pages have no row.
    """
    single = pages.withColumns({"pages": F.array("page"), "geometry": F.array("geometry")}).drop("page")
    lines = _with_joined_lines(single, sort, tabs, page_from="page_idx", **boxes)
    parts = lines.select("doc_id", "page_idx", g.line_part(F.col("_out")).alias("part"))
    in_order = lambda place: F.transform(F.sort_array(F.collect_list(F.struct(place, "part"))), lambda x: x["part"])
    segments = parts.groupBy("doc_id", F.floor(F.col("page_idx") / PAGES_PER_SEGMENT).alias("_segment")).agg(in_order("page_idx").alias("_parts"))
    joined = segments.select("doc_id", "_segment", g.join_parts(F.col("_parts")).alias("part"))
    whole = joined.groupBy("doc_id").agg(in_order("_segment").alias("_parts"))
    return whole.select("doc_id", g.join_parts(F.col("_parts"))["text"].alias("text"))


def digital_text(page_texts: Column) -> Column:
    """Page texts one after the other, by the newline rule, without tabs."""
    lines = F.transform(page_texts, lambda t: F.struct(t.alias("content"), F.lit(False).alias("same_line")))
    return F.coalesce(let(lines, g.join_lines), F.lit(""))


def with_digital_page_texts(layouts: DataFrame, geometry: str = "geometry", name: str = "page_texts",
                            **boxes) -> DataFrame:
    """Adds page texts of a landed digital layout: lines inside the body, in their own order."""
    boxed = with_page_boxes(layouts, geometry=geometry, **boxes)
    text = lambda page: F.array_join(
        F.transform(page_lines(page, sort=False), lambda line: line["content"]), "\n")
    return boxed.withColumn(name, F.transform("boxed", text)).drop("boxed")


def with_text(documents: DataFrame, page_texts: str = "page_texts", ocr: bool = True, **boxes) -> DataFrame:
    """Adds ``text`` and ``is_digital``: digital text if there is any, else the scan's text.

    With ``ocr=False`` a scan has a null text.  Blank digital text counts as digital.
    """
    digital = documents.withColumn("_digital", digital_text(F.col(page_texts)))
    is_digital = F.col("_digital") != ""
    if not ocr:
        scans, scan = digital, F.lit(None).cast("string")
    else:
        # Digital documents give the scan path no pages, so no time is spent on them.
        scans = digital.withColumn("_pages", F.when(~is_digital, F.col("pages")))
        scans = with_scan_text(scans, name="_scan", pages="_pages", **boxes)
        scan = F.col("_scan")
    return (
        scans.withColumn("is_digital", is_digital)
        .withColumn("text", F.when(is_digital, F.col("_digital")).otherwise(scan))
        .drop("_digital", "_pages", "_scan")
    )


def same_height_boxes(documents: DataFrame, **boxes) -> DataFrame:
    """Rows (document columns, page_idx, content, x0, y0, x1, y1): a box around each pair of
    neighbouring lines of one height, in reading order and without cropping."""
    marked = with_same_line(with_kept_lines(documents, crop=False, **boxes))
    pairs = F.transform(F.filter("marked", lambda m: m["same_line"]), lambda m: F.struct(
        m["page_idx"].alias("page_idx"), m["content"].alias("content"),
        F.least(m["line"]["x0"], m["before"]["x0"]).alias("x0"),
        F.least(m["line"]["y0"], m["before"]["y0"]).alias("y0"),
        F.greatest(m["line"]["x1"], m["before"]["x1"]).alias("x1"),
        F.greatest(m["line"]["y1"], m["before"]["y1"]).alias("y1"),
    ))
    return unnest(marked, ["doc_id"], pairs).select("doc_id", "item.*")


def word_boxes(documents: DataFrame, pages: str = "pages", geometry: str = "geometry") -> DataFrame:
    """Rows (doc_id, word_idx, content, x0, y0, x1, y1): words of the first page, in page units,
    taken from polygon corners 0 and 2."""
    zipped = with_zipped_pages(documents, pages, geometry, "words")
    first = zipped.withColumn("_first", F.get("zipped", F.lit(0)))
    by_x = F.try_divide(F.col("_first.width"), F.col("_first.ocr_width"))
    by_y = F.try_divide(F.col("_first.height"), F.col("_first.ocr_height"))
    words = unnest(first, ["doc_id", by_x.alias("_by_x"), by_y.alias("_by_y")], "_first.pieces", "word", "word_idx")
    corner = lambda i: F.get(F.col("word.polygon"), F.lit(i))
    return words.select(
        "doc_id", "word_idx", F.col("word.content").alias("content"),
        (corner(0)["x"] * F.col("_by_x")).alias("x0"), (corner(0)["y"] * F.col("_by_y")).alias("y0"),
        (corner(2)["x"] * F.col("_by_x")).alias("x1"), (corner(2)["y"] * F.col("_by_y")).alias("y1"),
    )
