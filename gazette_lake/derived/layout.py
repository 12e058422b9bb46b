"""Page layouts derived from ``documents``: one row per document, nothing grouped.

A document's sentences become OCR lines, forty to a page, placed on the page by
arithmetic.  All coordinates are binary fractions, so heights compare exactly.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette_lake.schemas import OCR_PIECES
from gazette_lake.sources.tables import spread

LINES_PER_PAGE = 40

_POINT = "named_struct('x', cast({x} as double), 'y', cast({y} as double))"

_LINE = """
transform(slice(sentences, cast(p * 40 as int) + 1, 40), (content, j) -> struct(
  content,
  (j * 7) % 40 as slot,
  ((j * 7) % 40) % 5 = 1 as beside))
"""

_PLACED = """
transform({lines}, l -> struct(
  l.content as content,
  case when (l.slot + doc_no) % 11 = 0 then 0.5D else 1.5D + ((l.slot * 3 + doc_no) % 8) * 0.5D end as x0,
  case when (l.slot + doc_no) % 13 = 0 then 8.25D else 3.5D + ((l.slot * 3 + doc_no) % 8) * 0.5D end as x1,
  0.25D + (l.slot - case when l.beside then 1 else 0 end) * 0.2421875D
    + case when l.beside then 0.0078125D else 0D end as y0,
  case when (l.slot + doc_no) % 2 = 0 then 0.125D else 0.1875D end as h))
"""

_POLYGONS = """
transform({placed}, l -> struct(l.content as content, array(
  named_struct('x', l.x0, 'y', l.y0),
  named_struct('x', l.x1, 'y', l.y0 + 0.0078125D),
  named_struct('x', l.x1, 'y', l.y0 + l.h),
  named_struct('x', l.x0, 'y', l.y0 + l.h - 0.0078125D)) as polygon))
"""

_WORDS = """
flatten(transform({placed}, l -> transform(split(l.content, ' '), (w, i) -> struct(w as content, array(
  named_struct('x', l.x0 + i * 0.125D, 'y', l.y0),
  named_struct('x', l.x0 + i * 0.125D + 0.0625D, 'y', l.y0),
  named_struct('x', l.x0 + i * 0.125D + 0.0625D, 'y', l.y0 + l.h),
  named_struct('x', l.x0 + i * 0.125D, 'y', l.y0 + l.h)) as polygon))))
"""


_NO_WORDS = f"cast(array() as {OCR_PIECES})"


def layouts(spark: SparkSession, sf_dir: str, words: bool = False) -> DataFrame:
    """doc_id, doc_no, pages (OCR), geometry (pdf pages), page_texts (digital).

    Word boxes are made on request only: they are the larger part of a page.
    """
    documents = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id")
    sentences = documents.select(
        F.col("doc_id").alias("doc_no"),
        F.expr(r"filter(split(replace(text, '. ', '.\n'), '\n', -1), s -> s <> '')").alias("sentences"),
        F.expr(r"case when doc_id % 3 = 0 then transform(split(text, '\n', -1), s -> '') "
               r"else split(text, '\n', -1) end").alias("page_texts"),
    )
    counted = sentences.withColumn("n_pages", F.expr("cast(ceil(size(sentences) / 40) as int)"))
    numbered = counted.withColumn(
        "page_numbers", F.expr("case when n_pages > 0 then sequence(0, n_pages - 1) else array() end"))
    placed = numbered.withColumn("placed", F.expr(f"transform(page_numbers, p -> {_PLACED.format(lines=_LINE)})"))
    pages = F.expr(f"""
      transform(placed, page -> struct(8.5D as width, 10D as height,
        {_POLYGONS.format(placed='page')} as lines,
        {_WORDS.format(placed='page') if words else _NO_WORDS} as words))""")
    geometry = F.expr("""
      transform(slice(page_numbers, 1, n_pages - case when doc_no % 16 = 5 then 1 else 0 end), p -> struct(
        case when (doc_no + p) % 3 = 0 then 612D else 595D end as width,
        case when (doc_no + p) % 3 = 0 then 792D else 842D end as height))""")
    return placed.select(
        F.col("doc_no").cast("string").alias("doc_id"), "doc_no",
        pages.alias("pages"), geometry.alias("geometry"), "page_texts",
    )
