"""Which searches and pages to fetch next."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.fixed import FULL_PAGE
from gazette_lake.functions.fields import normalize_vat
from gazette_lake.functions.html import page_blocks
from gazette_lake.functions.urls import search_url


def company_frontier(seeds: DataFrame) -> DataFrame:
    """One search per seed.  The first address carries the number as given; later pages
    and everything downstream use the normalized one."""
    nowhere = F.lit(None).cast("int")
    return seeds.select(
        "search_id",
        normalize_vat(F.col("vat")).alias("search_vat"),
        "start_date", "end_date",
        search_url(nowhere, F.col("vat"), None, None).alias("url"),
    )


def day_frontier(ranges: DataFrame, today: date | Column | None = None) -> DataFrame:
    """One search per day of each range, both ends included.  A missing end is today,
    a reversed range has no days.  The day names the search.  Other columns of a range are kept."""
    now = F.current_date() if today is None else today if isinstance(today, Column) else F.lit(today)
    last = F.coalesce(F.col("end_date"), now)
    days = F.sequence(F.col("start_date"), last, F.expr("interval 1 day"))
    others = [c for c in ranges.columns if c not in ("search_id", "start_date", "end_date")]
    searches = ranges.filter(F.col("start_date") <= last).select(*others, F.explode(days).alias("start_date"))
    return searches.select(
        *others, F.date_format("start_date", "yyyy-MM-dd").alias("search_id"), "start_date", F.col("start_date").alias("end_date"), F.lit(1).alias("page"),
        search_url(F.lit(1), None, F.col("start_date"), F.col("start_date")).alias("url"),
    )


def blocks_per_page(pages: DataFrame, **grammar) -> DataFrame:
    """Block count of every fetched page; an empty page counts 0.  No join: a page knows its blocks."""
    count = F.coalesce(F.size(page_blocks(F.col("html"), **grammar)), F.lit(0))
    others = [c for c in pages.columns if c != "html"]
    return pages.select(*others, count.cast("bigint").alias("n_blocks"))


def next_pages(counted: DataFrame, vat: str | None = None, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """(search_id, page, url) of pages to fetch next: a search goes on after a full last page.

    Only the last fetched page decides, so pages already fetched are not asked again.
    """
    page = F.coalesce("page", F.lit(1))
    carried = list(dict.fromkeys(c for c in (vat, start, end) if c))
    last = counted.groupBy("search_id").agg(
        F.max(page).alias("page"), F.max_by("n_blocks", page).alias("n_blocks"),
        *[F.max_by(c, page).alias(c) for c in carried])
    more = last.filter(F.col("n_blocks") == FULL_PAGE).withColumn("page", F.col("page") + 1)
    column = lambda c: F.col(c) if c else None
    return more.select("search_id", "page",
                       search_url(F.col("page"), column(vat), column(start), column(end)).alias("url"))
