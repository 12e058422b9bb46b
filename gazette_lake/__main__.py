"""Jobs for spark-submit: which pages and pdfs to fetch, the scheduled ingest, compaction.

    python -m gazette_lake companies SEEDS OUT
    python -m gazette_lake days 2024-01-01 [2024-01-07] OUT
    python -m gazette_lake next PAGES OUT
    python -m gazette_lake pdfs TABLES MANIFEST ROOT OUT
    python -m gazette_lake compact LAKE OUT
    python -m gazette_lake compact-months LAKE
    python -m gazette_lake held TABLES OUT
    python -m gazette_lake counts TABLES OUT
    python -m gazette_lake summarize TABLES MODULE:FUNCTION [--tasks N] [--retry]
    python -m gazette_lake unanswered TABLES OUT
    python -m gazette_lake ingest PAGES FETCH_RESULTS DOCUMENTS OUT [--no-ocr] [--ignore-robots]

SEEDS and FETCH_RESULTS are Parquet tables in the schemas of ``schemas.py``.  DOCUMENTS has
one row per pdf: publication_link, doc_id, pages, geometry, page_texts.  The frontier jobs
write (search, page, url) tables for whatever fetches pages; ``pdfs`` lists the pdfs that rows of the ingest
tables wait for and that MANIFEST, a table of files below ROOT, does not have.  ``compact`` writes a new lake,
``compact-months`` merges in place the months that several ingests wrote.  ``held`` lists searches that wait for a
page, ``counts`` sums up the run reports.  ``summarize`` asks FUNCTION, which takes a list of messages and returns
a text, once for every unprocessed publication; ``unanswered`` lists those it was asked for in vain.
"""

import argparse
import importlib
from datetime import date

from pyspark.sql import functions as F

from gazette_lake import schemas
from gazette_lake.operators import frontier, layout, stored
from gazette_lake.plans import bookkeeping, summarize
from gazette_lake.plans.listing import Rules
from gazette_lake.session import build_session
from gazette_lake.sources.compaction import compact_months
from gazette_lake.sources.landed import read_lake, read_pages, read_pdf_manifest
from gazette_lake.sources.sinks import compact_lake
from gazette_lake.streaming.ingest import held_searches, ingest_stream, waiting_rows


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gazette_lake", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    companies = jobs.add_parser("companies")
    companies.add_argument("seeds")
    companies.add_argument("out")
    days = jobs.add_parser("days")
    days.add_argument("start", type=date.fromisoformat)
    days.add_argument("end", type=date.fromisoformat, nargs="?")
    days.add_argument("out")
    for job, names in (("next", ["pages", "out"]), ("pdfs", ["tables", "manifest", "root", "out"]), ("compact", ["lake", "out"])):
        parser_of = jobs.add_parser(job)
        for name in names:
            parser_of.add_argument(name)
    for job, names in (("compact-months", ["lake"]), ("held", ["tables", "out"]), ("counts", ["tables", "out"]), ("unanswered", ["tables", "out"])):
        parser_of = jobs.add_parser(job)
        for name in names:
            parser_of.add_argument(name)
    asking = jobs.add_parser("summarize")
    asking.add_argument("tables")
    asking.add_argument("function")
    asking.add_argument("--tasks", type=int)
    asking.add_argument("--retry", action="store_true")
    ingest = jobs.add_parser("ingest")
    for name in ("pages", "fetch_results", "documents", "out"):
        ingest.add_argument(name)
    ingest.add_argument("--no-ocr", action="store_true")
    ingest.add_argument("--ignore-robots", action="store_true")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = build_session()
    if args.job == "companies":
        seeds = spark.read.schema(schemas.SEEDS).parquet(args.seeds)
        frontier.company_frontier(seeds).write.parquet(args.out)
    elif args.job == "days":
        ranges = spark.range(1).select(
            F.lit(args.start).alias("start_date"), F.lit(args.end).cast("date").alias("end_date"))
        frontier.day_frontier(ranges).write.parquet(args.out)
    elif args.job == "next":
        counted = frontier.blocks_per_page(read_pages(spark, args.pages))
        days = counted.withColumn("day", F.when(F.col("search_vat").isNull(), F.col("start_date")))
        frontier.next_pages(days, "search_vat", "day", "day").write.parquet(args.out)
    elif args.job == "pdfs":
        waiting = stored.not_downloaded(waiting_rows(spark, args.tables), read_pdf_manifest(spark, args.manifest), args.root)
        waiting.select("publication_link").distinct().write.parquet(args.out)
    elif args.job == "compact":
        compact_lake(read_lake(spark, args.lake), args.out)
    elif args.job == "compact-months":
        compact_months(spark, args.lake)
    elif args.job == "held":
        held_searches(spark, args.tables).write.parquet(args.out)
    elif args.job == "counts":
        bookkeeping.lake_counts(spark, args.tables).write.parquet(args.out)
    elif args.job == "summarize":
        module, name = args.function.split(":")
        summarize.run(spark, args.tables, getattr(importlib.import_module(module), name), args.tasks, args.retry)
    elif args.job == "unanswered":
        summarize.unanswered(spark, args.tables).write.parquet(args.out)
    else:
        documents = spark.read.schema(schemas.DOCUMENTS).parquet(args.documents)
        texts = layout.with_text(documents, ocr=not args.no_ocr).select("publication_link", "text", "is_digital")
        fetched = spark.read.schema(schemas.FETCH_RESULTS).parquet(args.fetch_results)
        rules = Rules(ocr=not args.no_ocr, obey_robots=not args.ignore_robots)
        ingest_stream(spark, args.pages, fetched, texts, args.out, rules).awaitTermination()


if __name__ == "__main__":
    main()
