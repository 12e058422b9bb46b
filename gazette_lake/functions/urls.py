"""Links, search addresses and file paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette_lake import fixed
from gazette_lake.functions.text import let, null_if_empty


def pdf_links(urls: Column) -> Column:
    return F.filter(urls, lambda url: F.endswith(url, F.lit(fixed.PDF_SUFFIX)))


def only_pdf(urls: Column) -> Column:
    """The pdf link when there is exactly one."""
    return let(pdf_links(urls), lambda pdfs: F.when(F.size(pdfs) == 1, F.get(pdfs, F.lit(0))))


def has_several_pdfs(urls: Column) -> Column:
    return F.coalesce(F.size(pdf_links(urls)) > 1, F.lit(False))


def first_pdf_url(urls: Column, base: str = fixed.BASE_URL) -> Column:
    """Absolute address of the first pdf link, '' without one."""
    return F.coalesce(F.concat(F.lit(base), F.get(pdf_links(urls), F.lit(0))), F.lit(""))


def absolute_url(relative: Column, base: str = fixed.BASE_URL) -> Column:
    return F.concat(F.lit(base), relative)


def path_stem(path: Column) -> Column:
    """Last path part without its extension."""
    name = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    return null_if_empty(F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", ""))


def search_url(page: Column, vat: Column | None, start: Column | None, end: Column | None,
               base: str = fixed.BASE_URL) -> Column:
    """Address of a search: by company when ``vat`` is given, else by day range."""
    paged = F.coalesce(page != 0, F.lit(False))
    script = F.when(paged, F.concat(F.lit(base + fixed.PAGED_SEARCH), page.cast("string")))
    script = script.otherwise(F.lit(base + fixed.FIRST_SEARCH))
    if vat is not None:
        return F.concat(script, F.lit("&btw="), vat)
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    return F.concat(script, F.lit("&pdd="), day(start), F.lit("&pdf="), day(end))


def missing_pdf_url(search_vat: Column, published: Column, base: str = fixed.BASE_URL) -> Column:
    """Search that shows a block without a usable pdf link.  Without a company it says None."""
    day = F.coalesce(F.date_format(published, "yyyy-MM-dd"), F.lit(""))
    return F.concat(
        F.lit(base + fixed.MISSING_PDF_SEARCH), F.coalesce(search_vat, F.lit("None")),
        F.lit("&pdd="), day, F.lit("&pdf="), day,
    )


def store_path(url: Column) -> Column:
    """Where a downloaded pdf lives below the store: its URL path without the pdf folder."""
    return F.replace(F.try_parse_url(url, F.lit("PATH")), F.lit(fixed.PDF_FOLDER), F.lit(""))


def local_path(root: str, path: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(path, "^/+", ""))
