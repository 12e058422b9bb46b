"""Typed fields of one publication block.  Every function is a Column expression.

Each names its input once where it can.  Spark copies an expression into the filters it
pushes down, so inputs named many times would be worked out many times.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette_lake import fixed
from gazette_lake.functions.text import let, null_if_empty, strip
from gazette_lake.schemas import PUBLICATION_FIELDS

META_PARTS = ["address", "vat", "act_description", "date_number"]


def unpack_meta(meta: Column) -> dict[str, Column]:
    """Name the first four of 4 or 6 metadata strings; any other length names none."""
    part = lambda i: lambda texts: F.when(F.size(texts).isin(4, 6), F.get(texts, F.lit(i)))
    return {name: let(meta, part(i)) for i, name in enumerate(META_PARTS)}


def clean_vat(vat: Column) -> Column:
    """Company number without dots; absent stays absent."""
    return null_if_empty(strip(F.replace(vat, F.lit("."), F.lit(""))))


def normalize_vat(vat: Column) -> Column:
    """Company number as a whole number in text form: no leading zeros, null if not a number."""
    return null_if_empty(F.regexp_extract(strip(vat), "^0*([0-9]+)$", 1))


def effective_vat(search_vat: Column, page_vat: Column) -> Column:
    """A company search knows its company; otherwise the page tells."""
    return F.coalesce(search_vat, page_vat)


_BOUNDARY = "\uffff"  # not a character, so it is in no text


def address_parts(address: Column) -> Column:
    """struct(street, zipcode, city), split at the last four-digit group between white space."""
    marked = F.regexp_replace(address, fixed.ADDRESS_FORMAT, f"$1{_BOUNDARY}$2{_BOUNDARY}$3")
    part = lambda parts, i: F.when(F.size(parts) == 3, F.get(parts, F.lit(i)))
    return let(F.split(marked, _BOUNDARY, -1), lambda parts: F.struct(
        part(parts, 0).alias("street"), part(parts, 1).alias("zipcode"), part(parts, 2).alias("city")))


def publication_date(date_number: Column) -> Column:
    """Full date, else 1 January of a lone year; an impossible date is null."""
    full = F.regexp_replace(date_number, fixed.YEAR_FORMAT, "$1-01-01$2")
    return F.try_to_date(F.regexp_extract(full, fixed.FULL_DATE_FORMAT, 1), "yyyy-MM-dd")


def publication_number(date_number: Column) -> Column:
    """The number behind the date, in either format."""
    return null_if_empty(F.regexp_extract(date_number, fixed.NUMBER_FORMAT, 1))


def record(**fields: Column) -> Column:
    """The publication record: all fields as strings, in their fixed order."""
    return F.struct(*[fields[name].cast("string").alias(name) for name in PUBLICATION_FIELDS])


def lake_key(vat: Column, published: Column, number: Column) -> Column:
    """vat/yyyy/MM/dd/number.json; null when a part is null."""
    return F.concat(vat, F.date_format(published, "/yyyy/MM/dd/"), number, F.lit(".json"))


def tags(vat: Column, published: Column, status: str = fixed.UNPROCESSED) -> Column:
    return F.create_map(
        F.lit("vat"), vat,
        F.lit("publication_date"), F.date_format(published, "yyyy-MM-dd"),
        F.lit("status"), F.lit(status),
    )


def as_json(row: Column) -> Column:
    """JSON text with nulls kept."""
    return F.to_json(row, {"ignoreNullFields": "false"})
