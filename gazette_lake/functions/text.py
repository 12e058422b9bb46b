"""Small string helpers with the semantics the rest of the package relies on."""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette_lake.fixed import SPACES

_ENTITY = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends; a plain ``trim`` knows the space only."""
    return F.trim(text, F.lit(SPACES))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def is_missing(text: Column) -> Column:
    """Null and '' both count as absent."""
    return text.isNull() | (text == "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def after_first(items: Column) -> Column:
    """The array without its first element."""
    return F.slice(items, F.lit(2), F.size(items))


def previous(items: Column) -> Column:
    """The array moved one place to the right: each place holds its predecessor, the first null."""
    return F.slice(F.concat(F.array(F.lit(None)), items), F.lit(1), F.size(items))


def _code_point(number: Column) -> Column:
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def _decode_one(entity: Column) -> Column:
    body = F.regexp_extract(entity, "^&(.*);$", 1)
    names = F.from_json(
        F.lit("{" + ",".join(f'"{name}":{point}' for name, point in name2codepoint.items()) + "}"),
        "map<string,bigint>",
    )
    number = (  # any number of digits; what is too large for a whole number is no character
        F.when(body.rlike("^#[xX]"), F.conv(F.regexp_extract(body, "^#[xX]0*(.*)$", 1), 16, 10).try_cast("bigint"))
        .when(body.startswith("#"), F.regexp_extract(body, "^#(.*)$", 1).try_cast("bigint"))
        .otherwise(F.try_element_at(names, body))
    )
    return F.coalesce(_code_point(number), entity)


def decode_entities(text: Column) -> Column:
    """Replace HTML character references, each exactly once; unknown ones stay."""
    plain = F.split(text, _ENTITY, -1)
    found = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
    glued = F.zip_with(
        plain,
        F.transform(found, _decode_one),
        lambda before, mark: F.concat(before, F.coalesce(mark, F.lit(""))),
    )
    return F.when(text.contains("&"), F.array_join(glued, "")).otherwise(text)
