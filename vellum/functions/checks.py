"""Validity of values, and names, as Column expressions."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Types of files beside those that Python has registered.
MORE_TYPES = (
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.template",
    "application/vnd.openxmlformats-officedocument.presentationml.template",
    "application/vnd.openxmlformats-officedocument.presentationml.slideshow",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "text/asciidoc", "text/markdown", "text/csv", "audio/x-wav", "audio/wav", "audio/mp3",
)
MIMETYPES = tuple(sorted({*mimetypes.types_map.values(), *MORE_TYPES}))


def is_named(name: Column, kind: Column, value: Column) -> Column:
    """Whether an identifier's name is its type and value, in lower case, joined by #."""
    return name == F.concat_ws("#", F.lower(kind), F.lower(value))


def are_unique(values: Column) -> Column:
    return F.size(values) == F.size(F.array_distinct(values))


def moment(text: Column) -> Column:
    """A time in UTC; bare numbers are none."""
    return F.when(~text.rlike(r"^\s*-?[0-9.]+\s*$"), F.try_to_timestamp(text))


def is_place(longitude: Column, latitude: Column) -> Column:
    return longitude.between(-180, 180) & latitude.between(-90, 90)


def low_64_bits(hexadecimal: Column) -> Column:
    """The last 16 digits of a hash as an unsigned number."""
    return F.conv(F.right(F.concat(F.lit("0" * 16), hexadecimal), F.lit(16)), 16, 10).cast("decimal(20,0)")


def is_known_mimetype(mimetype: Column) -> Column:
    return F.coalesce(mimetype.isin(*MIMETYPES), F.lit(False))


def custom_fields(fields: Column) -> Column:
    """Fields of a map that are named by a namespace and two underscores."""
    return F.map_filter(fields, lambda name, _: name.rlike(r"^[^_].*?__.+"))


def metadata_fields(xml: Column) -> Column:
    """Elements with plain text as a map; of elements that repeat the first one counts."""
    pattern = r"<([A-Za-z]+:[A-Za-z]+)>([^<]*)</\1>"
    names = F.regexp_extract_all(xml, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(xml, F.lit(pattern), F.lit(2))
    pairs = F.arrays_zip(names.alias("k"), values.alias("v"))
    first = F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"], p["v"], i.alias("i"))), lambda p: F.array_position(names, p["k"]) == p["i"] + 1)
    return F.map_from_arrays(F.transform(first, lambda p: p["k"]), F.transform(first, lambda p: p["v"]))


def mixed_order(marker: Column) -> list[Column]:
    """Numbers first, by value; then letters, shorter ones first."""
    number = marker.rlike(r"^[0-9]+$")
    return [F.when(number, 0).otherwise(F.length(marker)), marker.try_cast("long"), marker]
