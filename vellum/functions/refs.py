"""References, footnote marks and tables that are written into running text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.markers import extract
from vellum.functions.text import find_all

#: How references and tables in text are written.
REFERENCES = {
    "paragraph": r"§\s+(\d+[a-zA-Z]*)",
    "odsek": r"(?i)odsek\s+(\d+\.\d+|\d+|\(\d+\))",
    "pismeno": r"(?i)pismeno\s+([a-z]\)|\d+\.\d+\.[a-z])",
}
SUPERSCRIPT = "([¹²³⁴⁵⁶⁷⁸⁹⁰]+)"
HEADER = r"([A-ZÁÉÍÓÚÝŽŠČŤĎĽŇa-záéíóúýžščťďľň\s\*]+,?\s*\d+\s*=\s*[^.]+\.)"
ROW = r"(\d+,\s*\d+\s*=\s*[^.]+\.)"


def references(text: Column) -> Column:
    """struct(type, target, position) of all references, by type, then by position."""
    return F.concat(*[_typed(find_all(text, pattern, 1), kind) for kind, pattern in REFERENCES.items()])


def _typed(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(kind).alias("type"), F.regexp_replace(m["value"], r"^[()]+|[()]+$", "").alias("target"), m["position"].alias("position")
        ),
    )


def footnote_marks(text: Column) -> Column:
    """struct(marker, type, position): superscripts, [n], and (n) that follows no white space."""
    marked = lambda found, kind: F.transform(
        found, lambda m: F.struct(m["match"].alias("marker"), F.lit(kind).alias("type"), m["position"].alias("position"))
    )
    return F.concat(
        marked(find_all(text, SUPERSCRIPT), "superscript"),
        marked(find_all(text, r"\[(\d+)\]"), "bracket"),
        marked(find_all(text, r"(?<!\s)\((\d+)\)"), "parentheses"),
    )


def link_target(link: Column) -> Column:
    """struct(paragraph, odsek, pismeno) of a link such as #paragraf-47.odsek-1.pismeno-a."""
    return F.struct(
        extract(link, r"paragraf-([0-9a-zA-Z]+)").alias("paragraph"),
        extract(link, r"odsek-(\d+)").alias("odsek"),
        extract(link, r"pismeno-([a-z]+)").alias("pismeno"),
    )


def table_index(link: Column) -> Column:
    return extract(link, r"#/tables/.*?(\d+)$").try_cast("int")


def written_table(text: Column) -> Column:
    """struct(start, table, rest, headers, rows) of a table in running text, null without one.

    A table is a header "Words, n = value." and at least two rows "n, m = value." after it.
    """
    start = F.regexp_instr(text, F.lit(HEADER))
    tail = F.substring(text, start, F.length(text))
    rows = F.regexp_extract_all(tail, F.lit(ROW), F.lit(1))
    between = F.split(tail, ROW, -1)
    end = F.length(tail) - F.length(F.element_at(between, -1))
    table = F.substring(tail, F.lit(1), end)
    before = F.rtrim(F.substring(text, F.lit(1), start - 1))
    after = F.ltrim(F.substring(tail, end + 1, F.length(tail)))
    undotted = lambda xs: F.transform(xs, lambda x: F.regexp_replace(F.trim(x), r"\.$", ""))
    return F.when(
        (start > 0) & (F.size(rows) >= 2),
        F.struct(
            (start - 1).alias("start"),
            table.alias("table"),
            F.trim(F.concat_ws(" ", F.nullif(before, F.lit("")), F.nullif(after, F.lit("")))).alias("rest"),
            undotted(F.regexp_extract_all(table, F.lit(HEADER), F.lit(1))).alias("headers"),
            undotted(rows).alias("rows"),
        ),
    )
