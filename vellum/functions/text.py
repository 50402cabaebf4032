"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks of the closed set that statutes use, and their plain ones.
MARKED = "áäâàãčçďéěëêèíîïĺľňñóôöőõŕřšťúůüűùûýÿž"
PLAIN = "aaaaaccdeeeeeiiillnnooooorrstuuuuuuyyz"
#: The codes that are bytes of the code page for Central Europe, 1250; all others are code points.
CENTRAL = (138, 140, 141, 142, 150, 154, 156, 157, 158, 159, 165, 169, 175, 179, 185, *range(188, 256))


def fold(text: Column) -> Column:
    """Lower case, marks dropped, white space collapsed: for matching."""
    plain = F.translate(F.lower(text), MARKED, PLAIN)
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches in order: struct(match, value of the group, position)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    lengths = lambda parts, n: F.aggregate(
        F.slice(parts, F.lit(1), n), F.lit(0), lambda total, part: total + F.length(part)
    )
    return F.transform(
        F.arrays_zip(found.alias("m"), value.alias("v")),
        lambda x, i: F.struct(
            x["m"].alias("match"), x["v"].alias("value"), (lengths(between, i + 1) + lengths(found, i)).alias("position")
        ),
    )


def decoded(text: Column) -> Column:
    """``/cN`` as the character of code N: by the code page for CENTRAL, else the code point's.

    Numbers that are no code point stay as they are.
    """
    table = F.create_map(*[F.lit(x) for n in CENTRAL for x in (n, bytes([n]).decode("cp1250"))])
    point = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    valid = lambda n: n.between(0, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    letter = lambda c, n: F.coalesce(
        F.element_at(table, n), F.when(valid(n), point(n)), F.concat(F.lit("/c"), c)
    )
    codes = F.regexp_extract_all(text, F.lit(r"/c(\d+)"), F.lit(1))
    parts = F.split(text, r"/c\d+", -1)
    tail = F.transform(codes, lambda c, i: F.concat(letter(c, c.try_cast("int")), F.element_at(parts, i + 2)))
    return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))


def join_tokens(tokens: Column) -> Column:
    """Tokens as running text: no space before lone marks and marks that close, nor after "("."""
    tight = r"^([.,;:)(?!»«]$|[.,;:)\]!?])"
    folded = F.aggregate(
        F.filter(F.transform(tokens, lambda t: F.trim(t)), lambda t: t != ""),
        F.lit(""),
        lambda text, t: F.when(text == "", t)
        .when(t.rlike(tight) | text.endswith("("), F.concat(text, t))
        .otherwise(F.concat(text, F.lit(" "), t)),
    )
    for wrong, right in (("120 )", "120)"), ("č. 1 .", "č. 1.")):
        folded = F.replace(folded, F.lit(wrong), F.lit(right))
    return F.regexp_replace(folded, r"\s+([,.])", "$1")


def html_escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


#: LaTeX's special characters and how they are written.
LATEX = {"\\": r"\textbackslash{}", "{": r"\{", "}": r"\}", "$": r"\$", "&": r"\&", "#": r"\#", "_": r"\_", "%": r"\%",
         "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


def latex_escaped(text: Column) -> Column:
    """Each special character once: characters are mapped one by one, so nothing is escaped twice."""
    table = F.create_map(*[F.lit(x) for pair in LATEX.items() for x in pair])
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")


def markdown_escaped(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(r"\_"))


def version_parts(version: Column) -> Column:
    """struct(major, minor, patch), null where it is no version."""
    pattern = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:[-+].*)?$"
    numbers = [F.regexp_extract(version, pattern, k).cast("int").alias(n) for k, n in ((1, "major"), (2, "minor"), (3, "patch"))]
    return F.when(version.rlike(pattern), F.struct(*numbers))


def compatible(version: Column, own: tuple[int, int, int]) -> Column:
    """Same major number, and no later minor one."""
    v = version_parts(version)
    return F.coalesce((v["major"] == own[0]) & (v["minor"] <= own[1]), F.lit(False))


def direction(text: Column) -> Column:
    """rtl where the first letter, or more than half of all characters, run from right to left."""
    kind = r"[\p{IsHebrew}\p{IsArabic}\p{IsSyriac}\p{IsThaana}]"
    rtl = text.rlike(f"^{kind}") | (F.regexp_count(text, F.lit(kind)) * 2 > F.length(text))
    return F.when(F.coalesce(rtl, F.lit(False)), "rtl").otherwise("ltr")


def line_number(text: Column, offset: Column) -> Column:
    return F.regexp_count(F.left(text, offset), F.lit("\n")) + 1


def sanitised(name: Column) -> Column:
    return F.translate(name, "/ ", "__")


def rounded(value: Column, digits: int | None) -> Column:
    """Halves to the even neighbour; without ``digits`` as it is."""
    return value if digits is None else F.bround(value, digits)


def tagged_html(tag: str, text: Column, attributes: dict[str, Column] | None = None) -> Column:
    """An HTML element with its text escaped and, for text from right to left, its direction."""
    given = [F.concat(F.lit(f' {k}="'), v, F.lit('"')) for k, v in (attributes or {}).items()]
    way = F.when(direction(text) == "rtl", ' dir="rtl"').otherwise("")
    return F.concat(F.lit(f"<{tag}"), *given, way, F.lit(">"), html_escaped(text), F.lit(f"</{tag}>"))


def relative_path(source: Column, target: Column) -> Column:
    """The way from one absolute path to another: up to where they part, then down; null for other paths."""
    parts = lambda path: F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    a, b = parts(source), parts(target)
    apart = F.filter(F.sequence(F.lit(0), F.least(F.size(a), F.size(b))), lambda k: ~F.coalesce(F.get(a, k) == F.get(b, k), F.lit(False)))
    n = F.element_at(apart, 1)
    up, down = F.array_repeat(F.lit(".."), F.size(a) - n), F.slice(b, n + 1, F.size(b))
    way = F.array_join(F.concat(up, down), "/")
    return F.when(source.startswith("/") & target.startswith("/"), F.when(way == "", ".").otherwise(way))
