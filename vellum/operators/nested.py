"""Whole documents from trees of items: lists in lists, inline groups, tables, pictures and captions.

A bottom-up fold: the deepest nodes are rendered first, and each node is put together from
what its children have become. A node gives an array of parts: a group, a list and an inline
group join their children's parts into one; any other text gives its own part and then its
children's, which thus stay parts of the group around. What a node must know about the nodes
above it, the number of lists and inline groups, is summed up along the paths beforehand.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.functions.render import LATEX_PREAMBLE, TAGS, latex_document, latex_escaped, latex_section
from vellum.functions.text import html_escaped, markdown_escaped
from vellum.operators import tables, trees
from vellum.session import written

#: Kinds of nodes that join their children's parts into one.
GROUPS = ("list", "inline", "group")
#: After so many levels of a fold its lineage is cut.
LEVELS = 8
PART = "struct<text: string, inline: boolean>"
#: Where the text of an inline group goes; no document holds it.
GAP = "\x00"


def folded(tree: DataFrame, assemble: Callable[[DataFrame], DataFrame], kind: str) -> DataFrame:
    """doc_id, node, ord, parts of the roots.

    tree: doc_id, node, parent, ord, depth and what ``assemble`` reads. It adds ``parts``, an array of ``kind``, to
    nodes that have ``kids``, their children's arrays one after the other in order. From the
    deepest level up, a level's nodes are joined with what the level below has become.
    """
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    none = F.array().cast(f"array<{kind}>")
    kids = None
    for depth in range(deepest, 0, -1):
        level = tree.filter(F.col("depth") == depth)
        level = level.withColumn("kids", none) if kids is None else _joined(level, kids, none)
        parts = assemble(level)
        ordered = F.sort_array(F.collect_list(F.struct("ord", "node", "parts")))
        kids = parts.groupBy("doc_id", F.col("parent").alias("above")).agg(F.flatten(F.transform(ordered, lambda x: x["parts"])).alias("kids"))
        kids = kids.withColumnRenamed("above", "node")
        if depth % LEVELS == 0:
            kids = written(kids, "level")
    top = tree.filter("depth = 0")
    top = top.withColumn("kids", none) if kids is None else _joined(top, kids, none)
    return assemble(top).select("doc_id", "node", "ord", "parts")


def _joined(level: DataFrame, kids: DataFrame, none: Column) -> DataFrame:
    return level.join(kids, ["doc_id", "node"], "left").withColumn("kids", F.coalesce("kids", none))


@dataclass(frozen=True)
class Form:
    """How one format renders a node, and puts parts together.

    ``own`` has a node's own text, ``wrap`` what a list item becomes with its children inside (null: they
    follow it), ``listed``, ``inline`` and ``grouped`` a group from its parts, ``document`` the whole.
    """

    own: Callable[[], Column]
    listed: Callable[[Column], Column]
    inline: Callable[[Column], Column]
    grouped: Callable[[Column], Column]
    document: Callable[[Column], Column]
    item: Callable[[Column, Column], Column] | None = None


def _texts(parts: Column) -> Column:
    return F.transform(parts, lambda p: p["text"])


def _c(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _wrapped(text: Column, before: Column | str, after: Column | str) -> Column:
    return F.when(text == "", "").otherwise(_c(before, text, after))


# Markdown


def item_lead(marker: Column, place: Column, enumerated: Column) -> Column:
    """What stands before a list item's text in Markdown.

    Its own marker where that is one of Markdown's; else a dash, or its number in a list that begins enumerated and whose
    item has no marker; behind it the own marker where that holds a letter or a digit.
    """
    marker = F.coalesce(marker, F.lit(""))
    valid = marker.rlike(r"^([-*+]|\d+\.)$")
    lead = F.when(enumerated & (marker == ""), _c((place + 1).cast("string"), ".")).otherwise("-")
    return F.when(valid, marker).when(marker.rlike("[a-zA-Z0-9]"), F.concat_ws(" ", lead, marker)).otherwise(lead)


def _around(text: Column, pairs: list[tuple[Column, Column | str, Column | str]]) -> Column:
    """``text`` between the marks of those pairs whose condition holds; the first pair is innermost."""
    some = lambda condition, mark: F.when(condition, mark).otherwise("")
    before, after = [some(c, a) for c, a, _ in reversed(pairs)], [some(c, b) for c, _, b in pairs]
    return _c(*before, text, *after)


def _styles(bold: tuple[str, str], italic: tuple[str, str], link: tuple[Column | str, Column | str]) -> list[tuple]:
    there = F.col("said") != ""
    return [(F.col("bold") & there, *bold), (F.col("italic") & there, *italic), (F.col("link").isNotNull() & there, *link)]


def _markdown(indent: int, placeholder: str) -> Form:
    label, inside = F.col("label"), F.col("inlines") > 0

    def own() -> Column:
        raw, caption = F.col("said"), F.col("caption")
        # What an inline group has become is finished text.
        literal = F.col("given") | label.isin("code", "formula")
        escaped = F.when(literal, raw).otherwise(html_escaped(markdown_escaped(raw)))
        plain = ~label.isin("code", "formula")
        styled = _around(escaped, [(c & plain, x, y) for c, x, y in _styles(("**", "**"), ("*", "*"), ("[", _c("](", F.col("link"), ")")))])
        short = inside | F.col("link").isNotNull()
        dollars = F.when(raw == "", "").when(inside, "$").otherwise("$$")
        before = (
            F.when(label == "title", "# ")
            .when(label == "section_header", _c(F.repeat(F.lit("#"), F.col("level") + 1), " "))
            .when(label == "list_item", _c(item_lead(F.col("marker"), F.col("place"), F.col("enumerates")), " "))
            .when(label == "checkbox_selected", "- [x] ")
            .when(label == "checkbox_unselected", "- [ ] ")
            .when(label == "code", F.when(short, "`").otherwise("```\n"))
            .when(label == "formula", dollars)
            .otherwise("")
        )
        after = F.when(label == "code", F.when(short, "`").otherwise("\n```")).when(label == "formula", dollars).otherwise("")
        floating = F.when(F.col("kind") == "picture", placeholder).otherwise(F.coalesce("body", F.lit("")))
        both = F.array_join(F.filter(F.array(html_escaped(markdown_escaped(caption)), floating), lambda x: x != ""), "\n\n")
        return F.when(F.col("kind").isin("table", "picture"), both).otherwise(_c(before, styled, after))

    def listed(parts: Column) -> Column:
        lead = F.repeat(F.lit(" "), F.col("lists") * indent)

        def line(p: Column, i: Column) -> Column:
            # An inline group goes on the line before; lists inside are indented already.
            start = F.when(p["text"].startswith(" "), p["text"]).otherwise(_c(lead, p["text"]))
            return F.when(i == 0, start).when(p["inline"], p["text"]).otherwise(_c("\n", start))

        return F.array_join(F.transform(parts, line), "")

    return Form(
        own=own, listed=listed, inline=lambda parts: F.array_join(_texts(parts), " "),
        grouped=lambda parts: F.array_join(_texts(parts), "\n\n"), document=lambda parts: F.array_join(_texts(parts), "\n\n"),
    )


# HTML


def _html() -> Form:
    label, inside = F.col("label"), F.col("inlines") > 0

    def quoted(text: Column) -> Column:
        return F.replace(F.replace(html_escaped(text), F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#x27;"))

    def own() -> Column:
        raw = F.col("said")
        text = F.when(F.col("given") | label.isin("code", "formula"), raw).otherwise(F.replace(html_escaped(raw), F.lit("\n"), F.lit("<br>")))
        level = F.when(label == "title", F.lit(1)).otherwise(F.least(F.col("level") + 1, F.lit(6))).cast("string")
        heading = label.isin("title", "section_header")
        paragraph = ~inside & ~heading & ~label.isin("code", "formula", "list_item")
        tags = [
            (heading, _c("<h", level, ">"), _c("</h", level, ">")),
            (label.isin("code", "formula") & (inside | (label == "code")), "<code>", "</code>"),
            (label.isin("code", "formula") & ~inside, "<pre>", "</pre>"),
            (paragraph, "<p>", "</p>"),
        ]
        styles = _styles(("<strong>", "</strong>"), ("<em>", "</em>"), (_c('<a href="', F.col("link"), '">'), "</a>"))
        text = _around(text, [*tags, *((c & ~F.col("given"), x, y) for c, x, y in styles)])
        caption = _wrapped(quoted(F.col("caption")), '<div class="caption">', "</div>")
        body = F.coalesce("body", F.lit(""))
        table = _wrapped(_c(_wrapped(caption, "<caption>", "</caption>"), _wrapped(body, "<tbody>", "</tbody>")), "<table>", "</table>")
        picture = _wrapped(_wrapped(caption, "<figcaption>", "</figcaption>"), "<figure>", "</figure>")
        return F.when(F.col("kind") == "table", table).when(F.col("kind") == "picture", picture).otherwise(text)

    def item(text: Column, kids: Column) -> Column:
        # Lists inside an item stand within it, each on lines of its own.
        text = F.when(F.col("given"), _c("\n", text, "\n")).otherwise(text)
        whole = F.array_join(F.filter(F.concat(F.array(text), _texts(kids)), lambda x: x != ""), "\n")
        whole = F.when(F.size(kids) > 0, _c("\n", whole, "\n")).otherwise(whole)
        style = F.when(F.coalesce("marker", F.lit("")) == "", "").otherwise(_c(' style="list-style-type: \'', html_escaped(F.col("marker")), " ';\""))
        return _wrapped(whole, _c("<li", style, ">"), "</li>")

    def listed(parts: Column) -> Column:
        tag = F.when(F.col("starts_enumerated"), "ol").otherwise("ul")
        return _wrapped(F.array_join(_texts(parts), "\n"), _c("<", tag, ">\n"), _c("\n</", tag, ">"))

    return Form(
        own=own, item=item, listed=listed,
        inline=lambda parts: _wrapped(F.array_join(_texts(parts), " "), "<span class='inline-group'>", "</span>"),
        grouped=lambda parts: F.array_join(_texts(parts), "\n"),
        document=lambda parts: _c("<!DOCTYPE html>\n<html>\n<body>\n<div class='page'>\n", F.array_join(_texts(parts), "\n"), "\n</div>\n</body>\n</html>"),
    )


# Location-tagged markup


def _tags() -> Form:
    label = F.col("label")
    names = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])

    def own() -> Column:
        where = F.when(F.col("inlines") > 0, "").otherwise(F.coalesce("location", F.lit("")))
        language = F.when(label == "code", _c("<_", F.coalesce("marker", F.lit("unknown")), "_>")).otherwise("")
        trimmed = F.when(label == "code", F.col("said")).otherwise(F.regexp_replace("said", r"(?U)^\s+|\s+$", ""))
        heading = _c("section_header_level_", F.col("level").cast("string"))
        tag = F.when(label == "section_header", heading).otherwise(F.coalesce(F.element_at(names, label), F.lit("text")))
        inner = _c(where, language, trimmed)
        text = F.when(label == "list_item", inner).otherwise(_c("<", tag, ">", inner, "</", tag, ">"))
        caption = _wrapped(F.col("caption"), "<caption>", "</caption>")
        floating = _c(where, F.coalesce("body", F.lit("")), caption)
        table, picture = _wrapped(floating, "<otsl>", "</otsl>"), _wrapped(floating, "<picture>", "</picture>")
        return F.when(F.col("kind") == "table", table).when(F.col("kind") == "picture", picture).otherwise(text)

    def listed(parts: Column) -> Column:
        tag = F.when(F.col("starts_enumerated"), "ordered_list").otherwise("unordered_list")
        lines = F.transform(_texts(parts), lambda x: _c("<list_item>", x, "</list_item>"))
        return _wrapped(F.array_join(lines, "\n"), _c("<", tag, ">"), _c("\n</", tag, ">"))

    return Form(
        own=own, listed=listed, inline=lambda parts: _wrapped(F.array_join(_texts(parts), "\n"), "<inline>", "\n</inline>"),
        grouped=lambda parts: F.array_join(_texts(parts), "\n"),
        document=lambda parts: _c("<doctag>", F.array_join(_texts(parts), "\n"), "\n</doctag>"),
    )


# LaTeX


def _latex(indent: int, placeholder: str, preamble: tuple[str, ...]) -> Form:
    label, inside = F.col("label"), F.col("inlines") > 0

    def floating(environment: str, *lines: Column | str) -> Column:
        every = [F.lit(x) if isinstance(x, str) else x for x in (f"\\begin{{{environment}}}[h]", *lines, f"\\end{{{environment}}}")]
        return F.array_join(F.filter(F.array(*every), lambda x: x != ""), "\n")

    def own() -> Column:
        raw, plain = F.col("said"), ~label.isin("code", "formula") & ~F.col("given")
        link = _c("\\href{", latex_escaped(F.col("link")), "}{")
        styles = _styles(("\\textbf{", "}"), ("\\textit{", "}"), (link, "}"))
        text = _around(F.when(plain, latex_escaped(raw)).otherwise(raw), [(c & plain, x, y) for c, x, y in styles])
        # In running code the mark of parameters alone is escaped.
        code = _c("\\texttt{", F.replace(raw, F.lit("#"), F.lit("\\\\#")), "}")
        code = F.when(inside, code).otherwise(_c("\\begin{verbatim}\n", raw, "\n\\end{verbatim}"))
        dollars = F.when(inside, "$").otherwise("$$")
        said = (
            F.when(label == "title", _c("\\title{", text, "}"))
            .when(label == "section_header", _c("\\", latex_section(F.col("level")), "{", text, "}"))
            .when(label == "list_item", _c("\\item ", text))
            .when(label == "code", code)
            .when(label == "formula", _wrapped(raw, dollars, dollars))
            .otherwise(text)
        )
        caption, body = _wrapped(latex_escaped(F.col("caption")), "\\caption{", "}"), F.coalesce("body", F.lit(""))
        tabled = F.when((caption == "") & (body == ""), "").otherwise(floating("table", caption, body))
        return F.when(F.col("kind") == "table", tabled).when(F.col("kind") == "picture", floating("figure", placeholder, caption)).otherwise(said)

    def listed(parts: Column) -> Column:
        lead, tag = F.repeat(F.lit(" "), F.col("lists") * indent), F.when(F.col("starts_enumerated"), "enumerate").otherwise("itemize")
        return _wrapped(F.array_join(_texts(parts), "\n"), _c(lead, "\\begin{", tag, "}\n"), _c("\n", lead, "\\end{", tag, "}"))

    return Form(
        own=own, listed=listed, inline=lambda parts: F.array_join(_texts(parts), " "),
        grouped=lambda parts: F.array_join(_texts(parts), "\n\n"),
        document=lambda parts: latex_document(F.array_join(_texts(parts), "\n\n"), preamble),
    )


#: How the cells of a table become its body.
_BODIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "markdown": lambda cells: tables.as_markdown(tables.densified(cells.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" "))))),
    "html": tables.html_rows,
    "tags": tables.as_tokens,
    "latex": tables.as_latex,
}
#: What an item has where its column lacks.
_DEFAULTS = {"level": "1", "marker": "cast(null AS string)", "enumerated": "false", "bold": "false", "italic": "false",
             "link": "cast(null AS string)", "location": "cast(null AS string)", "caption_of": "cast(null AS string)"}


def document(
    items: DataFrame, form: str, *, cells: DataFrame | None = None, indent: int | None = None, placeholder: str | None = None,
    preamble: tuple[str, ...] = LATEX_PREAMBLE, spans: bool = False,
) -> DataFrame:
    """doc_id and the rendered text of each document's tree, as "markdown", "html", "tags" or "latex".

    Lists indent by 4 in Markdown and by 2 in LaTeX, where ``preamble`` stands before the document, and where ``spans`` lets
    cells stand once, across their rows and columns (its package is then added).

    items: doc_id, node, parent, ord, kind (text, list, inline, group, table or picture), label, text; and,
    where they are there, level, marker (of code: its language), enumerated, bold, italic, link, location and ``caption_of``, the table or
    picture whose caption a text is. ``cells`` has the tables' cells, with doc_id, and the table's node as table_id.

    Captions stand at their table or picture only. An empty text whose only child is an inline group is
    rendered by it. Other children of tables and pictures aren't rendered. Null texts are empty, and empty parts
    are left out. Nodes that reach no root are left out; documents without nodes give no row.
    """
    if spans and form == "latex":
        preamble = (*preamble, "\\usepackage{multirow}")
    rules = {
        "markdown": lambda: _markdown(4 if indent is None else indent, "<!-- image -->" if placeholder is None else placeholder),
        "latex": lambda: _latex(2 if indent is None else indent, "% image" if placeholder is None else placeholder, preamble),
        "html": _html, "tags": _tags,
    }[form]()
    rows = items.withColumns({name: F.expr(value) for name, value in _DEFAULTS.items() if name not in items.columns})
    captions = rows.filter("caption_of IS NOT NULL").groupBy("doc_id", F.col("caption_of").alias("node"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("ord", "node", "text"))), lambda x: x["text"])
    captions = captions.agg(F.array_join(texts, " ").alias("caption"))
    rows = rows.filter("caption_of IS NULL")
    floats = F.col("kind").isin("table", "picture").cast("int")
    above = trees.paths(rows, {"lists": F.col("kind") == "list", "inlines": F.col("kind") == "inline", "floats": floats})
    tree = rows.drop("parent").join(above.drop("path"), ["doc_id", "node"]).filter("floats = 0")
    # Places among siblings; what the list above and the only child are.
    order = W.partitionBy("doc_id", "parent").orderBy("ord", "node")
    tree = tree.withColumn("place", F.row_number().over(order) - 1)
    first = F.first(F.struct((F.col("label") == "list_item").alias("item"), "enumerated")).over(order)
    tree = tree.withColumn("enumerates", F.coalesce(first["item"] & first["enumerated"], F.lit(False)))
    down = tree.groupBy("doc_id", F.col("parent").alias("above")).agg(
        F.count("*").alias("children"), F.max((F.col("kind") == "inline").cast("int")).alias("has_inline"), F.max("enumerates").alias("starts_enumerated")
    )
    tree = tree.join(down.withColumnRenamed("above", "node"), ["doc_id", "node"], "left").join(captions, ["doc_id", "node"], "left")
    if cells is None:
        tree = tree.withColumn("body", F.lit(None).cast("string"))
    else:
        # A node is one of its document only.
        bodies = partial(tables.as_latex, spans=True) if spans and form == "latex" else _BODIES[form]
        body = bodies(cells.withColumn("table_id", F.struct("doc_id", F.col("table_id").alias("node"))))
        tree = tree.join(body.select("table_id.*", F.col(body.columns[1]).alias("body")), ["doc_id", "node"], "left")
    empty = {"caption": F.coalesce("caption", F.lit("")), "starts_enumerated": F.coalesce("starts_enumerated", F.lit(False)), "text": F.coalesce("text", F.lit(""))}
    given = (F.col("text") == "") & (F.col("kind") == "text") & (F.coalesce("children", F.lit(0)) == 1) & (F.col("has_inline") == 1)
    # All that doesn't wait for the children is rendered here, once; a text that an inline group gives leaves a gap.
    tree = tree.withColumns(empty).withColumn("given", given).withColumn("said", F.when(F.col("given"), GAP).otherwise(F.col("text")))
    tree = written(tree.withColumn("own", rules.own()).drop("said", "text", "caption", "body", "link", "location"), "items")

    def assemble(level: DataFrame) -> DataFrame:
        kind, kids = F.col("kind"), F.col("kids")
        filled = F.replace("own", F.lit(GAP), F.coalesce(F.element_at(_texts(kids), 1), F.lit("")))
        own = F.when(F.col("given"), filled).otherwise(F.col("own"))
        below = F.when(F.col("given"), F.array().cast(f"array<{PART}>")).otherwise(kids)
        part = lambda text, inline: F.struct(text.alias("text"), inline.alias("inline"))
        inside = F.col("inlines") > 0
        joined = F.when(kind == "list", rules.listed(kids)).when(kind == "inline", rules.inline(kids)).otherwise(rules.grouped(kids))
        leaf = own if rules.item is None else F.when(F.col("label") == "list_item", rules.item(own, below)).otherwise(own)
        first = F.when(kind.isin(*GROUPS), joined).otherwise(leaf)
        # Whose children are within it, or aren't rendered, and whose follow.
        alone = kind != "text" if rules.item is None else (kind != "text") | (F.col("label") == "list_item")
        rest = F.when(alone, F.array().cast(f"array<{PART}>")).otherwise(below)
        parts = F.concat(F.filter(F.array(part(first, inside | (kind == "inline"))), lambda p: p["text"] != ""), rest)
        return level.withColumn("parts", parts)

    roots = folded(tree, assemble, PART)
    ordered = F.sort_array(F.collect_list(F.struct("ord", "node", "parts")))
    whole = roots.groupBy("doc_id").agg(F.flatten(F.transform(ordered, lambda x: x["parts"])).alias("parts"))
    return whole.select("doc_id", rules.document(F.col("parts")).alias("rendered"))
