"""Elements as Markdown, HTML, LaTeX or location-tagged markup: one expression a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.text import html_escaped, latex_escaped, markdown_escaped

#: Tags of labels in location-tagged markup.
TAGS = {"title": "title", "text": "text", "list_item": "list_item", "code": "code", "formula": "formula", "caption": "caption",
        "footnote": "footnote", "page_header": "page_header", "page_footer": "page_footer", "table": "otsl", "picture": "picture"}


def markdown(label: Column, text: Column, level: Column, marker: Column | None = None) -> Column:
    """Titles and headings with hashes, lists indented by level, code fenced, formulas between dollars."""
    marker = F.lit("-") if marker is None else F.coalesce(marker, F.lit("-"))
    escaped = markdown_escaped(text)
    return (
        F.when(label == "title", F.concat(F.lit("# "), escaped))
        .when(label == "section_header", F.concat(F.repeat(F.lit("#"), level + 1), F.lit(" "), escaped))
        .when(label == "list_item", F.concat(F.repeat(F.lit("    "), level), marker, F.lit(" "), escaped))
        .when(label == "code", F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .when(label == "formula", F.concat(F.lit("$$"), text, F.lit("$$")))
        .when(label == "checkbox_selected", F.concat(F.lit("- [x] "), escaped))
        .when(label == "checkbox_unselected", F.concat(F.lit("- [ ] "), escaped))
        .otherwise(escaped)
    )


def list_marker(marker: Column, enumerated: Column, place: Column) -> Column:
    """The item's own marker if it is one of Markdown's; else its number, or a dash."""
    own = marker.rlike(r"^([-*+]|\d+\.)$")
    return F.when(F.coalesce(own, F.lit(False)), marker).when(enumerated, F.concat((place + 1).cast("string"), F.lit("."))).otherwise("-")


def html(label: Column, text: Column, level: Column) -> Column:
    body = F.replace(html_escaped(text), F.lit("\n"), F.lit("<br>"))
    tag = (
        F.when(label == "title", "h1")
        .when(label == "section_header", F.concat(F.lit("h"), F.least(level + 1, F.lit(6)).cast("string")))
        .when(label == "list_item", "li")
        .when(label == "code", "pre")
        .otherwise("p")
    )
    return F.concat(F.lit("<"), tag, F.lit(">"), body, F.lit("</"), tag, F.lit(">"))


def latex_section(level: Column) -> Column:
    """Sections down to level 3; deeper headings begin paragraphs."""
    name = F.when(level == 1, "section").when(level == 2, "subsection").when(level == 3, "subsubsection")
    return F.coalesce(name, F.lit("paragraph"))


#: What stands before a LaTeX document, and how its title is found there; titles with braces stay in the body.
LATEX_PREAMBLE = (
    r"\documentclass[11pt,a4paper]{article}",
    "",
    r"\usepackage[utf8]{inputenc} % allow utf-8 input",
    r"\usepackage[T1]{fontenc}    % use 8-bit T1 fonts",
    r"\usepackage{hyperref}       % hyperlinks",
    r"\usepackage{url}            % simple URL typesetting",
    r"\usepackage{booktabs}       % professional-quality tables",
    r"\usepackage{amsfonts}       % blackboard math symbols",
    r"\usepackage{nicefrac}       % compact symbols for 1/2, etc.",
    r"\usepackage{microtype}      % microtypography",
    r"\usepackage{xcolor}         % colors",
    r"\usepackage{graphicx}       % graphics",
    r"\usepackage[normalem]{ulem} % strikethrough",
)
LATEX_TITLE = r"\\title\s*\{([^{}]*)\}"


def latex_document(body: Column, preamble: tuple[str, ...] = LATEX_PREAMBLE) -> Column:
    """A document with its head: the body's first title goes before it and is set by ``\\maketitle``, later ones are dropped."""
    title = F.regexp_extract(body, LATEX_TITLE, 0) != ""
    moved = F.when(title, F.concat(F.lit("\\title{"), F.regexp_extract(body, LATEX_TITLE, 1), F.lit("}\n"))).otherwise("")
    rest = F.regexp_replace(F.regexp_replace(body, LATEX_TITLE, ""), "\n{3,}", "\n\n")
    rest = F.when(title, F.regexp_replace(rest, r"(?U)^\s+|\s+$", "")).otherwise(body)
    before = F.concat(F.lit("".join(f"{line}\n" for line in preamble)), moved)
    begin = F.concat(F.when(before == "", "").otherwise(F.concat(before, F.lit("\n"))), F.lit("\\begin{document}"))
    parts = F.array(begin, F.when(title, "\\maketitle").otherwise(""), rest, F.lit("\\end{document}"))
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n\n")


def latex(label: Column, text: Column, level: Column) -> Column:
    """An item as LaTeX."""
    body = latex_escaped(text)
    section = latex_section(level)
    return (
        F.when(label == "title", F.concat(F.lit(r"\title{"), body, F.lit("}")))
        .when(label == "section_header", F.concat(F.lit("\\"), section, F.lit("{"), body, F.lit("}")))
        .when(label == "list_item", F.concat(F.lit(r"\item "), body))
        .when(label == "code", F.concat(F.lit("\\begin{verbatim}\n"), text, F.lit("\n\\end{verbatim}")))
        .when(label == "formula", F.concat(F.lit("$$"), text, F.lit("$$")))
        .otherwise(body)
    )


def tagged(label: Column, text: Column, level: Column, locations: Column | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])
    heading = F.concat(F.lit("section_header_level_"), level.cast("string"))
    tag = F.when(label == "section_header", heading).otherwise(F.coalesce(F.element_at(table, label), F.lit("text")))
    where = F.lit("") if locations is None else F.coalesce(locations, F.lit(""))
    return F.concat(F.lit("<"), tag, F.lit(">"), where, text, F.lit("</"), tag, F.lit(">"))


def styled(text: Column, bold: Column, italic: Column, link: Column) -> Column:
    """Bold, then italics, then the link around all."""
    text = F.when(bold, F.concat(F.lit("**"), text, F.lit("**"))).otherwise(text)
    text = F.when(italic, F.concat(F.lit("*"), text, F.lit("*"))).otherwise(text)
    return F.when(link.isNotNull(), F.concat(F.lit("["), text, F.lit("]("), link, F.lit(")"))).otherwise(text)


#: Names of page controls that are no text, and marks that no space stands before.
CONTROLS = ("plus", "button-close", "button-search", "button-download", "button-print", "button-history", "button-content")
TIGHT = (".", ",", ";", ":", "!", "?", ")", "]", "}", "(", "[", "{")


def content(tokens: Column) -> Column:
    """Tokens (text, link, label) of a unit as Markdown.

    "(1)" to "(16)" become headings, "a)" to "j)" are bold on lines of their own, "1." to "5."
    indented; links to sections are links, those to notes are raised. Captions, page controls
    and single characters of running text are dropped.
    """
    odsek, letter, item = ([f"({k})" for k in range(1, 17)], [f"{c})" for c in "abcdefghij"], [f"{k}." for k in range(1, 6)])
    bare = F.transform(
        tokens,
        lambda t: F.struct(
            F.regexp_replace(t["text"], r"(?U)^\s+|\s+$", "").alias("text"), F.coalesce(t["link"], F.lit("")).alias("link"),
            F.coalesce(t["label"], F.lit("")).alias("label"),
        ),
    )
    shown = F.filter(bare, lambda t: (t["text"] != "") & ~t["text"].isin(*CONTROLS) & (t["label"] != "caption"))

    def said(text: Column, t: Column) -> Column:
        own = t["text"]
        space = F.when((text != "") & ~text.rlike(r"[ \n]$") & ~F.left(own, F.lit(1)).isin(*TIGHT), " ").otherwise("")
        section = t["link"].contains("paragraf-") & ~t["link"].contains("poznamky")
        return F.concat(
            text,
            F.when(own.isin(*odsek), F.concat(F.lit("\n\n### "), own, F.lit("\n\n")))
            .when(own.isin(*letter), F.concat(F.lit("\n**"), own, F.lit("** ")))
            .when(own.isin(*item), F.concat(F.lit("    "), own, F.lit(" ")))
            .when(section, F.concat(F.lit(" ["), own, F.lit("]("), t["link"], F.lit(")")))
            .when(t["link"].contains("poznamky.poznamka"), F.concat(F.lit("<sup>"), own, F.lit("</sup>)")))
            .when(F.length(own) > 1, F.concat(space, own))
            .otherwise(""),
        )

    folded = F.aggregate(shown, F.lit(""), said)
    for pattern, by in ((r" +", " "), (r" \n", "\n"), (r"\n{3,}", "\n\n"), (r"(?U)^\s+|\s+$", "")):
        folded = F.regexp_replace(folded, pattern, by)
    return folded


def indented(text: Column, level: int) -> Column:
    """Lines that hold anything after ``level`` tabs."""
    return F.regexp_replace(text, r"(?m)^(?=.*\S)", "\t" * level)


def marked_text(marker: Column, text: Column, level: int) -> Column:
    """A marker and its text after ``level`` tabs; further lines begin where the text does, empty ones stay empty."""
    tabs = F.lit("\t" * level)
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    beside = F.concat(tabs, F.repeat(F.lit(" "), F.length(marker) + 1))
    later = F.transform(F.slice(lines, F.lit(2), F.size(lines)), lambda x: F.when(x == "", "").otherwise(F.concat(beside, x)))
    whole = F.array_join(F.concat(F.array(F.concat(tabs, marker, F.lit(" "), F.element_at(lines, 1))), later), "\n")
    return F.when(F.coalesce(text, F.lit("")) == "", F.concat(tabs, marker)).otherwise(whole)


def embedded_letters(text: Column) -> Column:
    """An introduction that holds letters and numbers of its own, line by line: letters after a tab, numbers after two.

    What continues a letter or a number is aligned with its text. After "sa rozumie" terms are
    defined: lines in small letters, and all after the first other line, continue a term.
    """
    letter, alone, number = r"^([a-z])\)\s*(.*)$", r"(?U)^(\d+[a-z]?)\.\s*$", r"(?U)^(\d+[a-z]?)\.\s+(.+)$"
    state = lambda lines, depth, terms: F.struct(lines.alias("lines"), depth.alias("depth"), terms.alias("terms"))

    def step(s: Column, line: Column) -> Column:
        part = lambda pattern, k: F.regexp_extract(line, pattern, k)
        add = lambda x: F.concat(s["lines"], F.array(x))
        two, none, yes = F.lit(2), F.lit(0), F.lit(True)
        first = F.left(line, F.lit(1))
        capital = (F.upper(first) == first) & (F.lower(first) != first)
        return (
            F.when(line == "", state(add(F.lit("")), s["depth"], s["terms"]))
            .when(line.rlike(letter), state(add(F.concat(F.lit("\t"), part(letter, 1), F.lit(") "), part(letter, 2))), F.lit(1), yes))
            .when(line.rlike(alone), state(add(F.concat(F.lit("\t\t"), part(alone, 1), F.lit("."))), two, s["terms"]))
            .when(line.rlike(number), state(add(F.concat(F.lit("\t\t"), part(number, 1), F.lit(". "), part(number, 2))), two, s["terms"]))
            .when(line.contains("sa rozumie") | line.contains("rozumie sa"), state(add(line), none, yes))
            .when(s["depth"] == 2, state(add(F.concat(F.lit("\t\t   "), line)), two, s["terms"]))
            .when((s["depth"] == 1) | (s["terms"] & ~capital), state(add(F.concat(F.lit("\t   "), line)), s["depth"], s["terms"]))
            .otherwise(state(add(line), F.when(s["terms"], 1).otherwise(s["depth"]), s["terms"]))
        )

    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    start = state(F.array().cast("array<string>"), F.lit(0), F.lit(False))
    return F.when(text == "", "").otherwise(F.array_join(F.aggregate(lines, start, step)["lines"], "\n"))


def picture(caption: Column) -> Column:
    """A picture's place in Markdown: its caption, or a word for it."""
    return F.concat(F.lit("\n!["), F.coalesce(F.nullif(caption, F.lit("")), F.lit("Image")), F.lit("]\n\n"))
