"""Nested documents: fixtures worked out by hand, and trees of any depth."""

import random

from pyspark.sql import functions as F

from vellum.operators import nested, tables, trees

ITEMS = (
    "doc_id long, node string, parent string, ord int, kind string, label string, text string, level int, marker string, "
    "enumerated boolean, bold boolean, italic boolean, link string, location string, caption_of string"
)


def row(node, parent, place, kind, label=None, text="", doc=1, level=1, marker=None, enumerated=False, bold=False, italic=False, link=None, location=None, caption_of=None):
    return (doc, node, parent, place, kind, label, text, level, marker, enumerated, bold, italic, link, location, caption_of)


LISTS = [
    row("t", None, 0, "text", "title", "A_b & c"),
    row("L", None, 1, "list"),
    row("a", "L", 0, "text", "list_item", "first", marker="1.", enumerated=True),
    row("M", "a", 0, "list"),
    row("x", "M", 0, "text", "list_item", "inner <x>", marker="a)"),
    row("N", "x", 0, "list"),
    row("z", "N", 0, "text", "list_item", "deep"),
    row("y", "M", 1, "text", "list_item", "second", marker="•"),
    row("b", "L", 1, "text", "list_item", "bold", bold=True, link="u"),
    row("c", "L", 2, "text", "list_item", ""),
    row("I", "c", 0, "inline"),
    row("i1", "I", 0, "text", "text", "see"),
    row("i2", "I", 1, "text", "code", "f(x)", marker="Python"),
    row("i3", "I", 2, "text", "formula", "x^2"),
    row("d", "L", 3, "text", "list_item", "then"),
    row("J", "d", 0, "inline"),
    row("j", "J", 0, "text", "text", "more", italic=True),
    row("g", None, 2, "group"),
    row("h", "g", 0, "text", "section_header", "Head", level=2),
    row("p", "g", 1, "picture", location="<loc_1>"),
    row("e", "g", 2, "text", "code", "a < b"),
    row("T", "g", 3, "table"),
    row("k1", "T", 0, "text", "caption", "Table 'one'", caption_of="T"),
    row("k2", "T", 1, "text", "caption", "of two", caption_of="T"),
    row("v", "p", 0, "text", "text", "a text within the picture"),
    row("k3", "p", 1, "text", "caption", "Fig_1", caption_of="p"),
]
CELLS = [
    (1, "T", 0, 1, 0, 2, "Head\nline", True), (1, "T", 1, 2, 0, 1, "1", False), (1, "T", 1, 2, 1, 2, ' "q" ', False),
]

MARKDOWN = r"""# A\_b &amp; c

1. first
    - a) inner &lt;x&gt;
        - deep
    - second
2. [**bold**](u)
3. see `f(x)` $x^2$
4. then*more*

### Head

Fig\_1

<!-- image -->

```
a < b
```

Table 'one' of two

| Head line | Head line |
| --- | --- |
| 1 |  "q"  |"""

HTML = """<!DOCTYPE html>
<html>
<body>
<div class='page'>
<h1>A_b &amp; c</h1>
<ol>
<li style="list-style-type: '1. ';">
first
<ul>
<li style="list-style-type: 'a) ';">
inner &lt;x&gt;
<ul>
<li>deep</li>
</ul>
</li>
<li style="list-style-type: '• ';">second</li>
</ul>
</li>
<li><a href="u"><strong>bold</strong></a></li>
<li>
<span class='inline-group'>see <code>f(x)</code> <code>x^2</code></span>
</li>
<li>
then
<span class='inline-group'><em>more</em></span>
</li>
</ol>
<h3>Head</h3>
<figure><figcaption><div class="caption">Fig_1</div></figcaption></figure>
<pre><code>a < b</code></pre>
<table><caption><div class="caption">Table &#x27;one&#x27; of two</div></caption><tbody><tr><th colspan="2">Head
line</th></tr><tr><td>1</td><td>&quot;q&quot;</td></tr></tbody></table>
</div>
</body>
</html>"""

TAGS = """<doctag><title>A_b & c</title>
<ordered_list><list_item>first</list_item>
<list_item><unordered_list><list_item>inner <x></list_item>
<list_item><unordered_list><list_item>deep</list_item>
</unordered_list></list_item>
<list_item>second</list_item>
</unordered_list></list_item>
<list_item>bold</list_item>
<list_item><inline><text>see</text>
<code><_Python_>f(x)</code>
<formula>x^2</formula>
</inline></list_item>
<list_item>then</list_item>
<list_item><inline><text>more</text>
</inline></list_item>
</ordered_list>
<section_header_level_2>Head</section_header_level_2>
<picture><loc_1><caption>Fig_1</caption></picture>
<code><_unknown_>a < b</code>
<otsl><ched>Head
line<lcel><nl><fcel>1<fcel> "q" <nl><caption>Table 'one' of two</caption></otsl>
</doctag>"""


def rendered(spark, rows, form, cells=CELLS, **more):
    items = spark.createDataFrame(rows, ITEMS)
    if cells is None:
        return {r.doc_id: r.rendered for r in nested.document(items, form, **more).collect()}
    grid = spark.createDataFrame([(*c, False, False) for c in cells], "doc_id long, table_id string, r0 int, r1 int, c0 int, c1 int, text string, column_header boolean, row_header boolean, row_section boolean")
    return {r.doc_id: r.rendered for r in nested.document(items, form, cells=grid, **more).collect()}


def test_markdown(spark):
    assert rendered(spark, LISTS, "markdown") == {1: MARKDOWN}


def test_html(spark):
    assert rendered(spark, LISTS, "html") == {1: HTML}


def test_tags(spark):
    assert rendered(spark, LISTS, "tags") == {1: TAGS}


LATEX = r"""\documentclass{article}
\title{A\_b \& c}

\begin{document}

\maketitle

\begin{enumerate}
\item first
  \begin{itemize}
\item inner <x>
    \begin{itemize}
\item deep
    \end{itemize}
\item second
  \end{itemize}
\item \href{u}{\textbf{bold}}
\item see \texttt{f(x)} $x^2$
\item then
\textit{more}
\end{enumerate}

\subsection{Head}

\begin{figure}[h]
% image
\caption{Fig\_1}
\end{figure}

\begin{verbatim}
a < b
\end{verbatim}

\begin{table}[h]
\caption{Table 'one' of two}
\begin{tabular}{|l|l|}
\hline
Head line & Head line \\ \hline
1 &  "q"  \\ \hline
\end{tabular}
\end{table}

\end{document}"""


def test_latex(spark):
    head = (r"\documentclass{article}",)
    assert rendered(spark, LISTS, "latex", preamble=head) == {1: LATEX}
    spanned = LATEX.replace("Head line & Head line", r"\multicolumn{2}{|l|}{Head line}").replace("{article}\n", "{article}\n\\usepackage{multirow}\n")
    assert rendered(spark, LISTS, "latex", preamble=head, spans=True) == {1: spanned}


def test_latex_heads(spark):
    """Only the first title is set, those with braces stay, headings of any depth don't abort, and what is empty gives nothing."""
    rows = [
        row("a", None, 0, "text", "text", "before"), row("b", None, 1, "text", "title", "one"), row("c", None, 2, "text", "title", "two"),
        row("d", None, 3, "text", "section_header", "deep", level=9), row("e", None, 4, "text", "formula", ""), row("f", None, 5, "text", "text", None),
        row("g", None, 6, "table"), row("a", None, 0, "text", "title", "a{b}", doc=2), row("a", None, 0, "text", "text", "", doc=3),
        row("I", None, 0, "inline", doc=4), row("i", "I", 0, "text", "code", "#1", doc=4), row("j", "I", 1, "text", "text", "50%", doc=4),
    ]
    begin, end = "\\begin{document}", "\\end{document}"
    assert rendered(spark, rows, "latex", cells=None, preamble=()) == {
        1: "\\title{one}\n\n" + "\n\n".join([begin, "\\maketitle", "before", "\\paragraph{deep}", end]),
        2: "\n\n".join([begin, r"\title{a\{b\}}", end]), 3: f"{begin}\n\n{end}", 4: "\n\n".join([begin, r"\texttt{\\#1} 50\%", end]),
    }
    assert list(rendered(spark, rows[:1], "latex", cells=None).values())[0].startswith("\\documentclass[11pt,a4paper]{article}\n\n\\usepackage[utf8]")


def test_latex_spans(spark):
    """Cells across columns and rows, and a place without a cell, whose rules go on."""
    cells = [(1, 0, 1, 0, 3, "A"), (1, 1, 3, 0, 1, "B"), (1, 1, 2, 1, 2, "c\nd"), (1, 2, 3, 1, 3, "E"), (2, 0, 2, 0, 2, "F"), (3, 0, 1, 1, 2, None)]
    found = tables.as_latex(spark.createDataFrame(cells, "table_id long, r0 int, r1 int, c0 int, c1 int, text string"), spans=True)
    bodies = {
        1: ["|l|l|l|", r"\multicolumn{3}{|l|}{A} \\ \hline", r"\multirow{2}{*}{B} & c d &  \\ \cline{2-2} \cline{3-3}", r" & \multicolumn{2}{l|}{E} \\ \hline"],
        2: ["|l|l|", r"\multicolumn{2}{|l|}{\multirow{2}{*}{F}} \\", r"\multicolumn{2}{|l|}{} \\ \hline"],
        3: ["|l|l|", r" &  \\ \hline"],
    }
    made = {k: "\n".join([f"\\begin{{tabular}}{{{v[0]}}}", "\\hline", *v[1:], "\\end{tabular}"]) for k, v in bodies.items()}
    assert {r.table_id: r.tabular for r in found.collect()} == made


def test_numbers_of_a_list_without_markers(spark):
    rows = [row("L", None, 0, "list")] + [row(f"i{k}", "L", k, "text", "list_item", f"x{k}", enumerated=k == 0) for k in range(3)]
    assert rendered(spark, rows, "markdown") == {1: "1. x0\n2. x1\n3. x2"}


def test_documents_with_little_or_nothing(spark):
    rows = [row("a", None, 0, "text", "text", None), row("b", "gone", 0, "text", "text", "lost"), row("a", None, 0, "text", "text", "own", doc=2), row("L", None, 1, "list", doc=2)]
    assert rendered(spark, rows, "markdown", []) == {1: "", 2: "own"}
    assert rendered(spark, [], "html", []) == {}


def test_a_fold_of_a_deep_tree(spark):
    n = 6
    rows = [row("0", None, 0, "list")]
    for k in range(n):
        rows += [row(f"i{k}", str(k), 0, "text", "list_item", f"t{k}"), row(str(k + 1), f"i{k}", 0, "list")]
    text = "\n".join("    " * k + f"- t{k}" for k in range(n))
    assert rendered(spark, rows, "markdown", []) == {1: text}


def test_paths_of_a_chain_a_thousand_deep(spark):
    edges = spark.range(1001).select(
        F.lit(1).alias("doc_id"), F.col("id").cast("string").alias("node"),
        F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"), F.lit(0).alias("ord"),
    )
    found = trees.paths(edges, {"even": (F.col("node").cast("int") % 2 == 0).cast("int")})
    rows = {int(r.node): (r.depth, r.even) for r in found.collect()}
    assert rows == {k: (k, (k + 1) // 2) for k in range(1001)}


def test_paths_of_random_trees(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for doc in range(5):
        ways = {0: ((0,), 0)}
        rows.append((doc, "0", None, 0))
        for k in range(1, 40):
            up = rng.randrange(max(0, k - 3), k)
            ways[k] = ((*ways[up][0], k), ways[up][1] + 1)
            rows.append((doc, str(k), str(up), k))
        want |= {(doc, str(k)): w for k, w in ways.items()}
    # Nodes below a missing parent, and a circle.
    rows += [(9, "a", "none", 0), (9, "b", "a", 0), (9, "c", "d", 0), (9, "d", "c", 0), (9, "r", None, 4)]
    want[(9, "r")] = ((4,), 0)
    edges = spark.createDataFrame(rows, "doc_id long, node string, parent string, ord int")
    got = {(r.doc_id, r.node): (tuple(map(int, r.path.split("."))), r.depth) for r in trees.paths(edges).collect()}
    assert got == want
