"""Queries over documents of nested items: a nation's customers and their orders as lists in a list, a table, a picture."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.operators import nested, tables
from vellum.plans.registry import query
from vellum.sources import markup, table


def nation_items(spark, sf_dir):
    """The items of a document a nation, and the cells of its table of suppliers."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nations = nations.select(F.col("n_nationkey").cast("long").alias("doc_id"), "n_name", "r_name")
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    text, none = lambda x: F.lit(x).cast("string"), F.lit(None).cast("string")

    def rows(df, node, parent, place, kind, label=none, said=none, marker=none, caption_of=none):
        return df.select(
            "doc_id", node.alias("node"), parent.alias("parent"), place.cast("int").alias("ord"), text(kind).alias("kind"),
            label.alias("label"), said.alias("text"), marker.alias("marker"), caption_of.alias("caption_of"),
        )

    key = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    mine = customers.withColumn("doc_id", F.col("c_nationkey").cast("long"))
    bought = orders.join(mine.select("doc_id", "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    marker = F.when(F.col("c_mktsegment") == "BUILDING", "a)").when(F.col("c_mktsegment") == "MACHINERY", "1.")
    said = F.concat("o_orderpriority", F.lit(" "), "o_orderstatus")
    parts = [
        rows(nations, text("t"), none, F.lit(0), "text", text("title"), F.col("n_name")),
        rows(mine.select("doc_id").distinct(), text("L"), none, F.lit(1), "list"),
        rows(mine, key("c", "c_custkey"), text("L"), F.col("c_custkey"), "text", text("list_item"), F.col("c_name"), marker),
        rows(bought.select("doc_id", "c_custkey").distinct(), key("l", "c_custkey"), key("c", "c_custkey"), F.lit(0), "list"),
        rows(bought, key("o", "o_orderkey"), key("l", "c_custkey"), F.col("o_orderkey"), "text", text("list_item"), said),
        rows(nations, text("I"), none, F.lit(2), "inline"),
        rows(nations, text("i1"), text("I"), F.lit(0), "text", text("text"), text("of_all")),
        rows(nations, text("i2"), text("I"), F.lit(1), "text", text("code"), F.col("r_name")),
        rows(nations, text("P"), none, F.lit(3), "picture"),
        rows(nations, text("p"), text("P"), F.lit(0), "text", text("caption"), F.col("r_name"), none, text("P")),
        rows(nations, text("T"), none, F.lit(4), "table"),
        rows(nations, text("k"), text("T"), F.lit(0), "text", text("caption"), F.concat(F.lit("Suppliers & "), "n_name"), none, text("T")),
    ]
    items = parts[0]
    for more in parts[1:]:
        items = items.unionByName(more)
    place = F.row_number().over(W.partitionBy("s_nationkey").orderBy("s_suppkey"))
    sellers = table(spark, sf_dir, "supplier").withColumn("r0", place)
    cell = lambda df, doc, r, c, said, head: df.select(
        doc.cast("long").alias("doc_id"), text("T").alias("table_id"), r.alias("r0"), (r + 1).alias("r1"), F.lit(c).alias("c0"), F.lit(c + 1).alias("c1"),
        said.alias("text"), F.lit(head).alias("column_header"), F.lit(False).alias("row_header"), F.lit(False).alias("row_section"),
    )
    cells = cell(nations, F.col("doc_id"), F.lit(0), 0, text("key"), True).unionByName(cell(nations, F.col("doc_id"), F.lit(0), 1, text("name"), True))
    for c, said in ((0, F.col("s_suppkey").cast("string")), (1, F.col("s_name"))):
        cells = cells.unionByName(cell(sellers, F.col("s_nationkey"), F.col("r0"), c, said, False))
    return items, cells


def _sql(order: str, orders: str, customer: str, customers: str, row: str, whole: str) -> str:
    """The nested stream, level by level: orders of a customer, customers and suppliers of a nation, the document."""
    return f"""WITH o AS (SELECT o_custkey, string_agg({order}, chr(10) ORDER BY o_orderkey) AS kids FROM orders GROUP BY 1),
c AS (SELECT c_nationkey, c_custkey, c_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'a)' WHEN 'MACHINERY' THEN '1.' END AS marker, {orders} AS kids
  FROM customer LEFT JOIN o ON o_custkey = c_custkey),
l AS (SELECT c_nationkey, string_agg({customer}, chr(10) ORDER BY c_custkey) AS kids FROM c GROUP BY 1),
s AS (SELECT s_nationkey, string_agg({row} ORDER BY s_suppkey) AS lines FROM supplier GROUP BY 1)
SELECT n_nationkey::BIGINT AS doc_id, {whole} AS rendered
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT c_nationkey, {customers} AS items FROM l) ON c_nationkey = n_nationkey LEFT JOIN s ON s_nationkey = n_nationkey"""


@query(
    "nested_markdown",
    _sql(
        order="'    - ' || o_orderpriority || ' ' || o_orderstatus",
        orders="coalesce(chr(10) || kids, '')",
        customer="CASE marker WHEN 'a)' THEN '- a)' WHEN '1.' THEN '1.' ELSE '-' END || ' ' || c_name || kids",
        customers="kids || chr(10) || chr(10)",
        row="chr(10) || '| ' || s_suppkey || ' | ' || s_name || ' |', ''",
        whole="""'# ' || replace(n_name, '_', '\\_') || chr(10) || chr(10) || coalesce(items, '') || 'of\\_all `' || r_name || '`' || chr(10) || chr(10) || r_name || chr(10) || chr(10)
  || '<!-- image -->' || chr(10) || chr(10) || 'Suppliers &amp; ' || replace(n_name, '_', '\\_') || chr(10) || chr(10) || '| key | name |' || chr(10) || '| --- | --- |' || coalesce(lines, '')""",
    ),
)
def nested_markdown(spark, sf_dir):
    items, cells = nation_items(spark, sf_dir)
    return nested.document(items, "markdown", cells=cells)


@query(
    "nested_html",
    _sql(
        order="'<li>' || o_orderpriority || ' ' || o_orderstatus || '</li>'",
        orders="coalesce('<ul>' || chr(10) || kids || chr(10) || '</ul>', '')",
        customer="""'<li' || coalesce(' style="list-style-type: ''' || marker || ' '';"', '') || '>' || CASE WHEN kids = '' THEN c_name ELSE chr(10) || c_name || chr(10) || kids || chr(10) END || '</li>'""",
        customers="'<ul>' || chr(10) || kids || chr(10) || '</ul>' || chr(10)",
        row="'<tr><td>' || s_suppkey || '</td><td>' || s_name || '</td></tr>', ''",
        whole="""'<!DOCTYPE html>' || chr(10) || '<html>' || chr(10) || '<body>' || chr(10) || '<div class=''page''>' || chr(10) || '<h1>' || n_name || '</h1>' || chr(10) || coalesce(items, '')
  || '<span class=''inline-group''>of_all <code>' || r_name || '</code></span>' || chr(10) || '<figure><figcaption><div class="caption">' || r_name || '</div></figcaption></figure>' || chr(10)
  || '<table><caption><div class="caption">Suppliers &amp; ' || n_name || '</div></caption><tbody><tr><th>key</th><th>name</th></tr>' || coalesce(lines, '') || '</tbody></table>' || chr(10)
  || '</div>' || chr(10) || '</body>' || chr(10) || '</html>'""",
    ),
)
def nested_html(spark, sf_dir):
    items, cells = nation_items(spark, sf_dir)
    return nested.document(items, "html", cells=cells)


@query(
    "nested_tags",
    _sql(
        order="'<list_item>' || o_orderpriority || ' ' || o_orderstatus || '</list_item>'",
        orders="coalesce(chr(10) || '<list_item><unordered_list>' || kids || chr(10) || '</unordered_list></list_item>', '')",
        customer="'<list_item>' || c_name || '</list_item>' || kids",
        customers="'<unordered_list>' || kids || chr(10) || '</unordered_list>' || chr(10)",
        row="'<fcel>' || s_suppkey || '<fcel>' || s_name || '<nl>', ''",
        whole="""'<doctag><title>' || n_name || '</title>' || chr(10) || coalesce(items, '') || '<inline><text>of_all</text>' || chr(10) || '<code><_unknown_>' || r_name || '</code>' || chr(10) || '</inline>' || chr(10)
  || '<picture><caption>' || r_name || '</caption></picture>' || chr(10) || '<otsl><ched>key<ched>name<nl>' || coalesce(lines, '') || '<caption>Suppliers & ' || n_name || '</caption></otsl>' || chr(10) || '</doctag>'""",
    ),
)
def nested_tags(spark, sf_dir):
    items, cells = nation_items(spark, sf_dir)
    return nested.document(items, "tags", cells=cells)


@query(
    "nested_latex",
    _sql(
        order=r"'\item ' || o_orderpriority || ' ' || o_orderstatus",
        orders=r"coalesce(chr(10) || '  \begin{itemize}' || chr(10) || kids || chr(10) || '  \end{itemize}', '')",
        customer=r"'\item ' || replace(c_name, '#', '\#') || kids",
        customers=r"'\begin{itemize}' || chr(10) || kids || chr(10) || '\end{itemize}' || chr(10) || chr(10)",
        row=r"chr(10) || s_suppkey || ' & ' || replace(s_name, '#', '\#') || ' \\ \hline', ''",
        whole=r"""'\documentclass{article}' || chr(10) || '\title{' || replace(n_name, '_', '\_') || '}' || chr(10) || chr(10) || '\begin{document}' || chr(10) || chr(10) || '\maketitle' || chr(10) || chr(10)
  || coalesce(items, '') || 'of\_all \texttt{' || r_name || '}' || chr(10) || chr(10) || '\begin{figure}[h]' || chr(10) || '% image' || chr(10) || '\caption{' || r_name || '}' || chr(10) || '\end{figure}' || chr(10) || chr(10)
  || '\begin{table}[h]' || chr(10) || '\caption{Suppliers \& ' || replace(n_name, '_', '\_') || '}' || chr(10) || '\begin{tabular}{|l|l|}' || chr(10) || '\hline' || chr(10) || 'key & name \\ \hline' || coalesce(lines, '')
  || chr(10) || '\end{tabular}' || chr(10) || '\end{table}' || chr(10) || chr(10) || '\end{document}'""",
    ),
)
def nested_latex(spark, sf_dir):
    items, cells = nation_items(spark, sf_dir)
    return nested.document(items, "latex", cells=cells, preamble=(r"\documentclass{article}",))


@query(
    "table_latex_spans",
    r"""SELECT o_orderkey AS table_id, '\begin{tabular}{|l|l|l|}' || chr(10) || '\hline' || chr(10) || '\multicolumn{3}{|l|}{' || o_orderpriority || '} \\ \hline' || chr(10)
  || string_agg(CASE WHEN k > 1 THEN '' WHEN n > 1 THEN '\multirow{' || n || '}{*}{' || o_orderstatus || '}' ELSE o_orderstatus END || ' & ' || l_linenumber || ' & ' || l_returnflag || ' \\ '
    || CASE WHEN k < n THEN '\cline{2-2} \cline{3-3}' ELSE '\hline' END, chr(10) ORDER BY k) || chr(10) || '\end{tabular}' AS tabular
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderpriority, o_orderstatus""",
)
def table_latex_spans(spark, sf_dir):
    """A table for each order: its priority across the top, its status down the side, its lines."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    by = W.partitionBy("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("string").alias("number"), "l_returnflag",
        F.row_number().over(by.orderBy("l_linenumber", "l_returnflag")).alias("k"), F.count("*").over(by).cast("int").alias("n"),
    )
    cell = lambda r0, r1, c0, c1, text: F.struct(
        r0.cast("int").alias("r0"), r1.cast("int").alias("r1"), F.lit(c0).alias("c0"), F.lit(c1).alias("c1"), text.alias("text")
    )
    k, one = F.col("k"), F.lit(1)
    heads = F.array(cell(F.lit(0), one, 0, 3, F.col("o_orderpriority")), cell(one, F.col("n") + 1, 0, 1, F.col("o_orderstatus")))
    own = F.array(cell(k, k + 1, 1, 2, F.col("number")), cell(k, k + 1, 2, 3, F.col("l_returnflag")))
    met = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    every = met.select(F.col("o_orderkey").alias("table_id"), F.explode(F.when(k == 1, F.concat(heads, own)).otherwise(own)).alias("x"))
    return tables.as_latex(every.select("table_id", "x.*"), spans=True)


# Markup as a tree


@query(
    "markup_tree",
    """WITH p AS (SELECT page_id, url, page_id::VARCHAR AS a, length(html)::VARCHAR AS b, page_id % 4 AS kind FROM pages),
n AS (
  SELECT page_id, 0 AS node, NULL AS parent, 'title' AS tag, url AS text, NULL AS marker, true AS placed, kind FROM p
  UNION ALL SELECT page_id, 1, NULL, 'ordered_list', '', NULL, false, kind FROM p WHERE kind < 2
  UNION ALL SELECT page_id, 2, 1, 'list_item', a, '1.', false, kind FROM p WHERE kind < 2
  UNION ALL SELECT page_id, 3, 1, 'list_item', b, '2.', false, kind FROM p WHERE kind < 2
  UNION ALL SELECT page_id, 4, 3, 'unordered_list', '', NULL, false, kind FROM p WHERE kind = 0
  UNION ALL SELECT page_id, 5, 4, 'list_item', url, NULL, false, kind FROM p WHERE kind = 0
  UNION ALL SELECT page_id, 1, NULL, 'picture', '', NULL, true, kind FROM p WHERE kind = 2
  UNION ALL SELECT page_id, 2, 1, 'caption', a, NULL, false, kind FROM p WHERE kind = 2
  UNION ALL SELECT page_id, 3, NULL, 'inline', '', NULL, false, kind FROM p WHERE kind = 2
  UNION ALL SELECT page_id, 4, 3, 'text', b, NULL, false, kind FROM p WHERE kind = 2
  UNION ALL SELECT page_id, 5, 3, 'code', url, 'SQL', false, kind FROM p WHERE kind = 2
  UNION ALL SELECT page_id, CASE kind WHEN 1 THEN 4 ELSE 6 END, NULL, 'text', 'end', NULL, false, kind FROM p WHERE kind < 3
  UNION ALL SELECT page_id, 1, NULL, 'otsl', '', NULL, false, kind FROM p WHERE kind = 3)
SELECT page_id, node::INTEGER AS node, parent::INTEGER AS parent, tag, text, marker, placed FROM n""",
)
def markup_tree(spark, sf_dir):
    """Pages with lists in lists, with items and closing tags that don't match, and pages that are cut off within a table."""
    pages = table(spark, sf_dir, "pages")
    a, b, url, kind = F.col("page_id").cast("string"), F.length("html").cast("string"), F.col("url"), F.col("page_id") % 4
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    body = (
        F.when(kind == 0, text("<ordered_list><list_item>", a, "</list_item><list_item>", b, "<unordered_list><list_item>", url,
                               "</list_item></unordered_list></list_item></ordered_list><text>end</text>"))
        .when(kind == 1, text("</text><ordered_list><list_item>", a, "<list_item>", b, "</ordered_list><text>en<i>d</i></text></title>"))
        .when(kind == 2, text("<picture><loc_0><loc_0><loc_9><loc_9><caption>", a, "</caption></picture><inline><text>", b,
                              "</text><code><_SQL_>", url, "</code></inline><text> end </text>"))
        .otherwise(text("<otsl><fcel>", a, "<fcel>", b, "<nl>"))
    )
    made = pages.select("page_id", F.lit(1).alias("page_no"), text("<title><loc_1><loc_2><loc_3><loc_4>", url, "</title>", body).alias("markup"))
    found = markup.tree(made, "page_id")
    return found.select("page_id", "node", "parent", "tag", "text", "marker", F.col("box").isNotNull().alias("placed"))
