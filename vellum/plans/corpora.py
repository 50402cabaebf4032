"""Queries over documents, pages, conversations, events, boxes and cells."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.functions import geometry as g
from vellum.functions import refs, render, text
from vellum.operators import analytics, budget, chunks, context, packing, tables, trees
from vellum.plans.registry import query
from vellum.sources import html, table

# Items and text


@query(
    "items_from_documents",
    "SELECT doc_id, (i - 1)::INTEGER AS pos, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE line <> ''",
)
def items_from_documents(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.filter("line <> ''")


@query(
    "items_from_pages_layers",
    r"""
SELECT page_id, 'furniture' AS layer, (len(regexp_extract_all(html, '<nav[ >]')) + len(regexp_extract_all(html, '<footer[ >]')))::BIGINT AS n FROM pages
WHERE regexp_matches(html, '<(nav|footer)[ >]')
UNION ALL SELECT page_id, 'body', len(regexp_extract_all(html, '<h1[ >]'))::BIGINT FROM pages WHERE regexp_matches(html, '<h1[ >]')""",
)
def items_from_pages_layers(spark, sf_dir):
    tags = html.opened(table(spark, sf_dir, "pages"), "page_id", "html").filter("tag IN ('nav', 'footer', 'h1')")
    layer = F.when(F.col("tag") == "h1", "body").otherwise("furniture")
    return tags.groupBy("page_id", layer.alias("layer")).agg(F.sum("n").alias("n"))


@query(
    "normalise_text",
    "SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(replace(replace(replace(text, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'))), '\\s+', ' ', 'g'))) AS folded FROM documents",
)
def normalise_text(spark, sf_dir):
    body = F.col("text")
    for a, b in (("ß", "ss"), ("æ", "ae"), ("œ", "oe")):
        body = F.replace(body, F.lit(a), F.lit(b))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(body)).alias("folded"))


@query(
    "unit_text_agg",
    "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS n FROM conversations WHERE text <> '' GROUP BY conv_id",
)
def unit_text_agg(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").filter("text <> ''")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return rows.groupBy("conv_id").agg(F.array_join(ordered, "\n").alias("text"), F.count("*").alias("n"))


@query(
    "running_offsets",
    "SELECT conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM conversations",
)
def running_offsets(spark, sf_dir):
    before = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).alias("off")
    )


@query(
    "context_frame_whole",
    "SELECT conv_id, turn, coalesce(string_agg(text, '|') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS frame FROM conversations",
)
def context_frame_whole(spark, sf_dir):
    """The last three turns before each turn."""
    frame = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-3, -1)
    last = F.array_join(F.collect_list("text").over(frame), "|")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", last.alias("frame"))


@query(
    "html_escape_render",
    "SELECT doc_id, '<p>' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br>') || '</p>' AS html FROM documents",
)
def html_escape_render(spark, sf_dir):
    rendered = render.html(F.lit("text"), F.col("text"), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", rendered.alias("html"))


@query(
    "markdown_render",
    "SELECT conv_id, turn, CASE role WHEN 'system' THEN '# ' WHEN 'user' THEN '### ' ELSE '        - ' END || replace(text, '_', '\\_') AS md FROM conversations",
)
def markdown_render(spark, sf_dir):
    label = F.when(F.col("role") == "system", "title").when(F.col("role") == "user", "section_header").otherwise("list_item")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", render.markdown(label, F.col("text"), F.lit(2)).alias("md")
    )


@query(
    "tagged_render",
    "SELECT conv_id, turn, CASE role WHEN 'user' THEN '<section_header_level_2>' || text || '</section_header_level_2>' ELSE '<text>' || text || '</text>' END AS tagged FROM conversations",
)
def tagged_render(spark, sf_dir):
    label = F.when(F.col("role") == "user", "section_header").otherwise("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", render.tagged(label, F.col("text"), F.lit(2)).alias("tagged")
    )


@query(
    "latex_render",
    r"""SELECT p_partkey, '\subsection{' || regexp_replace(replace(p_name || ' & ' || p_brand || ' 5%', '&', '\&'), '([#_%$])', '\\\1', 'g') || '}' AS tex FROM part""",
)
def latex_render(spark, sf_dir):
    body = F.concat("p_name", F.lit(" & "), "p_brand", F.lit(" 5%"))
    return table(spark, sf_dir, "part").select("p_partkey", render.latex(F.lit("section_header"), body, F.lit(2)).alias("tex"))


#: The upper half of code page 1250, letter by letter, for the SQL.
_UPPER = "ŔÁÂĂÄĹĆÇČÉĘËĚÍÎĎĐŃŇÓÔŐÖ×ŘŮÚŰÜÝŢßŕáâăäĺćçčéęëěíîďđńňóôőö÷řůúűüýţ˙"


@query(
    "code_decode",
    f"""SELECT p_partkey, p_brand || chr(350 + (p_partkey % 30)::INTEGER) || CASE
  WHEN code = 140 THEN 'Ś' WHEN code = 150 THEN '–' WHEN code = 154 THEN 'š' WHEN code = 189 THEN '˝' WHEN code = 190 THEN 'ľ'
  WHEN code >= 192 THEN substring('{_UPPER}', code - 191, 1) ELSE chr(code) END || '/c99999999999!' AS decoded
FROM (SELECT *, (CASE p_partkey % 9 WHEN 0 THEN 140 WHEN 1 THEN 150 WHEN 2 THEN 154 WHEN 3 THEN 189 WHEN 4 THEN 190 WHEN 5 THEN 97
  ELSE 192 + p_partkey % 64 END)::INTEGER AS code FROM part)""",
)
def code_decode(spark, sf_dir):
    key = F.col("p_partkey")
    special = F.coalesce(F.get(F.array(*[F.lit(c) for c in (140, 150, 154, 189, 190, 97)]).cast("array<bigint>"), (key % 9).cast("int")), 192 + key % 64)
    coded = F.concat("p_brand", F.lit("/c"), (key % 30 + 350).cast("string"), F.lit("/c"), special.cast("string"), F.lit("/c99999999999!"))
    return table(spark, sf_dir, "part").select("p_partkey", text.decoded(coded).alias("decoded"))


@query(
    "semver_check",
    "SELECT p_partkey, (p_size % 3)::INTEGER AS major, p_size % 3 = 1 AND p_partkey % 7 <= 4 AS fits FROM part",
)
def semver_check(spark, sf_dir):
    version = F.concat_ws(".", (F.col("p_size") % 3).cast("string"), (F.col("p_partkey") % 7).cast("string"), F.lit("2-rc.1"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.version_parts(version)["major"].alias("major"), text.compatible(version, (1, 4, 0)).alias("fits")
    )


@query(
    "join_tokens",
    "SELECT l_orderkey, l_linenumber, l_partkey, 'Daň(§ ' || l_partkey || '), platí.' AS joined FROM lineitem",
)
def join_tokens(spark, sf_dir):
    tokens = F.array(*[F.lit(x) for x in ("Daň", "(", "§")], F.col("l_partkey").cast("string"), *[F.lit(x) for x in (")", ",", " ", "platí", ".")])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.join_tokens(tokens).alias("joined"))


@query(
    "written_tables",
    "SELECT p_partkey, 6 AS start, 'Úvod. Koniec.' AS rest, (p_partkey || ', 1 = 2 roky;1, 1 = ' || p_size || ' roky') AS rows FROM part",
)
def written_tables(spark, sf_dir):
    body = F.concat(
        F.lit("Úvod. Skupina, 1 = Doba. "), F.col("p_partkey").cast("string"), F.lit(", 1 = 2 roky. 1, 1 = "),
        F.col("p_size").cast("string"), F.lit(" roky. Koniec."),
    )
    found = refs.written_table(body)
    return table(spark, sf_dir, "part").select(
        "p_partkey", (found["start"] + 1).alias("start"), found["rest"].alias("rest"), F.array_join(found["rows"], ";").alias("rows")
    )


@query(
    "link_targets",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey::VARCHAR AS paragraph, l_linenumber::VARCHAR AS odsek, lower(l_returnflag) AS pismeno, l_partkey::INTEGER AS table_no FROM lineitem",
)
def link_targets(spark, sf_dir):
    link = F.concat(
        F.lit("#paragraf-"), F.col("l_orderkey").cast("string"), F.lit(".odsek-"), F.col("l_linenumber").cast("string"),
        F.lit(".pismeno-"), F.lower("l_returnflag"),
    )
    target = refs.link_target(link)
    number = refs.table_index(F.concat(F.lit("#/tables/"), F.col("l_partkey").cast("string")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *[target[k].alias(k) for k in ("paragraph", "odsek", "pismeno")], number.alias("table_no")
    )


@query(
    "content_hashes",
    "SELECT doc_id, sha256(text) AS hash, (length(text) - length(replace(text, chr(10), '')) + 1)::INTEGER AS n_lines FROM documents",
)
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2("text", 256).alias("hash"), text.line_number(F.col("text"), F.length("text")).alias("n_lines")
    )


# Joins


@query(
    "asof_event",
    """SELECT event_id, user_id, event_type,
  last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS signup FROM events""",
)
def asof_event(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    found = context.last_before(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "signup", "event_id", "signup")
    return found.select("event_id", "user_id", "event_type", "signup")


_WORDS = "list_distinct(list_filter(string_split(trim(regexp_replace(strip_accents(lower(replace(text, 'ß', 's'))), '\\s+', ' ', 'g')), ' '), lambda w: w <> ''))"


@query(
    "table_fuzzy_top1",
    f"""WITH mine AS (SELECT item_id AS text_id, unnest({_WORDS}) AS word FROM benchmark),
sizes AS (SELECT text_id, count(*) AS words FROM mine GROUP BY 1),
theirs AS (SELECT turn_id AS table_id, unnest({_WORDS}) AS word FROM (SELECT conv_id * 1000 + turn AS turn_id, text FROM conversations)),
common AS (SELECT text_id, table_id, count(*) AS common FROM mine JOIN theirs USING (word) GROUP BY ALL)
SELECT text_id, table_id, common, words FROM common JOIN sizes USING (text_id) WHERE common >= 0.2 * words
QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY common DESC, table_id) = 1""",
)
def table_fuzzy_top1(spark, sf_dir):
    plain = lambda c: F.replace(F.col(c), F.lit("ß"), F.lit("s"))
    wanted = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("text_id"), plain("text").alias("text"))
    held = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("table_id"), plain("text").alias("header")
    )
    return tables.best_header_match(wanted, held, 0.2)


@query(
    "table_position_range_join_whole",
    """WITH u AS (SELECT user_id AS doc_id, event_id AS unit_id, event_id AS a, event_id + 20 AS b FROM events),
t AS (SELECT user_id AS doc_id, event_id AS table_id, event_id + 22 AS pos FROM events WHERE event_type = 'error'),
m AS (SELECT t.doc_id, table_id, unit_id, a, CASE WHEN pos >= a AND pos < b THEN 1 ELSE 2 END AS priority FROM t JOIN u ON t.doc_id = u.doc_id AND pos >= a - 5 AND pos < b + 5)
SELECT doc_id, table_id, unit_id, priority FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, table_id ORDER BY priority, a, unit_id) = 1""",
)
def table_position_range_join_whole(spark, sf_dir):
    """Every event's range is a unit; tables stand just behind that of their own event, so both priorities occur."""
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "doc_id")
    units = events.select("doc_id", F.col("event_id").alias("unit_id"), F.col("event_id").alias("start"), (F.col("event_id") + 20).alias("end"))
    held = events.filter("event_type = 'error'").select("doc_id", F.col("event_id").alias("table_id"), (F.col("event_id") + 22).alias("pos"))
    return tables.assigned_by_position(held, units)


@query(
    "unassigned_and_duplicate",
    """SELECT doc_id AS table_id, 'unassigned' AS finding, 0 AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT l_orderkey, 'twice', count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def unassigned_and_duplicate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("table_id"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("table_id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"))
    none = tables.unassigned(docs, known).select("table_id", F.lit("unassigned").alias("finding"), F.lit(0).cast("long").alias("n"))
    return none.unionByName(tables.assigned_twice(lines).select("table_id", F.lit("twice").alias("finding"), "n"))


@query(
    "classify_tables",
    """SELECT p_partkey, p_partkey % 5 <> 0 AND (p_size % 8 IN (0, 1, 2, 4, 5, 6) OR (p_partkey % 3 = 0 AND p_partkey % 100 < 50)) AS metadata FROM part""",
)
def classify_tables(spark, sf_dir):
    said = ("História", "číslo predpisu: 7", " 366/1999 Z. z. ", "Odpisy podľa predpisu", "Účinnosť od 1. 1. 2004",
            "Predpis ruší 1/2000", "Dátum účinnosti", "Moja História")
    law = F.when(F.col("p_partkey") % 2 == 0, "Ročný odpis").otherwise("sadzba dane")
    cells = F.array(
        F.col("p_name"), F.get(F.array(*map(F.lit, said)), (F.col("p_size") % 8).cast("int")),
        F.when(F.col("p_partkey") % 5 == 0, law).otherwise("y"),
    )
    parent = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey") % 100)
    return table(spark, sf_dir, "part").select("p_partkey", tables.is_metadata(cells, parent).alias("metadata"))


@query(
    "table_context",
    """WITH ln AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY ALL),
el AS (
  SELECT o_custkey AS doc_id, o_orderkey * 100 AS pos, 's' AS kind, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 < 2 THEN o_orderkey END AS s, NULL::INTEGER AS n FROM orders
  UNION ALL SELECT o_custkey, o_orderkey * 100 + l_linenumber * 10, 'n', NULL, CASE WHEN p % 3 <> 0 THEN l_linenumber END FROM ln JOIN orders ON o_orderkey = l_orderkey
  UNION ALL SELECT o_custkey, o_orderkey * 100 + l_linenumber * 10 + 1, 't', NULL, NULL FROM ln JOIN orders ON o_orderkey = l_orderkey),
c AS (SELECT *, last_value(s IGNORE NULLS) OVER w AS section, last_value(CASE WHEN s IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS sp,
    last_value(n IGNORE NULLS) OVER w AS odsek, last_value(CASE WHEN n IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS np
  FROM el WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, pos, section::VARCHAR AS section, CASE WHEN np > coalesce(sp, -1) THEN odsek::VARCHAR END AS subsection FROM c WHERE kind = 't'""",
)
def table_context(spark, sf_dir):
    from vellum.operators.context import table_context as contexts

    orders = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey").cast("string")
    forms = F.array(*[F.concat(F.lit(a), number, F.lit(b)) for a, b in (("§ ", ""), (" § ", " Názov"), ("§ ", " ods. 1 takto:"), ("§ ", " názov"))])
    sections = orders.select(
        F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") * 100).alias("pos"), F.lit("text").alias("kind"),
        F.get(forms, (F.col("o_orderkey") % 4).cast("int")).alias("text"), (F.col("o_orderkey") % 7 == 0).alias("in_group"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    lines = lines.join(orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    at = F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10
    odsek = F.struct(
        at.alias("pos"), F.lit("text").alias("kind"), F.concat(F.lit("("), F.col("l_linenumber").cast("string"), F.lit(")")).alias("text"),
        (F.col("p") % 3 == 0).alias("in_group"),
    )
    held = F.struct((at + 1).alias("pos"), F.lit("table").alias("kind"), F.lit("").alias("text"), F.lit(False).alias("in_group"))
    nodes = sections.unionByName(lines.select(F.col("o_custkey").alias("doc_id"), F.inline(F.array(odsek, held))))
    return contexts(nodes)


@query(
    "embedded_letters",
    """SELECT p_partkey, 'Na účely tohto zákona sa rozumie' || chr(10) || chr(9) || 'a) ' || p_name || chr(10) || chr(9) || '   ' || lower(p_type) || chr(10)
  || chr(9) || chr(9) || p_size || '. ' || p_brand || chr(10) || chr(9) || chr(9) || '   ' || p_type || chr(10) || chr(10) || chr(9) || chr(9) || '2a.' AS formatted,
  chr(9) || '(' || p_size || ') ' || p_brand || chr(10) || chr(9) || repeat(' ', length(p_size::VARCHAR) + 3) || p_type || chr(10) AS marked FROM part""",
)
def embedded_letters(spark, sf_dir):
    from vellum.functions import render

    lines = ["Na účely tohto zákona sa rozumie", F.concat(F.lit("a)  "), "p_name"), F.lower("p_type")]
    lines += [F.concat(F.col("p_size").cast("string"), F.lit(".  "), "p_brand"), F.col("p_type"), "", " 2a. "]
    joined = F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])
    marker = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")"))
    body = F.concat(F.lit(" "), "p_brand", F.lit("\n"), "p_type", F.lit(" \n"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", render.embedded_letters(joined).alias("formatted"), render.marked_text(marker, body, 1).alias("marked")
    )


@query(
    "manifest_integrate",
    """SELECT n_nationkey AS law, c_custkey AS number, CASE WHEN c_custkey % 3 = 0 THEN 'external' ELSE 'inline' END AS kind,
  CASE WHEN o_n IS NOT NULL THEN 'found' WHEN c_custkey % 3 = 0 THEN 'not_available' ELSE 'not_found' END AS status, coalesce(o_n, 0) AS n
FROM nation JOIN customer ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS o_n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def manifest_integrate(spark, sf_dir):
    from vellum.operators.annexes import integrated

    manifest = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("law"), F.col("c_custkey").alias("number"),
        F.when(F.col("c_custkey") % 3 == 0, "external").otherwise("inline").alias("kind"),
    )
    content = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("number")).agg(F.count("*").alias("n"))
    laws = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("law"))
    return integrated(manifest.join(laws, "law"), content, "number").select("law", "number", "kind", "status", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "manifest_summary",
    """SELECT c_nationkey AS law, count(*) AS total, count(*) FILTER (c_custkey % 3 = 0) AS external, count(*) FILTER (c_custkey % 3 <> 0) AS inline FROM customer GROUP BY 1""",
)
def manifest_summary(spark, sf_dir):
    from vellum.operators.annexes import summary

    manifest = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("law"), F.when(F.col("c_custkey") % 3 == 0, "external").otherwise("inline").alias("kind")
    )
    return summary(manifest, "law")


@query(
    "annex_detect_first_wins",
    """SELECT conv_id, turn % 2 AS number, min(turn) AS pos FROM conversations GROUP BY ALL""",
)
def annex_detect_first_wins(spark, sf_dir):
    from vellum.operators.annexes import detected

    items = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.lit(None).cast("string").alias("hyperlink"),
        F.concat(F.lit("Príloha č. "), (F.col("turn") % 2).cast("string")).alias("text"),
    )
    return detected(items).select(F.col("doc_id").alias("conv_id"), F.col("number").cast("long").alias("number"), "pos")


@query(
    "kv_links",
    """SELECT r_regionkey AS source, string_agg(n_name, ', ' ORDER BY n_nationkey) AS targets, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""",
)
def kv_links(spark, sf_dir):
    cells = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("cell_id"), F.col("n_name").alias("text"))
    links = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("source"), F.col("n_nationkey").alias("target"))
    return trees.value_targets(cells, links)


@query(
    "kv_dangling",
    "SELECT s_suppkey AS source, s_nationkey + 20 AS target FROM supplier WHERE s_nationkey + 20 NOT IN (SELECT n_nationkey FROM nation) GROUP BY ALL",
)
def kv_dangling(spark, sf_dir):
    links = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"), (F.col("s_nationkey") + 20).alias("target"))
    cells = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("cell_id"))
    every = cells.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell_id")))
    ok = trees.dangling(every, links.filter("false"))
    return links.join(cells, links["target"] == cells["cell_id"], "left_anti").distinct().unionByName(ok)


# Windows and intervals


@query(
    "adjacent_merge",
    """WITH s AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM s)
SELECT user_id, island::BIGINT AS island, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM i GROUP BY ALL""",
)
def adjacent_merge(spark, sf_dir):
    return tables.merged_neighbours(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type")


_RANGES = "SELECT user_id, event_id AS a, event_id + (event_id % 7) * 40 AS b FROM events"


@query(
    "gap_merge",
    f"""WITH r AS ({_RANGES}), f AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM r),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM f),
m AS (SELECT user_id, min(a) AS a, max(b) AS b FROM i GROUP BY user_id, island),
n AS (SELECT *, lead(a) OVER (PARTITION BY user_id ORDER BY a) AS following FROM m)
SELECT user_id, b AS start, following AS "end" FROM n WHERE following > b""",
)
def gap_merge(spark, sf_dir):
    ranges = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("start"), (F.col("event_id") + (F.col("event_id") % 7) * 40).alias("end")
    )
    return analytics.gaps(analytics.merged_ranges(ranges, "user_id"), "user_id")


@query(
    "heading_path_whole",
    """WITH i AS (SELECT conv_id AS doc_id, turn AS pos, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 END AS level, text FROM conversations),
h AS (SELECT *, last_value(CASE WHEN level = 1 THEN pos END IGNORE NULLS) OVER w AS p1, last_value(CASE WHEN level = 2 THEN pos END IGNORE NULLS) OVER w AS p2 FROM i WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT h.doc_id, h.pos, h.text, concat_ws(' > ', a.text, CASE WHEN p2 > coalesce(p1, -1) THEN b.text END) AS path
FROM h LEFT JOIN i a ON a.doc_id = h.doc_id AND a.pos = p1 LEFT JOIN i b ON b.doc_id = h.doc_id AND b.pos = p2 WHERE h.level IS NULL""",
)
def heading_path_whole(spark, sf_dir):
    """Each turn's headings, the system's and the user's turns before it."""
    return chunks.heading_paths(_turns(spark, sf_dir), 2)


def _turns(spark, sf_dir):
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2)
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), level.alias("level"), "text"
    )


@query(
    "contextualised_chunks_whole",
    """SELECT c.conv_id AS doc_id, c.turn AS pos, coalesce(nullif(u.text, '') || chr(10), '') || c.text AS context
FROM conversations c LEFT JOIN conversations u ON u.conv_id = c.conv_id AND u.role = 'user' AND u.turn = (SELECT max(turn) FROM conversations x WHERE x.conv_id = c.conv_id AND x.role = 'user' AND x.turn < c.turn)
WHERE c.role = 'assistant'""",
)
def contextualised_chunks_whole(spark, sf_dir):
    """Texts to embed: each answer under the question before it."""
    turns = _turns(spark, sf_dir).filter("level IS NULL OR level = 2")
    kept = table(spark, sf_dir, "conversations").filter("role = 'assistant'").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"))
    found = chunks.heading_paths(turns, 2).join(kept, ["doc_id", "pos"], "left_semi")
    return chunks.contextualised(found).select("doc_id", "pos", "context")


@query(
    "page_chunks",
    "SELECT conv_id AS doc_id, turn // 4 AS page_no, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS n_items FROM conversations GROUP BY ALL",
)
def page_chunks(spark, sf_dir):
    items = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.expr("turn div 4").alias("page_no"), "text"
    )
    return chunks.page_chunks(items)


@query(
    "page_breaks",
    "SELECT conv_id AS doc_id, turn AS pos FROM (SELECT *, lag(turn // 4) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE turn // 4 > p",
)
def page_breaks(spark, sf_dir):
    items = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.expr("turn div 4").alias("page_no"))
    return trees.page_breaks(items).select("doc_id", "pos")


@query("hybrid_pack")
def hybrid_pack(spark, sf_dir):
    lines = items_from_documents(spark, sf_dir).select("doc_id", "pos", F.lit("").alias("path"), F.col("line").alias("text"))
    return packing.packed(lines, 64)


@query(
    "hybrid_pack_totals",
    r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS words, true AS within FROM documents WHERE regexp_matches(text, '\S')",
)
def hybrid_pack_totals(spark, sf_dir):
    made = hybrid_pack(spark, sf_dir)
    return made.groupBy("doc_id").agg(F.sum("tokens").alias("words"), (F.max("tokens") <= 64).alias("within"))


@query(
    "token_chunks",
    r"""SELECT doc_id, md5(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS whole, true AS within, true AS tight FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]')""",
)
def token_chunks(spark, sf_dir):
    """Lines under their document's language and source as headings, by a real tokenizer: nothing lost, nothing above the budget, no chunk too many."""
    import public_tokenizers

    lines = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    heading = F.concat_ws("\n", "lang", "source")
    limit = budget.Budget(128, vocabulary=public_tokenizers.path("word_bpe_49k.json"))
    facts = budget.judged(budget.token_chunks(lines.select("doc_id", "pos", heading.alias("path"), "text"), limit), limit)
    return facts.select("doc_id", F.md5(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).alias("whole"), "within", "tight")


# Trees and documents


def _star_edges(spark, sf_dir):
    """Regions, nations, customers and their orders as a tree a region."""
    nations = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    regions = table(spark, sf_dir, "region")
    node = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    edge = lambda rows, doc, kind, key, parent: rows.select(
        F.col(doc).cast("long").alias("doc_id"), node(kind, key).alias("node"), parent.alias("parent"), F.col(key).cast("long").alias("ord")
    )
    return (
        edge(regions, "r_regionkey", "r", "r_regionkey", F.lit(None).cast("string"))
        .unionByName(edge(nations, "n_regionkey", "n", "n_nationkey", node("r", "n_regionkey")))
        .unionByName(edge(customers, "n_regionkey", "c", "c_custkey", node("n", "c_nationkey")))
    )


_TREE = """WITH tree AS (
  SELECT r_regionkey::BIGINT AS doc_id, 'r' || r_regionkey AS node, NULL AS parent, 0 AS depth, r_regionkey AS a, -1 AS b, -1 AS c FROM region
  UNION ALL SELECT n_regionkey, 'n' || n_nationkey, 'r' || n_regionkey, 1, n_regionkey, n_nationkey, -1 FROM nation
  UNION ALL SELECT n_regionkey, 'c' || c_custkey, 'n' || n_nationkey, 2, n_regionkey, n_nationkey, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query("tree_scan", _TREE + " SELECT doc_id, node, depth, (row_number() OVER (PARTITION BY doc_id ORDER BY a, b, c) - 1)::INTEGER AS pos FROM tree")
def tree_scan(spark, sf_dir):
    return trees.numbered(trees.paths(_star_edges(spark, sf_dir))).select("doc_id", "node", "depth", "pos")


@query("subtree_delete", _TREE + " SELECT doc_id, node FROM tree WHERE NOT (b >= 0 AND b % 4 = 0)")
def subtree_delete(spark, sf_dir):
    edges = _star_edges(spark, sf_dir)
    gone = edges.filter("node LIKE 'n%' AND ord % 4 = 0")
    return trees.without_subtrees(trees.paths(edges), gone).select("doc_id", "node")


@query("subtree_extract", _TREE + " SELECT doc_id, node, depth FROM tree WHERE b >= 0 AND b % 4 = 0")
def subtree_extract(spark, sf_dir):
    edges = _star_edges(spark, sf_dir)
    return trees.subtree(trees.paths(edges), edges.filter("node LIKE 'n%' AND ord % 4 = 0")).select("doc_id", "node", "depth")


@query("page_filter_reparent", _TREE + " SELECT doc_id, node, CASE WHEN depth = 2 THEN 'r' || doc_id END AS new_parent FROM tree WHERE depth <> 1")
def page_filter_reparent(spark, sf_dir):
    kept = trees.kept_with_new_parents(trees.paths(_star_edges(spark, sf_dir)), F.col("depth") != 1)
    return kept.select("doc_id", "node", "new_parent")


@query(
    "depth_stats",
    _TREE
    + """, s AS (SELECT doc_id, list_sort(list(depth)) AS d, count(*) AS n, round(avg(depth), 6) AS mean FROM tree GROUP BY 1)
SELECT doc_id, d[1]::INTEGER AS least, d[n]::INTEGER AS greatest, mean, d[n * 1 // 4 + 1]::INTEGER AS p25, d[n // 2 + 1]::INTEGER AS p50, d[n * 3 // 4 + 1]::INTEGER AS p75, d[n * 9 // 10 + 1]::INTEGER AS p90 FROM s""",
)
def depth_stats(spark, sf_dir):
    return analytics.depth_stats(trees.paths(_star_edges(spark, sf_dir)), "doc_id", "depth")


@query("top_labels", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 5")
def top_labels(spark, sf_dir):
    return analytics.most_frequent(table(spark, sf_dir, "events"), "event_type", 5)


@query(
    "concat_documents",
    """WITH i AS (SELECT conv_id, conv_id % 10 AS grp, turn AS pos, turn // 4 + 1 AS page FROM conversations),
s AS (SELECT conv_id, grp, max(page) AS pages, max(pos) + 1 AS n FROM i GROUP BY ALL),
o AS (SELECT conv_id, coalesce(sum(pages) OVER w, 0) AS ps, coalesce(sum(n) OVER w, 0) AS ns FROM s WINDOW w AS (PARTITION BY grp ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT grp, (pos + ns)::BIGINT AS pos, (page + ps)::BIGINT AS page_no, conv_id AS from_doc FROM i JOIN o USING (conv_id)""",
)
def concat_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    items = rows.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.expr("turn div 4 + 1").alias("page_no"))
    docs = rows.select(F.col("conv_id").alias("doc_id"), F.col("conv_id").alias("ord"), (F.col("conv_id") % 10).alias("grp")).distinct()
    return trees.concatenated(items, docs, "grp")


@query(
    "insert_siblings",
    """WITH o AS (SELECT conv_id AS doc_id, role AS parent, turn::VARCHAR AS node, turn::DOUBLE AS place FROM conversations),
n AS (SELECT doc_id, parent, 'new' || node AS node, place + 0.5 AS place FROM o WHERE place % 4 = 1)
SELECT doc_id, parent, node, (row_number() OVER (PARTITION BY doc_id, parent ORDER BY place) - 1)::INTEGER AS ord FROM (SELECT * FROM o UNION ALL SELECT * FROM n)""",
)
def insert_siblings(spark, sf_dir):
    old = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("role").alias("parent"), F.col("turn").cast("string").alias("node"), F.col("turn").alias("ord")
    )
    new = old.filter("ord % 4 = 1").select("doc_id", "parent", F.col("node").alias("after"), F.concat(F.lit("new"), "node").alias("node"))
    return trees.inserted(old, new)


@query(
    "compare_documents",
    """WITH a AS (SELECT * FROM documents WHERE source = 'src0'), b AS (SELECT * FROM documents WHERE source = 'src1'),
k AS (SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS "both", count(*) FILTER (b IS NULL) AS only_a, count(*) FILTER (a IS NULL) AS only_b
  FROM (SELECT DISTINCT text AS a FROM a) FULL JOIN (SELECT DISTINCT text AS b FROM b) ON a = b)
SELECT *, round(100 * (length_b - length_a) / length_a, 6) AS change FROM (SELECT "both", only_a, only_b FROM k),
  (SELECT count(*) AS texts_a, sum(length(text))::BIGINT AS length_a FROM a), (SELECT count(*) AS texts_b, sum(length(text))::BIGINT AS length_b FROM b)""",
)
def compare_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return analytics.compared(docs.filter("source = 'src0'"), docs.filter("source = 'src1'"), "text", "text")


# Tables


_CELLS = """WITH ln AS (SELECT l_orderkey AS table_id, l_partkey, l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) - 1 AS r FROM lineitem),
grid AS (SELECT table_id, r::INTEGER AS r, x.c AS c, x.t AS text FROM (SELECT *, unnest([{'c': 0, 't': 'row ' || r}, {'c': 1, 't': l_returnflag}, {'c': 2, 't': (l_quantity::BIGINT)::VARCHAR}]) AS x FROM ln))"""


def _cells(spark, sf_dir):
    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")) - 1
    rows = table(spark, sf_dir, "lineitem").withColumn("r", place)
    cell = lambda c, x: F.struct(F.lit(c).alias("c0"), F.lit(c + 1).alias("c1"), x.alias("text"))
    texts = F.concat(F.lit("row "), F.col("r").cast("string")), F.col("l_returnflag"), F.col("l_quantity").cast("long").cast("string")
    spread = rows.select("l_orderkey", "r", F.inline(F.array(*[cell(c, x) for c, x in enumerate(texts)])))
    return spread.select(
        F.col("l_orderkey").alias("table_id"), F.col("r").alias("r0"), (F.col("r") + 1).alias("r1"), "c0", "c1", "text",
        (F.col("r") == 0).alias("column_header"), (F.col("c0") == 0).alias("row_header"), F.lit(False).alias("row_section"),
    )


@query("grid_densify", _CELLS + " SELECT table_id, r, c, CASE WHEN c = 2 AND r % 2 = 1 THEN '' ELSE text END AS text FROM grid WHERE true")
def grid_densify(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    # Every other last cell lacks; the first one keeps the grid as wide.
    return tables.densified(cells.filter("NOT (c0 = 2 AND r0 % 2 = 1)"))


@query(
    "table_markdown",
    _CELLS
    + """, rows AS (SELECT table_id, r, '| ' || string_agg(text, ' | ' ORDER BY c) || ' |' AS line FROM grid GROUP BY ALL)
SELECT table_id, string_agg(line || CASE WHEN r = 0 THEN chr(10) || '| --- | --- | --- |' ELSE '' END, chr(10) ORDER BY r) AS markdown FROM rows GROUP BY 1""",
)
def table_markdown(spark, sf_dir):
    return tables.as_markdown(tables.densified(_cells(spark, sf_dir)))


@query(
    "table_html",
    _CELLS
    + """, rows AS (SELECT table_id, r, '<tr>' || string_agg(CASE WHEN r = 0 OR c = 0 THEN '<th>' || text || '</th>' ELSE '<td>' || text || '</td>' END, '' ORDER BY c) || '</tr>' AS line FROM grid GROUP BY ALL)
SELECT table_id, '<table>' || string_agg(line, '' ORDER BY r) || '</table>' AS html FROM rows GROUP BY 1""",
)
def table_html(spark, sf_dir):
    return tables.as_html(_cells(spark, sf_dir))


@query(
    "table_tokens",
    _CELLS
    + """, rows AS (SELECT table_id, r, string_agg(CASE WHEN r = 0 THEN '<ched>' WHEN c = 0 THEN '<rhed>' ELSE '<fcel>' END || text, '' ORDER BY c) || '<nl>' AS line FROM grid GROUP BY ALL)
SELECT table_id, string_agg(line, '' ORDER BY r) AS tokens FROM rows GROUP BY 1""",
)
def table_tokens(spark, sf_dir):
    return tables.as_tokens(_cells(spark, sf_dir))


@query(
    "unpivot_triplets",
    _CELLS
    + """, h AS (SELECT table_id, c, text AS col FROM grid WHERE r = 0), s AS (SELECT table_id, r, text AS rw FROM grid WHERE c = 0)
SELECT g.table_id, string_agg(rw || ', ' || col || ' = ' || g.text, '. ' ORDER BY g.r, g.c) AS triplets FROM grid g JOIN h ON h.table_id = g.table_id AND h.c = g.c JOIN s ON s.table_id = g.table_id AND s.r = g.r
WHERE g.r > 0 AND g.c > 0 GROUP BY 1""",
)
def unpivot_triplets(spark, sf_dir):
    return tables.triplets(tables.densified(_cells(spark, sf_dir)))


@query(
    "grid_row_edit",
    _CELLS + " SELECT table_id, (dense_rank() OVER (PARTITION BY table_id ORDER BY r) - 1)::INTEGER AS r0, c AS c0, text FROM grid WHERE r % 3 <> 1",
)
def grid_row_edit(spark, sf_dir):
    return tables.without_rows(_cells(spark, sf_dir), F.col("r0") % 3 == 1).select("table_id", "r0", "c0", "text")


@query(
    "row_split",
    """SELECT p_partkey, x.i AS item, x.k AS kp, x.n AS name FROM (SELECT p_partkey, unnest(CASE WHEN p_size % 2 = 0
  THEN [{'i': '4-' || p_partkey, 'k': '30.1', 'n': 'dojnice živé'}, {'i': '4-' || (p_partkey + 1), 'k': '30.2', 'n': 'Býky plemenné'}]
  ELSE [{'i': '4-' || p_partkey, 'k': '30.1 30.2', 'n': 'dojnice živé Býky plemenné'}] END) AS x FROM part)""",
)
def row_split(spark, sf_dir):
    number = F.col("p_partkey")
    item = F.concat(F.lit("4-"), number.cast("string"))
    two = F.concat(item, F.lit(" 4-"), (number + 1).cast("string"))
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, two).otherwise(item).alias("item"), F.lit("30.1 30.2").alias("kp"),
        F.lit("dojnice živé Býky plemenné").alias("name"),
    )
    return tables.split_rows(rows).select("p_partkey", "item", "kp", "name")


@query(
    "missing_rows_append",
    """WITH a AS (SELECT o_custkey AS "group", o_custkey || '-' || o_orderkey AS item, o_orderpriority AS name, o_orderkey % 4 = 0 AS added, o_orderkey AS k FROM orders)
SELECT "group", item, name, added, (row_number() OVER (PARTITION BY "group" ORDER BY k) - 1)::INTEGER AS place FROM a""",
)
def missing_rows_append(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("group"), F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("item"),
        F.col("o_orderpriority").alias("name"), "o_orderkey",
    )
    held = rows.filter("o_orderkey % 4 <> 0").drop("o_orderkey")
    return tables.appended_missing(held, rows.drop("o_orderkey"))


# Geometry


def _boxes(spark, sf_dir):
    def e(k: int):
        # Rounding keeps the sign of what becomes zero.
        exact = F.element_at("embedding", k).cast("double") * 100
        rounded = F.round(exact, 3)
        return F.when((rounded == 0) & exact.cast("string").startswith("-"), F.lit(-0.0)).otherwise(rounded)

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label",
        g.box(F.least(e(1), e(2)), F.least(e(3), e(4)), F.greatest(e(1), e(2)), F.greatest(e(3), e(4))).alias("box"),
    )


_BOX = """WITH e AS (SELECT vec_id, label, round(embedding[1]::DOUBLE * 100, 3) AS a, round(embedding[2]::DOUBLE * 100, 3) AS b, round(embedding[3]::DOUBLE * 100, 3) AS c, round(embedding[4]::DOUBLE * 100, 3) AS d FROM embeddings),
box AS (SELECT vec_id, label, least(a, b) AS l, greatest(a, b) AS r, least(c, d) AS t, greatest(c, d) AS bo FROM e)"""


@query("bbox_enclosing", _BOX + " SELECT label, min(l) AS l, min(t) AS t, max(r) AS r, max(bo) AS b FROM box GROUP BY label")
def bbox_enclosing(spark, sf_dir):
    around = _boxes(spark, sf_dir).groupBy("label").agg(g.enclosing(F.col("box")).alias("box"))
    return around.select("label", *[F.col("box")[k].alias(k) for k in "ltrb"])


@query(
    "loc_tokens",
    _BOX
    + """ SELECT vec_id, '<loc_' || least(greatest(round_even(500 * l / 100, 0), 0), 499)::INTEGER || '><loc_' || least(greatest(round_even(500 * t / 100, 0), 0), 499)::INTEGER
  || '><loc_' || least(greatest(round_even(500 * r / 100, 0), 0), 499)::INTEGER || '><loc_' || least(greatest(round_even(500 * bo / 100, 0), 0), 499)::INTEGER || '>' AS tokens FROM box""",
)
def loc_tokens(spark, sf_dir):
    return _boxes(spark, sf_dir).select("vec_id", g.location_tokens(F.col("box"), F.lit(100.0), F.lit(100.0)).alias("tokens"))


@query(
    "fragment_rows",
    """WITH f AS (SELECT label AS doc_id, round_even(embedding[1]::DOUBLE * 1000 / 8, 0)::BIGINT * 8 AS rw, embedding[2]::DOUBLE AS x, vec_id::VARCHAR AS t FROM embeddings)
SELECT doc_id, rw AS "row", first(t ORDER BY x, t) AS item, string_agg(t, ' ' ORDER BY x, t) AS text FROM f GROUP BY ALL""",
)
def fragment_rows(spark, sf_dir):
    fragments = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("doc_id"), (F.element_at("embedding", 1).cast("double") * 1000).alias("top"),
        F.element_at("embedding", 2).cast("double").alias("left"), F.col("vec_id").cast("string").alias("text"),
    )
    return tables.fragment_rows(fragments)


@query(
    "reading_order",
    _BOX + " SELECT x.vec_id AS a, y.vec_id AS b, x.r + 0.001 < y.l AS left_of, x.bo + 0.001 < y.t AS above, least(x.r, y.r) - greatest(x.l, y.l) > 0 AS across FROM box x JOIN box y ON y.vec_id = x.vec_id + 1",
)
def reading_order(spark, sf_dir):
    boxes = _boxes(spark, sf_dir)
    x = boxes.select(F.col("vec_id").alias("a"), F.col("box").alias("p"))
    y = boxes.select(F.col("vec_id").alias("b"), F.col("box").alias("q"))
    met = x.join(y, F.col("b") == F.col("a") + 1)
    p, q = F.col("p"), F.col("q")
    return met.select(
        "a", "b", g.strictly_left(p, q).alias("left_of"), g.strictly_above(p, q).alias("above"), g.overlaps_across(p, q).alias("across")
    )


# Beyond parity


@query(
    "event_windows",
    "SELECT epoch_ms(epoch_ms(time_bucket(INTERVAL 5 MINUTE, ts))) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def event_windows(spark, sf_dir):
    """Beyond parity: events in windows of five minutes."""
    counted = table(spark, sf_dir, "events").groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n")


# Scans of markup


@query(
    "html_titles",
    r"SELECT page_id, trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM pages WHERE regexp_matches(html, '<title>')",
)
def html_titles(spark, sf_dir):
    return html.titles(table(spark, sf_dir, "pages"), "page_id", "html")


@query("html_elements")
def html_elements(spark, sf_dir):
    found = html.elements(table(spark, sf_dir, "pages"), "page_id", "html")
    return found.groupBy("page_id", "layer", "tag").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("length"))


@query("table_tokens_parse", _CELLS + " SELECT table_id, r AS r0, r + 1 AS r1, c AS c0, c + 1 AS c1, text FROM grid")
def table_tokens_parse(spark, sf_dir):
    from vellum.sources import markup

    tokens = tables.as_tokens(_cells(spark, sf_dir))
    return markup.table_cells(tokens, "table_id", "tokens").select("table_id", "r0", "r1", "c0", "c1", "text")


@query(
    "markup_items",
    "SELECT conv_id, (turn // 4 + 1)::INTEGER AS page_no, (row_number() OVER (PARTITION BY conv_id, turn // 4 ORDER BY turn) - 1)::INTEGER AS ord, CASE role WHEN 'user' THEN 'section_header' ELSE 'text' END AS label, trim(text) AS text FROM conversations",
)
def markup_items(spark, sf_dir):
    from vellum.sources import markup

    label = F.when(F.col("role") == "user", "section_header").otherwise("text")
    rows = table(spark, sf_dir, "conversations").withColumn("x", render.tagged(label, F.col("text"), F.lit(2), F.lit("<loc_1><loc_2><loc_3><loc_4>")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("turn", "x"))), lambda y: y["x"])
    pages = rows.groupBy("conv_id", F.expr("turn div 4").alias("page")).agg(F.array_join(ordered, "").alias("markup"))
    whole = F.transform(F.sort_array(F.collect_list(F.struct("page", "markup"))), lambda y: y["markup"])
    texts = pages.groupBy("conv_id").agg(F.array_join(whole, "<page_break>").alias("markup"))
    return markup.items(markup.pages_of(texts, "conv_id", "markup"), "conv_id").select("conv_id", "page_no", "ord", "label", "text")


@query(
    "code_chunks",
    "SELECT p_partkey, 'function' AS type, 'f' || p_size AS name, 3 AS start_line, 4 AS end_line, sha256('import math' || chr(10) || 'def f' || p_size || '():' || chr(10) || '    return math.pi') AS sha256 FROM part UNION ALL SELECT p_partkey, 'preamble', '', 1, 1, sha256('import math') FROM part",
)
def code_chunks(spark, sf_dir):
    from vellum.operators.code import code_chunks as chunked

    code = F.concat(F.lit("import math\n\ndef f"), F.col("p_size").cast("string"), F.lit("():\n    return math.pi"))
    files = table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))
    return chunked(files, "p_partkey", "code").select("p_partkey", "type", "name", "start_line", "end_line", "sha256")


@query(
    "first_candidates",
    "SELECT o_custkey, first(o_orderpriority ORDER BY o_orderpriority, o_orderkey) AS o_orderpriority, first(o_orderkey ORDER BY o_orderpriority, o_orderkey) AS o_orderkey FROM orders GROUP BY 1",
)
def first_candidates(spark, sf_dir):
    from vellum.operators.annexes import first_candidate

    return first_candidate(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "argmax_prediction",
    "SELECT user_id, first(event_type ORDER BY value DESC, event_type) AS event_type, max(value) AS value FROM events GROUP BY 1",
)
def argmax_prediction(spark, sf_dir):
    return analytics.argmax(table(spark, sf_dir, "events"), "user_id", "event_type", "value")


@query(
    "run_times",
    "SELECT event_type, count(*) AS runs, round(avg(event_id), 6) AS mean, min(event_id) AS least, max(event_id) AS greatest, round(stddev_pop(event_id), 3) AS deviation FROM events GROUP BY 1",
)
def run_times(spark, sf_dir):
    made = analytics.run_times(table(spark, sf_dir, "events"), "event_type", "event_id")
    return made.withColumn("deviation", F.round("deviation", 3))


@query(
    "nested_text",
    """SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""",
)
def nested_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
