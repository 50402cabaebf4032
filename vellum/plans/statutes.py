"""Queries over statutes: markers, hierarchy, references, chunks.

Their SQL makes the expected rows straight from the star schema that the streams come from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import chunks, context, sections, structure
from vellum.plans.registry import query
from vellum.sources.law_stream import law_items

ORD = """WITH ord AS (
  SELECT o_custkey AS doc_id, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
ln AS (SELECT doc_id, k, l.* FROM ord JOIN (SELECT l_orderkey, l_quantity, l_returnflag, l_linestatus, l_shipdate,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS l_linenumber FROM lineitem) l ON o_orderkey = l_orderkey)"""

UNITS = (
    ORD
    + """,
units AS (
  SELECT c_custkey AS doc_id, 'part-1' AS unit_id, 'part' AS level, 0 AS pos, c_mktsegment AS text FROM customer
  UNION ALL SELECT doc_id, 'paragraf-' || k, 'paragraph', k * 10000, o_orderpriority || ' podľa § ' || (o_orderkey % 5 + 1) FROM ord
  UNION ALL SELECT doc_id, 'odsek-' || k || '.' || l_linenumber, 'odsek', k * 10000 + l_linenumber * 100, 'flag ' || l_returnflag || '¹ [' || l_linenumber || ']' FROM ln
  UNION ALL SELECT doc_id, 'pismeno-' || k || '.' || l_linenumber || '.a', 'pismeno', k * 10000 + l_linenumber * 100 + 2, 'quantity ' || l_quantity::BIGINT FROM ln
  UNION ALL SELECT doc_id, 'pismeno-' || k || '.' || l_linenumber || '.b', 'pismeno', k * 10000 + l_linenumber * 100 + 4, 'status ' || l_linestatus || ':' FROM ln
  UNION ALL SELECT doc_id, 'subitem-' || k || '.' || l_linenumber || '.b.1', 'subitem', k * 10000 + l_linenumber * 100 + 6, 'ship ' || strftime(l_shipdate, '%Y-%m-%d') FROM ln
  UNION ALL SELECT c_custkey, 'annex-1', 'annex', 1000000001, 'Text prílohy ' || c_custkey FROM customer
  UNION ALL SELECT c_custkey, 'footnote-1', 'footnote', 1000000004, 'Zákon č. 1/1993 Z. z.' FROM customer)"""
)


def _units(spark, sf_dir, together=True):
    return structure.units(law_items(spark, sf_dir), together=together)


@query(
    "marker_detect",
    ORD
    + """
SELECT doc_id, level, count(*) AS n FROM (
  SELECT c_custkey AS doc_id, unnest(['part', 'annex', 'footnote']) AS level FROM customer
  UNION ALL SELECT doc_id, 'paragraph' FROM ord
  UNION ALL SELECT doc_id, unnest(['odsek', 'pismeno', 'pismeno', 'subitem']) FROM ln) GROUP BY ALL""",
)
def marker_detect(spark, sf_dir):
    found = structure.marked(law_items(spark, sf_dir)).filter("level IS NOT NULL")
    return found.groupBy("doc_id", "level").agg(F.count("*").alias("n"))


@query(
    "law_end_annex_mode",
    ORD
    + """
SELECT doc_id, zone, sum(n)::BIGINT AS n FROM (
  SELECT c_custkey AS doc_id, 'main' AS zone, 2 AS n FROM customer
  UNION ALL SELECT doc_id, 'main', 2 FROM ord UNION ALL SELECT doc_id, 'main', 8 FROM ln
  UNION ALL SELECT c_custkey, 'end', 1 FROM customer UNION ALL SELECT c_custkey, 'annex', 2 FROM customer
  UNION ALL SELECT c_custkey, 'notes', 3 FROM customer) GROUP BY ALL""",
)
def law_end_annex_mode(spark, sf_dir):
    return structure.zones(law_items(spark, sf_dir)).groupBy("doc_id", "zone").agg(F.count("*").alias("n"))


@query("unit_islands", UNITS + " SELECT doc_id, unit_id, level, pos::BIGINT AS pos, text FROM units")
def unit_islands(spark, sf_dir):
    return _units(spark, sf_dir, together=False).select("doc_id", "unit_id", "level", "pos", "text")


@query(
    "unit_counters",
    UNITS
    + """
SELECT doc_id, count(*) FILTER (level = 'part') AS parts, count(*) FILTER (level = 'paragraph') AS paragraphs,
  count(*) FILTER (level = 'odsek') AS odseks, count(*) FILTER (level = 'pismeno') AS pismenos,
  count(*) FILTER (level = 'subitem') AS subitems, count(*) FILTER (level = 'annex') AS annexs,
  count(*) FILTER (level = 'footnote') AS footnotes FROM units GROUP BY doc_id""",
)
def unit_counters(spark, sf_dir):
    return structure.counters(law_items(spark, sf_dir))


@query(
    "unit_text_offsets",
    UNITS
    + """
SELECT doc_id, p AS pos, split_part(split_part(unit_id, '-', 2), '.', 1) AS paragraph,
  coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, split_part(split_part(unit_id, '-', 2), '.', 1) ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position_in_text
FROM (SELECT *, pos + 1 AS p FROM units WHERE level IN ('paragraph', 'odsek', 'pismeno', 'subitem'))""",
)
def unit_text_offsets(spark, sf_dir):
    return structure.text_offsets(law_items(spark, sf_dir))


@query(
    "references_index",
    ORD
    + """
SELECT c_custkey AS doc_id, 'part-1' AS unit_id, NULL AS parent_id, 0 AS place FROM customer
UNION ALL SELECT doc_id, 'paragraf-' || k, 'part-1', k - 1 FROM ord
UNION ALL SELECT doc_id, 'odsek-' || k || '.' || l_linenumber, 'paragraf-' || k, row_number() OVER (PARTITION BY doc_id, k ORDER BY l_linenumber) - 1 FROM ln
UNION ALL SELECT doc_id, 'pismeno-' || k || '.' || l_linenumber || '.a', 'odsek-' || k || '.' || l_linenumber, 0 FROM ln
UNION ALL SELECT doc_id, 'pismeno-' || k || '.' || l_linenumber || '.b', 'odsek-' || k || '.' || l_linenumber, 1 FROM ln
UNION ALL SELECT doc_id, 'subitem-' || k || '.' || l_linenumber || '.b.1', 'pismeno-' || k || '.' || l_linenumber || '.b', 0 FROM ln
UNION ALL SELECT c_custkey, unnest(['annex-1', 'footnote-1']), NULL, 0 FROM customer""",
)
def references_index(spark, sf_dir):
    index = structure.references_index(_units(spark, sf_dir))
    return index.select("doc_id", "unit_id", "parent_id", F.col("place").cast("long").alias("place"))


@query(
    "extract_refs",
    ORD
    + """
SELECT doc_id, 'paragraf-' || k AS unit_id, 'paragraph' AS type, (o_orderkey % 5 + 1)::VARCHAR AS target, length(o_orderpriority || ' podľa ')::BIGINT AS position FROM ord""",
)
def extract_refs(spark, sf_dir):
    return context.references(_units(spark, sf_dir, together=False)).withColumn("position", F.col("position").cast("long"))


@query(
    "extract_footnotes",
    ORD
    + """
SELECT doc_id, 'odsek-' || k || '.' || l_linenumber AS unit_id, x.m AS marker, x.t AS type, x.p::BIGINT AS position FROM (
  SELECT *, unnest([{'m': '¹', 't': 'superscript', 'p': 6}, {'m': '[' || l_linenumber || ']', 't': 'bracket', 'p': 8}]) AS x FROM ln)""",
)
def extract_footnotes(spark, sf_dir):
    found = context.footnote_marks(_units(spark, sf_dir, together=False))
    return found.withColumn("position", F.col("position").cast("long"))


@query(
    "ref_occurrences",
    ORD
    + """
SELECT doc_id, 'paragraph' AS type, (o_orderkey % 5 + 1)::VARCHAR AS target, count(*) AS occurrences, count(*) AS units, min('paragraf-' || k) AS first_unit FROM ord GROUP BY ALL""",
)
def ref_occurrences(spark, sf_dir):
    return context.occurrences(context.references(_units(spark, sf_dir, together=False)))


@query(
    "resolve_refs_one_level",
    ORD
    + """,
refs AS (SELECT doc_id, 'paragraf-' || k AS unit_id, (o_orderkey % 5 + 1)::VARCHAR AS target, o_orderpriority || ' podľa § ' || (o_orderkey % 5 + 1) AS text FROM ord),
nested AS (SELECT doc_id, unit_id, string_agg(target, ',' ORDER BY target) AS t FROM refs WHERE 'paragraf-' || target <> unit_id GROUP BY ALL)
SELECT r.doc_id, r.unit_id, r.target, t.unit_id AS target_id, t.text AS target_text, n.t AS target_refers_to
FROM refs r LEFT JOIN refs t ON t.doc_id = r.doc_id AND t.unit_id = 'paragraf-' || r.target
LEFT JOIN nested n ON n.doc_id = t.doc_id AND n.unit_id = t.unit_id WHERE 'paragraf-' || r.target <> r.unit_id""",
)
def resolve_refs_one_level(spark, sf_dir):
    return context.resolved_one_level(_units(spark, sf_dir))


@query(
    "resolve_footnotes",
    ORD
    + """
SELECT doc_id, 'odsek-' || k || '.' || l_linenumber AS unit_id, l_linenumber::VARCHAR AS number,
  CASE WHEN l_linenumber = 1 THEN 'Zákon č. 1/1993 Z. z.' END AS footnote_text FROM ln""",
)
def resolve_footnotes(spark, sf_dir):
    return context.resolved_footnotes(_units(spark, sf_dir))


@query(
    "section_context",
    UNITS
    + """
SELECT doc_id, (pos + 1)::BIGINT AS pos, text, CASE WHEN level <> 'part' THEN split_part(split_part(unit_id, '-', 2), '.', 1) END AS paragraph,
  nullif(split_part(CASE WHEN level = 'part' THEN '' ELSE split_part(unit_id, '-', 2) END, '.', 2), '') AS odsek
FROM units WHERE level NOT IN ('annex', 'footnote')""",
)
def section_context(spark, sf_dir):
    return context.asof_context(law_items(spark, sf_dir))


@query(
    "superior_content",
    ORD
    + """
SELECT l.doc_id, unnest(['odsek-' || l.k || '.' || l_linenumber, 'pismeno-' || l.k || '.' || l_linenumber || '.a',
    'pismeno-' || l.k || '.' || l_linenumber || '.b', 'subitem-' || l.k || '.' || l_linenumber || '.b.1']) AS unit_id,
  'paragraf-' || l.k AS paragraph_id, o.o_orderpriority || ' podľa § ' || (o.o_orderkey % 5 + 1) AS paragraph_text, c_mktsegment AS part_text
FROM ln l JOIN ord o ON o.doc_id = l.doc_id AND o.k = l.k JOIN customer ON c_custkey = l.doc_id""",
)
def superior_content(spark, sf_dir):
    return context.superior(_units(spark, sf_dir))


_DEPTH = {"pismeno": 3, "odsek": 2, "paragraph": 1}


def _chunk_sql(level: str) -> str:
    name = {"paragraph": "paragraf"}.get(level, level)
    if level == "part":
        owner, where = "'part-1'", "level NOT IN ('annex', 'footnote')"
    else:
        d = _DEPTH[level]
        owner = f"'{name}-' || array_to_string(string_split(split_part(unit_id, '-', 2), '.')[1:{d}], '.')"
        where = f"level NOT IN ('part', 'annex', 'footnote') AND len(string_split(split_part(unit_id, '-', 2), '.')) >= {d}"
    bare = "UNION ALL SELECT doc_id, 'paragraf-' || k, 'paragraph', o_orderpriority || ' podľa § ' || (o_orderkey % 5 + 1), false, k * 10000 FROM ord WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
    bare = bare if level in ("odsek", "pismeno") else ""
    return f"""{UNITS},
owned AS (SELECT *, {owner} AS chunk_id FROM units WHERE {where}),
chunks AS (
  SELECT doc_id, chunk_id, '{level}' AS level, string_agg(text, chr(10) ORDER BY pos) AS content, bool_or(level = 'subitem') AS has_subitems, min(pos) AS pos FROM owned GROUP BY doc_id, chunk_id
  UNION ALL SELECT doc_id, unit_id, level, text, false, pos FROM units WHERE level = 'annex'
  {bare})"""


def _register(level: str) -> None:
    @query(
        f"unit_chunks_{level}",
        _chunk_sql(level) + " SELECT doc_id, chunk_id, level, content, has_subitems, pos::BIGINT AS pos, length(content)::INTEGER AS content_length FROM chunks",
    )
    def unit_chunks(spark, sf_dir):
        return chunks.unit_chunks(_units(spark, sf_dir), level)


for _level in chunks.CHUNK_LEVELS:
    _register(_level)


@query(
    "rag_projection",
    _chunk_sql("odsek")
    + """
SELECT doc_id, chunk_id, content AS text, '{"chunk_id":"' || chunk_id || '","level":"' || level || '","has_subitems":' || has_subitems || ',"content_length":' || length(content) || '}' AS metadata FROM chunks""",
)
def rag_projection(spark, sf_dir):
    return chunks.rag_records(chunks.unit_chunks(_units(spark, sf_dir), "odsek"))


@query(
    "chunks_markdown",
    _chunk_sql("paragraph")
    + """
SELECT doc_id, string_agg('## ' || chunk_id || chr(10) || chr(10) || content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos) AS markdown, count(*) AS n_chunks FROM chunks GROUP BY doc_id""",
)
def chunks_markdown(spark, sf_dir):
    return chunks.as_markdown(chunks.unit_chunks(_units(spark, sf_dir), "paragraph"))


@query(
    "chunk_level_counts",
    _chunk_sql("pismeno") + " SELECT level, count(*) AS n, sum(length(content))::BIGINT AS total_length FROM chunks GROUP BY level",
)
def chunk_level_counts(spark, sf_dir):
    made = chunks.unit_chunks(_units(spark, sf_dir), "pismeno")
    return made.groupBy("level").agg(F.count("*").alias("n"), F.sum("content_length").cast("long").alias("total_length"))


@query(
    "unit_rollup",
    ORD + " SELECT doc_id, k, count(*) AS n_odseks, sum(l_quantity)::BIGINT AS quantity FROM ln GROUP BY ROLLUP (doc_id, k)",
)
def unit_rollup(spark, sf_dir):
    """Beyond parity: counts of odseks for each paragraph, each document, and in all."""
    rows = structure.placed(law_items(spark, sf_dir)).filter("zone = 'main' AND odsek_at IS NOT NULL AND text LIKE 'quantity %'")
    rows = rows.select(
        "doc_id", F.col("paragraph_at.marker").cast("long").alias("k"), F.expr("cast(substring(text, 10) AS bigint)").alias("q")
    )
    return rows.rollup("doc_id", "k").agg(F.count("*").alias("n_odseks"), F.sum("q").alias("quantity"))


@query(
    "full_paragraph_blocks",
    ORD
    + """, n AS (SELECT doc_id, k, o_orderkey, lead(k) OVER (PARTITION BY doc_id ORDER BY k) AS nk FROM ord)
SELECT doc_id, k::VARCHAR AS paragraph, k * 10000 AS start, nk * 10000 AS "end" FROM n WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def full_paragraph_blocks(spark, sf_dir):
    return context.full_blocks(law_items(spark, sf_dir))


@query(
    "nested_sections",
    ORD
    + """,
odseks AS (
  SELECT doc_id, k, l_linenumber AS n, {type: 'odsek', marker: l_linenumber::VARCHAR, content: {text: 'flag ' || l_returnflag || '¹ [' || l_linenumber || ']',
    subsubsections: [
      {type: 'pismeno', marker: 'a', content: {text: 'quantity ' || l_quantity::BIGINT, subitems: []::STRUCT(type VARCHAR, marker VARCHAR, text VARCHAR)[]}},
      {type: 'pismeno', marker: 'b', content: {text: 'status ' || l_linestatus || ':', subitems: [{type: 'subitem', marker: '1', text: 'ship ' || strftime(l_shipdate, '%Y-%m-%d')}]}}],
    subitems: []::STRUCT(type VARCHAR, marker VARCHAR, text VARCHAR)[]}} AS odsek FROM ln)
SELECT doc_id, k * 10000 AS pos, k::VARCHAR AS marker, to_json({type: 'paragraph', marker: k::VARCHAR, content: {text: o_orderpriority || ' podľa § ' || (o_orderkey % 5 + 1),
  subsections: coalesce((SELECT list(odsek ORDER BY n) FROM odseks o WHERE o.doc_id = ord.doc_id AND o.k = ord.k), [])}})::VARCHAR AS section FROM ord""",
)
def nested_sections(spark, sf_dir):
    made = sections.nested(_units(spark, sf_dir))
    return made.select("doc_id", "pos", "marker", F.to_json("section").alias("section"))
