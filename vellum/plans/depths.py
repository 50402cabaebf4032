"""Levels from depths alone, over a stream of elements a customer."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.operators import depths
from vellum.plans.registry import query
from vellum.sources import table

_NODES = """WITH RECURSIVE nodes AS (
  SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos,
    (l_quantity::BIGINT % 4 + o_custkey % 5 * (l_quantity::BIGINT % 2))::INTEGER AS depth,
    CASE l_returnflag WHEN 'A' THEN '§ ' || l_linenumber WHEN 'N' THEN '(' || l_linenumber || ')' ELSE CASE l_linestatus WHEN 'F' THEN 'a)' ELSE 'ČASŤ' END END AS text
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
counts AS (SELECT doc_id, depth, count(*) AS n, min(pos) AS first FROM nodes GROUP BY ALL),
docs AS (
  SELECT doc_id, min(depth) AS low, max(depth) AS high, sum(n)::BIGINT AS rows, count(*) AS kinds, list(depth ORDER BY n DESC, first) AS often, min_by(n, depth) AS least FROM counts GROUP BY 1),
edges AS (
  SELECT *, CASE WHEN kinds < 3 THEN CASE WHEN least > rows // 4 THEN low ELSE high END WHEN often[1] < 3 THEN often[1] + 1 ELSE 1 END AS e1,
    CASE WHEN kinds < 3 THEN CASE WHEN least > 2 * rows // 4 THEN low ELSE high END ELSE often[2] + 1 END AS e2,
    CASE WHEN kinds < 3 THEN CASE WHEN least > 3 * rows // 4 THEN low ELSE high END ELSE often[3] + 1 END AS e3 FROM docs),
steps AS (SELECT *, greatest(e1, 2) AS a, greatest(e2, greatest(e1, 2) + 1) AS b, greatest(e3, greatest(e2, greatest(e1, 2) + 1) + 1) AS c FROM edges),
ends AS (SELECT *, CASE WHEN kinds < 3 THEN greatest(high, c + 1) ELSE high + 1 END AS d, CASE WHEN high <= 1 THEN low ELSE high END AS x FROM steps),
spans AS (
  SELECT doc_id, CASE WHEN high = 0 THEN [0, 2, 4, 6, 8] WHEN high - low <= 2 THEN [low, low, x, x, x + 1] ELSE [low, a, b, c, d] END AS f,
    CASE WHEN high = 0 THEN [1, 4, 6, 8] WHEN high - low <= 2 THEN [low, low, x, x] ELSE [least(e1, 2), b, c, d] END AS t FROM ends),
marked AS (
  SELECT doc_id, pos, depth, text, depth BETWEEN f[1] AND t[1] AND depth <= 1 AS i1, depth BETWEEN f[2] AND t[2] AS i2, depth BETWEEN f[3] AND t[3] AS i3,
    depth BETWEEN f[4] AND t[4] AS i4, depth >= f[5] AS i5, contains(lower(text), 'časť') AS m1, starts_with(text, '§') AS m2,
    starts_with(text, '(') AND length(text) <= 5 AS m3, text = 'a)' AS m4 FROM nodes JOIN spans USING (doc_id)),
walk AS (
  SELECT doc_id, 0::BIGINT AS pos, 0 AS depth, '' AS text, 0 AS state, 0 AS number FROM docs
  UNION ALL
  SELECT doc_id, pos, depth, text, CASE WHEN number BETWEEN 1 AND 4 THEN number ELSE state END, number FROM (
    SELECT m.doc_id, m.pos, m.depth, m.text, w.state,
      CASE WHEN w.state = 1 AND i2 THEN 2 WHEN w.state = 2 AND i3 THEN 3 WHEN w.state = 3 AND i4 THEN 4 WHEN w.state = 4 AND i5 THEN 5
        WHEN i4 AND (m4 OR w.state IN (2, 3)) THEN 4 WHEN i3 AND (m3 OR w.state = 2) THEN 3 WHEN i2 AND (m2 OR w.state IN (0, 1)) THEN 2
        WHEN i1 AND (m1 OR w.state = 0) THEN 1 WHEN i5 THEN 5 ELSE 0 END AS number
    FROM walk w JOIN marked m ON m.doc_id = w.doc_id AND m.pos = w.pos + 1))"""


@query(
    "depth_levels",
    _NODES + " SELECT doc_id, pos, depth, text, CASE number WHEN 1 THEN 'part' WHEN 2 THEN 'paragraph' WHEN 3 THEN 'odsek' WHEN 4 THEN 'pismeno' WHEN 5 THEN 'subitem' END AS level FROM walk WHERE pos > 0",
)
def depth_levels(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    order = W.partitionBy("o_custkey").orderBy("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    number = F.col("l_linenumber").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("§ "), number))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("("), number, F.lit(")")))
        .otherwise(F.when(F.col("l_linestatus") == "F", "a)").otherwise("ČASŤ"))
    )
    quantity = F.col("l_quantity").cast("long")
    depth = (quantity % 4 + F.col("o_custkey") % 5 * (quantity % 2)).cast("int")
    nodes = lines.select(F.col("o_custkey").alias("doc_id"), F.row_number().over(order).cast("long").alias("pos"), depth.alias("depth"), text.alias("text"))
    return depths.classified(nodes)
