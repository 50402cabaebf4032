"""References followed through laws: a customer is a law, an order a paragraph; some laws are in no register."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.operators import closure
from vellum.plans.registry import query
from vellum.sources import table

DEPTH = 3


@query(
    "reference_closure",
    """WITH RECURSIVE ord AS (
  SELECT o_custkey AS doc_id, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, o_orderpriority AS p,
    CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE (o_custkey * 7 + o_orderkey) % 2000 END AS c FROM orders),
texts AS (
  SELECT *, p || CASE WHEN o % 4 <> 1 THEN ' podľa § ' || (o % 5 + 1) ELSE '' END || CASE WHEN o % 3 = 0 THEN ' a § ' || (o % 7 + 1) || ' zákona č. ' || c || '/2003 Z. z.' ELSE '' END AS text FROM ord),
register AS (SELECT c_custkey AS doc FROM customer WHERE c_custkey % 5 <> 0),
named AS (
  SELECT doc_id, k, doc_id AS td, NULL::VARCHAR AS law, o % 5 + 1 AS t FROM ord WHERE o % 4 <> 1
  UNION SELECT doc_id, k, doc, CASE WHEN doc IS NULL THEN c || '/2003' END, o % 7 + 1 FROM ord LEFT JOIN register ON doc = c WHERE o % 3 = 0),
walk AS (
  SELECT *, 1 AS d FROM named
  UNION SELECT w.doc_id, w.k, n.td, n.law, n.t, d + 1 FROM walk w JOIN named n ON n.doc_id = w.td AND n.k = w.t WHERE d < 3),
best AS (SELECT doc_id, k, td, law, t, min(d) AS d FROM walk WHERE td IS DISTINCT FROM doc_id OR t <> k GROUP BY ALL)
SELECT x.doc_id, 'paragraf-' || x.k AS chunk_id, b.d::INTEGER AS distance, b.td AS target_doc, b.law, b.t::VARCHAR AS target, y.text
FROM texts x LEFT JOIN best b USING (doc_id, k) LEFT JOIN texts y ON y.doc_id = b.td AND y.k = b.t""",
)
def reference_closure(spark, sf_dir):
    number = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = table(spark, sf_dir, "orders").withColumn("k", number.cast("long"))
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    law = F.when(o % 2 == 0, 1).otherwise((c * 7 + o) % 2000)
    own = F.when(o % 4 != 1, said(" podľa § ", o % 5 + 1)).otherwise("")
    other = F.when(o % 3 == 0, said(" a § ", o % 7 + 1, " zákona č. ", law, "/2003 Z. z.")).otherwise("")
    paragraphs = orders.select(
        c.alias("doc_id"), F.col("k").cast("string").alias("target"), F.col("k").alias("pos"), F.concat("o_orderpriority", own, other).alias("text")
    )
    chunks = paragraphs.select("doc_id", said("paragraf-", F.col("target")).alias("chunk_id"), F.col("text").alias("content"))
    held = table(spark, sf_dir, "customer").filter("c_custkey % 5 <> 0")
    register = held.select(said(F.col("c_custkey"), "/2003").alias("law"), F.col("c_custkey").alias("doc_id"))
    made = closure.with_references(chunks, paragraphs, register, DEPTH)
    return made.select("doc_id", "chunk_id", F.inline_outer("references"))
