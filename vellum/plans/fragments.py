"""Tables rebuilt from texts, over annexes made from customers' orders: some have their table, the others its texts only."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.operators import fragments
from vellum.plans.registry import query
from vellum.sources import table

_LINES = """WITH ord AS (
  SELECT o_custkey AS doc_id, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
ln AS (SELECT ord.*, l.* FROM ord JOIN (SELECT l_orderkey, l_partkey, l_suppkey % 90 + 10 AS supp, l_quantity::BIGINT AS qty, l_returnflag AS flag,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line FROM lineitem) l ON o_orderkey = l_orderkey)"""


def _annexes(spark, sf_dir):
    """Elements and cells: an order's lines are told whole (N), or by texts of a row with a code (R) or without one (A)."""
    number = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), "o_orderkey", "o_orderstatus", number.cast("long").alias("k"))
    place = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", (F.col("l_suppkey") % 90 + 10).cast("string").alias("supp"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_quantity").cast("long").alias("qty"), F.row_number().over(place).cast("long").alias("line"),
    )
    lines = lines.join(orders, "o_orderkey")
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    item, qty, start = said(F.col("k"), "-", F.col("line")), F.col("qty"), F.col("k") * 10_000 + F.col("line") * 100
    top = (F.col("k") * 100 + F.col("line") * 2) * 8 + (qty % 8 - 4)
    element = lambda pos, text, left=None: F.struct(
        pos.cast("long").alias("pos"), text.alias("text"), F.lit(left).cast("double").alias("left"),
        F.when(F.lit(left is not None), top).cast("double").alias("top"),
    )
    whole = element(start + 9, said(item, " ", F.col("supp"), ".", qty, " časť ", F.col("part")))
    again = element(start + 10, said(item, " ", qty, "  neskôr ", F.col("part")))
    row = [element(start + 8, item, 10), element(start + 6, F.col("part"), 200), element(start + 7, F.lit("stroj"), 120)]
    code = element(start + 5, said(F.col("supp"), ".", qty), 60)
    more = element(start + 4, said("1.2.", qty), 210)
    flag = F.col("l_returnflag")
    texts = (
        F.when((flag == "N") & (qty % 2 == 0), F.array(again, whole))
        .when(flag == "N", F.array(whole))
        .when(flag == "R", F.array(code, more, *row))
        .when(qty % 5 == 0, F.array(*row, again))
        .otherwise(F.array(*row))
    )
    header = F.struct((F.col("k") * 10_000).alias("pos"), said("Odpisová skupina ", F.col("k")).alias("text"))
    later = F.struct((F.col("k") * 10_000 + 9_999).alias("pos"), said("ODPISOVÁ  SKUPINA ", F.col("k"), " (ďalej)").alias("text"))
    heads = orders.select("doc_id", F.inline(F.when(F.col("o_orderkey") % 3 == 0, F.array(header, later)).otherwise(F.array(header))))
    elements = lines.select("doc_id", F.inline(texts)).unionByName(heads, allowMissingColumns=True)
    first = F.array(F.lit("Položka"), said(" ", F.col("k"), "-1 "))
    cells = orders.filter("o_orderstatus = 'F'").select("doc_id", F.col("o_orderkey").alias("table_id"), F.lit(0).alias("c"), F.posexplode(first).alias("r", "text"))
    return elements, cells


@query(
    "rebuilt_tables",
    _LINES
    + """,
rw AS (
  SELECT doc_id, k, line, k || '-' || line AS item,
    CASE WHEN (flag = 'N' AND qty % 2 = 0) OR (flag = 'A' AND qty % 5 = 0) THEN qty::VARCHAR WHEN flag IN ('N', 'R') THEN supp || '.' || qty ELSE '' END AS kp,
    CASE WHEN (flag = 'N' AND qty % 2 = 0) OR (flag = 'A' AND qty % 5 = 0) THEN 'neskôr ' || l_partkey WHEN flag = 'N' THEN 'časť ' || l_partkey
      WHEN flag = 'R' THEN 'stroj ' || l_partkey || ' 1.2.' || qty ELSE 'stroj ' || l_partkey END AS name
  FROM ln WHERE o_orderstatus <> 'F'),
held AS (SELECT doc_id, count(*) FILTER (o_orderstatus = 'F') AS held FROM ord GROUP BY 1),
made AS (
  SELECT doc_id, k, any_value(title) AS title, count(*) AS n,
    '| Položka | KP | Názov |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || item || ' | ' || kp || ' | ' || name || ' |', chr(10) ORDER BY line) AS markdown
  FROM rw JOIN (SELECT doc_id, k, CASE WHEN o_orderkey % 3 = 0 THEN 'ODPISOVÁ  SKUPINA ' || k || ' (ďalej)' ELSE 'Odpisová skupina ' || k END AS title FROM ord) USING (doc_id, k)
  GROUP BY ALL)
SELECT doc_id, (held + row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::BIGINT AS place, k::VARCHAR AS "group", title, n::BIGINT AS n, markdown FROM made JOIN held USING (doc_id)""",
)
def rebuilt_tables(spark, sf_dir):
    made = fragments.rebuilt_tables(*_annexes(spark, sf_dir))
    return made.select("doc_id", "place", "group", "title", F.size("rows").cast("long").alias("n"), "markdown")
