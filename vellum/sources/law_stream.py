"""Statutes as element streams, made from the star schema of customers, orders and lines.

A customer is a document, an order a paragraph, a line an odsek with two pismenos and a
subitem. Elements carry markers in their texts only, as converted pages do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.session import dealt
from vellum.sources import table

END = 1_000_000_000


def law_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, label, layer, text, hyperlink.

    Customers, orders and lines are shuffled by document as they are; their elements are made after that, where they stay.
    """
    customers = dealt(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), "c_mktsegment"), "doc_id")
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), "o_orderkey", "o_orderpriority")
    orders = dealt(orders, "doc_id").withColumn("k", number.cast("long"))
    place = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").withColumn("line", F.row_number().over(place).cast("long"))
    lines = lines.join(orders.select("doc_id", "k", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    lines = dealt(lines.select("doc_id", "k", "line", "l_returnflag", "l_quantity", "l_linestatus", "l_shipdate"), "doc_id")
    start = F.col("k") * 10_000 + F.col("line") * 100
    number_text = F.col("line").cast("string")
    heads = _elements(
        customers,
        [(F.lit(0), F.lit("PRVÁ ČASŤ"), None), (F.lit(1), F.col("c_mktsegment"), None)],
    )
    paragraphs = _elements(
        orders,
        [
            (F.col("k") * 10_000, F.concat(F.lit("§ "), F.col("k").cast("string")), None),
            (
                F.col("k") * 10_000 + 1,
                F.concat("o_orderpriority", F.lit(" podľa § "), (F.col("o_orderkey") % 5 + 1).cast("string")),
                None,
            ),
        ],
    )
    odseks = _elements(
        lines,
        [
            (start, F.concat(F.lit("("), number_text, F.lit(")")), None),
            (start + 1, F.concat(F.lit("flag "), "l_returnflag", F.lit("¹ ["), number_text, F.lit("]")), None),
            (start + 2, F.lit("a)"), None),
            (start + 3, F.concat(F.lit("quantity "), F.col("l_quantity").cast("long").cast("string")), None),
            (start + 4, F.lit("b)"), None),
            (start + 5, F.concat(F.lit("status "), "l_linestatus", F.lit(":")), None),
            (start + 6, F.lit("1."), None),
            (start + 7, F.concat(F.lit("ship "), F.date_format("l_shipdate", "yyyy-MM-dd")), None),
        ],
    )
    ends = _elements(
        customers,
        [
            (F.lit(END), F.lit("Tento zákon nadobúda účinnosť 1. januára 2004."), None),
            (F.lit(END + 1), F.lit("Príloha č. 1 k zákonu č. 595/2003 Z. z."), None),
            (F.lit(END + 2), F.concat(F.lit("Text prílohy "), F.col("doc_id").cast("string")), None),
            (F.lit(END + 3), F.lit("Poznámky"), "#poznamky"),
            (F.lit(END + 4), F.lit("1)"), None),
            (F.lit(END + 5), F.lit("Zákon č. 1/1993 Z. z."), None),
        ],
    )
    return heads.unionByName(paragraphs).unionByName(odseks).unionByName(ends)


def _elements(rows: DataFrame, elements: list) -> DataFrame:
    each = [
        F.struct(pos.cast("long").alias("pos"), text.alias("text"), F.lit(link).cast("string").alias("hyperlink"))
        for pos, text, link in elements
    ]
    return rows.select("doc_id", F.inline(F.array(*each))).select(
        "doc_id", "pos", F.lit("text").alias("label"), F.lit("body").alias("layer"), "text", "hyperlink"
    )
