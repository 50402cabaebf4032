"""Annexes: found in elements, and put together with what a manifest promises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.functions import markers as m


def detected(items: DataFrame) -> DataFrame:
    """doc_id, number, pos, kind: the first element of each annex number; a link to a file makes it external."""
    number = m.annex(F.col("text"))
    first = F.row_number().over(W.partitionBy("doc_id", "number").orderBy("pos"))
    found = items.withColumn("number", number).filter("number IS NOT NULL").withColumn("first", first).filter("first = 1")
    kind = F.when(F.lower("hyperlink").endswith(".pdf"), "external").otherwise("inline")
    return found.select("doc_id", "number", "pos", kind.alias("kind"))


def integrated(manifest: DataFrame, content: DataFrame, key: str) -> DataFrame:
    """The manifest's annexes in its order, with their content where there is any, and a status.

    An external annex without content is not available, an inline one not found. Content
    that the manifest doesn't name is left out.
    """
    joined = manifest.join(content.withColumn("_found", F.lit(True)), key, "left")
    status = F.when(F.col("_found"), "found").when(F.col("kind") == "external", "not_available").otherwise("not_found")
    return joined.withColumn("status", status).drop("_found")


def summary(manifest: DataFrame, by: str) -> DataFrame:
    return manifest.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(F.col("kind") == "external").alias("external"),
        F.count_if(F.col("kind") == "inline").alias("inline"),
    )


def first_candidate(candidates: DataFrame, key: str, priority: str, name: str) -> DataFrame:
    """Of each key's candidates the one with the best priority, then by name: caches go first."""
    best = F.min(F.struct(priority, name)).alias("best")
    return candidates.groupBy(key).agg(best).select(key, f"best.{priority}", f"best.{name}")


def is_table_text(words: Column, cells: Column) -> Column:
    """Whether running text repeats a table: all of it a cell, or a long word of it one, or a code."""
    text = F.array_join(words, " ")
    long = F.filter(words, lambda w: F.length(w) > 3)
    return F.array_contains(cells, text) | F.arrays_overlap(long, cells) | text.rlike(r"^(\d+-\d+|\d{2}\.\d{2}(\.\d+)?|\d{4} \d{2})$")
