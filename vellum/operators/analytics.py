"""Counts, depths, intervals, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def depth_stats(nodes: DataFrame, by: str, depth: str) -> DataFrame:
    """Least, greatest and mean depth, and quartiles by index: the value at floor(n * q).

    Counts a depth first, so a group of any size is a few rows: the quartile is the first
    depth whose running count goes beyond n * q.
    """
    counts = nodes.groupBy(by, F.col(depth).alias("d")).agg(F.count("*").alias("n"))
    running = W.partitionBy(by).orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("upto", F.sum("n").over(running)).withColumn("total", F.sum("n").over(W.partitionBy(by)))
    at = lambda k, of: F.min(F.when(F.col("upto") > F.floor(F.col("total") * k / of), F.col("d")))
    return counts.groupBy(by).agg(
        F.min("d").alias("least"), F.max("d").alias("greatest"),
        F.round(F.sum(F.col("d") * F.col("n")) / F.sum("n"), 6).alias("mean"),
        at(1, 4).alias("p25"), at(1, 2).alias("p50"), at(3, 4).alias("p75"), at(9, 10).alias("p90"),
    )


def most_frequent(rows: DataFrame, column: str, k: int, order: str | None = None) -> DataFrame:
    """The k most frequent values; ties by the first place, or by value."""
    first = F.min(order) if order else F.min(column)
    counts = rows.groupBy(column).agg(F.count("*").alias("n"), first.alias("first"))
    return counts.orderBy(F.col("n").desc(), "first").limit(k).select(column, "n")


def merged_ranges(ranges: DataFrame, by: str) -> DataFrame:
    """Ranges (start, end) that overlap or touch, as one."""
    order = W.partitionBy(by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    islands = ranges.withColumn("fresh", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return islands.groupBy(by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def gaps(merged: DataFrame, by: str) -> DataFrame:
    """What lies between merged ranges."""
    following = F.lead("start").over(W.partitionBy(by).orderBy("start"))
    return merged.withColumn("following", following).filter("following > end").select(
        by, F.col("end").alias("start"), F.col("following").alias("end")
    )


def compared(a: DataFrame, b: DataFrame, key: str, text: str) -> DataFrame:
    """One row: keys in both, only in one; numbers and lengths of texts; difference in percent."""
    keys = a.select(key).distinct().withColumn("in_a", F.lit(1)).join(b.select(key).distinct().withColumn("in_b", F.lit(1)), key, "full")
    sets = keys.agg(
        F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("both"),
        F.count_if(F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_a").isNull()).alias("only_b"),
    )
    size = lambda d, n: d.agg(F.count("*").alias(f"texts_{n}"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias(f"length_{n}"))
    one = sets.withColumn("k", F.lit(1)).join(size(a, "a").withColumn("k", F.lit(1)), "k").join(size(b, "b").withColumn("k", F.lit(1)), "k")
    change = F.when(F.col("length_a") > 0, F.round(100 * (F.col("length_b") - F.col("length_a")) / F.col("length_a"), 6))
    return one.drop("k").withColumn("change", change)


def argmax(rows: DataFrame, by: str, value: str, score: str) -> DataFrame:
    """The value of the greatest score, ties to the smaller value."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(value).alias("v"))).alias("best")
    return rows.groupBy(by).agg(best).select(by, F.col("best.v").alias(value), (-F.col("best.s")).alias(score))


def run_times(runs: DataFrame, by: str, seconds: str) -> DataFrame:
    """Mean, least, greatest and population deviation of measured times."""
    rounded = lambda c: F.round(c, 6)
    return runs.groupBy(by).agg(
        F.count("*").alias("runs"), rounded(F.avg(seconds)).alias("mean"), F.min(seconds).alias("least"),
        F.max(seconds).alias("greatest"), rounded(F.stddev_pop(seconds)).alias("deviation"),
    )


def same_rows(a: DataFrame, b: DataFrame) -> Column | bool:
    """Whether both hold the same rows, as often."""
    return a.exceptAll(b).limit(1).count() == 0 and b.exceptAll(a).limit(1).count() == 0


def post_processed(items: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """doc_id, paragraphs and parts (all different ones, sorted), and the first position of each search pattern.

    One aggregation serves them all; each pattern is looked for in all of a document.
    """
    from vellum.functions import markers as m

    text = m.normalised(F.col("text"))
    hits = [F.min(F.when(F.col("text").contains(sought), F.col("pos"))).alias(name) for name, sought in patterns.items()]
    every = lambda c: F.sort_array(F.collect_set(c))
    return items.groupBy("doc_id").agg(every(m.paragraph(text)).alias("paragraphs"), every(m.part(text)).alias("parts"), *hits)


def unique_spans(spans: DataFrame, by: str) -> DataFrame:
    """Spans (by, seq, node), each node where it comes first."""
    return spans.groupBy(by, "node").agg(F.min("seq").alias("seq"))


def aliased(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` under their outer names; other columns keep theirs."""
    return rows.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in rows.columns])


def observed(rows: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """``rows``, and an observation that has their number and ``measures`` when an action on them has ended.

    Progress and timings of stages are in Spark's event log.
    """
    observation = Observation(name)
    return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in measures.items()]), observation
