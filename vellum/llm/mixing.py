"""Mixing sources to target weights by a low-discrepancy schedule.

Each slot of the mix draws from one source: the point of the golden-ratio sequence at the slot,
mapped through the cumulative targets, tells which. Slots are ranked per source, and the k-th
slot of a source takes the k-th block of its shuffled documents, all blocks of all sources
holding the same number of words; a source's documents follow each other in a ring, so after
the last one comes the first again. The slots that a source draws decide what it gives, and
where in the mix: so the mix is near its weights at every point of the schedule.

Nothing here gathers a source in one task: documents are placed in their source's stream
by sums over hash ranges, slots are ranked by sums over runs of slots. Sources themselves,
one row each, are numbered in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.shared import WORD, text_or_empty, written

#: The golden ratio's fraction in units of 2 ** -32, and the weights that repeat over the sources.
GOLDEN = 2654435769
WEIGHTS = (1, 2, 3)
#: Cells by which points find their source, and slots ranked together.
CELLS = 4096
SLOTS = 65536
#: Documents of a source that are put in order together, about.
RANGE = 512


@dataclass(frozen=True)
class Mix:
    """Tables of a mix: one row a document, a source, a slot."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame


def mix(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_passes: int = 3,
    block_words: int = 64,
    step: int = GOLDEN,
) -> Mix:
    """Mix ``df`` to ``weights``, which repeat over the sources in code-point order, null last.

    documents: doc_id, source, size, source_size, target, taken, slots, row. A target stops at
    ``most_passes`` times its source's size; the excess goes to the others by weight. ``taken``
    counts the words that the source's slots take of the document, repeats counted; a source
    takes a block of ``block_words`` a slot it draws, so it ends within a few blocks of its
    target, and at ``most_passes`` times its size at most. ``slots`` holds the slot at which each
    pass begins of which the mix takes half or more.
    sources: skey, number, weight, source_size, target, quota, drawn, words. schedule: slot, skey,
    rank of each slot whose block is taken. ``step``, odd, moves the points from slot to slot.

    Null and empty texts have size 0 and nothing is taken. Very long texts lie in many blocks.
    Rows that repeat an id are documents of their own. Ties in the shuffle go by size; rows that
    are alike in id and size can change places. An empty table gives no rows. Further columns
    aren't read, whatever their names.
    """
    sizes = _sizes(df, id_column, text_column, source_column)
    ranges = written(sizes.groupBy("skey", "range").agg(F.sum("size").alias("words")), "ranges")
    targets = written(_targets(ranges, weights, most_passes), "targets")
    drawn = written(_drawn(df.sparkSession, targets, block_words, step), "slots")
    counts = drawn.groupBy("skey").agg(F.count("*").alias("drawn"))
    sources = targets.join(counts, "skey", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    words = F.least(F.col("drawn") * block_words, F.col("source_size") * most_passes)
    sources = written(sources.withColumn("words", words).drop("low", "high"), "sources")
    before = W.partitionBy("skey").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
    within = W.partitionBy("skey", "range").orderBy("order", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        sizes.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(offsets.select("skey", "range", "offset"), ["skey", "range"])
        .withColumn("start", F.col("start") + F.col("offset"))
        .join(sources.select("skey", "source_size", "target", "words"), "skey")
        .drop("order", "range", "offset")
    )
    schedule = drawn.join(sources.select("skey", "words"), "skey").filter(F.col("rank") * block_words < F.col("words"))
    schedule = schedule.drop("words")
    return Mix(_taken(written(placed, "placed"), schedule, most_passes, block_words), sources, schedule)


def _sizes(df: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    source = F.col(f"`{source_column}`").cast("string")
    sizes = df.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        source.alias("source"),
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("skey"),
        F.regexp_count(text_or_empty(F.col(f"`{text_column}`")), F.lit(WORD)).cast("long").alias("size"),
    )
    order = F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = written(sizes.withColumn("order", order).withColumn("row", F.monotonically_increasing_id()), "sizes")
    # As many ranges as bound the documents of one, whatever the table's size.
    digits = max(1, math.ceil(math.log(max(sizes.count(), 2) / RANGE, 16)))
    return sizes.withColumn("range", F.substring("order", 1, digits))


def _targets(ranges: DataFrame, weights: tuple[int, ...], most_passes: int) -> DataFrame:
    """Targets by filling up, over one row a source, in the order in which they reach their limits.

    low and high bound the points that draw from the source, in units of 2 ** -32.
    """
    exact = lambda c: c.cast("decimal(38,0)")
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    number = F.row_number().over(W.orderBy(F.col("skey") == "n", "skey")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    sources = (
        ranges.groupBy("skey")
        .agg(F.sum("words").alias("source_size"))
        .withColumn("number", number)
        .withColumn("weight", weight.cast("long"))
        .withColumn("most", F.col("source_size") * most_passes)
    )
    filling = W.orderBy(F.col("most") / F.col("weight"), "number")
    sources = (
        sources.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("full", F.coalesce(F.sum("most").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("share", F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("left", F.col("total") - F.col("full"))
    )
    below = exact(F.col("left")) * exact(F.col("weight")) <= exact(F.col("most")) * exact(F.col("share"))
    sources = sources.withColumn("at", F.row_number().over(filling)).withColumn("below", below)
    level = F.min(F.when(F.col("below"), F.struct("at", "left", "share"))).over(whole)
    even = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.share")
    target = F.when(F.col("at") < F.col("level.at"), F.col("most").cast("double")).otherwise(even)
    upto = F.sum("quota").over(W.orderBy("number").rowsBetween(W.unboundedPreceding, 0))
    point = lambda words: F.floor(exact(words) * F.lit(1 << 32) / exact(F.col("quotas"))).cast("long")
    return (
        sources.withColumn("level", level)
        .withColumn("target", target)
        .withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.col("most")).cast("long"))
        .withColumn("upto", upto)
        .withColumn("quotas", F.sum("quota").over(whole))
        .withColumn("low", F.when(F.col("quotas") > 0, point(F.col("upto") - F.col("quota"))))
        .withColumn("high", F.when(F.col("quotas") > 0, point(F.col("upto"))))
        .select("skey", "number", "weight", "source_size", "target", "quota", "low", "high")
    )


def points(slot: Column, step: int) -> Column:
    """slot * step modulo 2 ** 32, without a product that a long can't hold."""
    low, high = slot % 65536, F.floor(slot / 65536) % 65536
    return (low * step + (high * step) % 65536 * 65536) % (1 << 32)


def _drawn(spark: SparkSession, targets: DataFrame, block_words: int, step: int) -> DataFrame:
    """slot, skey, rank: the source that each slot draws from, and how many slots did so before."""
    total = math.ceil((targets.agg(F.sum("quota")).first()[0] or 0) / block_words)
    width = (1 << 32) // CELLS
    spans = targets.filter("low < high").select("skey", "low", "high")
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    slots = spark.range(total).withColumnRenamed("id", "slot").withColumn("point", points(F.col("slot"), step))
    slots = slots.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell")
    drawn = slots.filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select(
        "slot", F.floor(F.col("slot") / SLOTS).alias("run"), "skey"
    )
    runs = drawn.groupBy("skey", "run").agg(F.count("*").alias("n"))
    before = W.partitionBy("skey").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(W.partitionBy("skey", "run").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", rank).join(runs, ["skey", "run"])
    return ranked.select("slot", "skey", (F.col("rank") + F.col("before")).alias("rank"))


def _taken(placed: DataFrame, schedule: DataFrame, most_passes: int, block_words: int) -> DataFrame:
    """Words of each document among the first ``words`` of its source's ring, and the slots of its passes."""
    position = F.col("start") + F.col("pass") * F.col("source_size")
    passes = (
        placed.filter("size > 0 AND start < words")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most_passes - 1))))
        .withColumn("words_taken", F.least(F.col("size"), F.col("words") - position))
        .filter("words_taken > 0")
        .withColumn("rank", F.floor(position / block_words))
    )
    met = passes.join(schedule, ["skey", "rank"])
    half = F.when(F.col("words_taken") * 2 >= F.col("size"), F.col("slot"))
    taken = met.groupBy("row").agg(F.sum("words_taken").alias("taken"), F.array_sort(F.collect_list(half)).alias("slots"))
    none = F.array().cast("array<bigint>")
    return placed.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("slots", none).alias("slots"), "row",
    )


def repeated(df: DataFrame, mixed: Mix, *, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``df`` once for each slot at which the mix begins to take them, each partition in the slots' order.

    Ids are dealt to partitions by a hash, so each partition follows the schedule as a sample of
    the whole does. Documents without words aren't drawn. Rows that share an id are drawn alike,
    at the slots of all of them. All columns come along, whatever their names.
    """
    drawn = mixed.documents.filter("size > 0").groupBy("doc_id").agg(
        F.array_sort(F.flatten(F.collect_list("slots"))).alias("all"), F.count("*").alias("rows")
    )
    # The slots of an id's rows are shared out among them: each row comes as often as it is drawn on average.
    share = F.transform(F.sequence(F.lit(1), F.floor(F.size("all") / F.col("rows") + 0.5)), lambda k: F.element_at("all", k.cast("int")))
    drawn = drawn.select(F.col("doc_id").alias("drawn_id"), F.when(F.size("all") * 2 >= F.col("rows"), share).alias("slots"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), F.col(f"`{id_column}`").alias("own_id"))
    joined = rows.join(drawn, F.col("own_id").eqNullSafe(F.col("drawn_id")))
    return joined.select("whole", F.explode("slots").alias("slot")).sortWithinPartitions("slot").select("whole.*")
