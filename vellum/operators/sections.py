"""Units nested in one another: paragraphs hold odseks, these hold pismenos, these hold subitems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: From the outermost level to the innermost.
LEVELS = ("paragraph", "odsek", "pismeno", "subitem")


def ancestors(all_units: DataFrame) -> DataFrame:
    """Units of LEVELS with ``marker`` and ``<level>_at``, the position of the unit of each level that holds it, itself included.

    A unit is held by the last one of an outer level before it, not by one that happens to have
    the same id, so units that repeat an id stay apart. A level that doesn't hold it is null.
    """
    units = all_units.filter(F.col("level").isin(*LEVELS) & (F.col("pos") >= 0))
    running = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    # The last unit of a level holds what follows until one of the same level or an outer one.
    last = {f"{x}_at": F.last(F.when(F.col("level") == x, F.col("pos")), ignorenulls=True).over(running) for x in LEVELS}
    rows = units.withColumns(last)
    for k, level in enumerate(LEVELS[1:], 1):
        # A pismeno may lack between an odsek and its subitem: what counts is the nearest level that is there.
        above = F.array_max(F.array(*[f"{x}_at" for x in LEVELS[:k]]))
        rows = rows.withColumn(f"{level}_at", F.when(F.col(f"{level}_at") > above, F.col(f"{level}_at")))
    return rows.withColumn("marker", F.element_at(F.split("unit_id", r"[-.]"), -1))


def nested(all_units: DataFrame) -> DataFrame:
    """doc_id, pos, marker, section of each paragraph; ``section`` is its text and what it holds, three levels deep.

    all_units: doc_id, unit_id, level, pos, text, as ``structure.units`` gives them. What a unit
    holds comes in the order of positions; a unit that holds nothing has an empty array.
    Subitems without a pismeno are their odsek's own. Units before the first paragraph, pismenos
    and subitems outside an odsek (``structure.units`` opens none), parts, annexes and footnotes
    are left out; a null text is null within.

    The units are shuffled by document once: the window and the three aggregations, from the
    innermost level outwards, all rest on that.
    """
    at = [f"{x}_at" for x in LEVELS]
    rows = ancestors(all_units).filter("paragraph_at IS NOT NULL")
    own = lambda level: F.max(F.when(F.col("level") == level, F.struct("pos", "marker", "text")))
    listed = lambda held: F.transform(F.sort_array(F.collect_list(held)), lambda x: x["unit"])
    as_held = lambda on, unit: F.when(on, F.struct("pos", unit.alias("unit")))
    leaf = F.struct(F.lit("subitem").alias("type"), "marker", "text")
    rows = rows.withColumn("subitem", as_held(F.col("level") == "subitem", leaf))
    inner = rows.groupBy("doc_id", *at[:3]).agg(
        listed(F.col("subitem")).alias("items"), *[own(x).alias(x) for x in LEVELS[:3]]
    )
    # From here on a row is a unit of its level, or what its holder has of its own.
    letter = _unit("pismeno", F.col("items"), "subitems")
    inner = inner.withColumn("letter", F.when(F.col("pismeno").isNotNull(), F.struct(F.col("pismeno.pos").alias("pos"), letter.alias("unit"))))
    middle = inner.groupBy("doc_id", *at[:2]).agg(
        listed(F.col("letter")).alias("letters"), F.flatten(F.collect_list(F.when(F.col("pismeno").isNull(), F.col("items")))).alias("items"),
        *[F.max(x).alias(x) for x in LEVELS[:2]],
    )
    section = _unit("odsek", F.col("letters"), "subsubsections", F.col("items").alias("subitems"))
    middle = middle.withColumn("held", F.when(F.col("odsek").isNotNull(), F.struct(F.col("odsek.pos").alias("pos"), section.alias("unit"))))
    outer = middle.groupBy("doc_id", at[0]).agg(listed(F.col("held")).alias("sections"), F.max("paragraph").alias("paragraph"))
    return outer.select(
        "doc_id", F.col("paragraph_at").alias("pos"), F.col("paragraph.marker").alias("marker"), _unit("paragraph", F.col("sections"), "subsections").alias("section")
    )


def _unit(level: str, held: Column, name: str, *more: Column) -> Column:
    content = F.struct(F.col(f"{level}.text").alias("text"), held.alias(name), *more)
    return F.struct(F.lit(level).alias("type"), F.col(f"{level}.marker").alias("marker"), content.alias("content"))
