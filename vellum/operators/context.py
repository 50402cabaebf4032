"""What stands before or refers: as-of context, references and footnotes resolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.functions import markers as m
from vellum.functions import refs
from vellum.operators import structure


def asof_context(items: DataFrame) -> DataFrame:
    """Content elements of the main text with the last § and, within it, the last (n) before them."""
    rows = structure.located(items).filter("zone = 'main' AND level IS NULL")
    return rows.select("doc_id", "pos", "text", F.col("paragraph_mark").alias("paragraph"), F.col("odsek_mark").alias("odsek"))


def table_context(nodes: DataFrame) -> DataFrame:
    """doc_id, pos, section, subsection of each table: the last "§ N" before it and the last "(N)" after that.

    nodes: doc_id, pos in reading order, kind, text, in_group. Only markers that stand alone, with
    a title at most, count, and none within groups: those are references in running text.
    """
    order = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    outside = (F.col("kind") == "text") & ~F.col("in_group")
    # Few texts are markers: the patterns run where the first character allows it.
    section = F.when(outside & F.ltrim("text").startswith("§"), m.pure_section(F.col("text")))
    odsek = F.when(outside & F.ltrim("text").startswith("("), m.pure_odsek(F.col("text")))
    rows = nodes.withColumn("s", section).withColumn("n", odsek)
    last = lambda c: F.last(F.when(F.col(c).isNotNull(), F.struct("pos", F.col(c).alias("no"))), ignorenulls=True).over(order)
    rows = rows.select("doc_id", "pos", "kind", last("s").alias("s"), last("n").alias("n")).filter("kind = 'table'")
    within = F.col("n.pos") > F.coalesce(F.col("s.pos"), F.lit(-1))
    return rows.select("doc_id", "pos", F.col("s.no").alias("section"), F.when(within, F.col("n.no")).alias("subsection"))


def last_before(rows: DataFrame, by: str, order: list[str], when, value: str, name: str) -> DataFrame:
    """``rows`` with the value of the last row that meets ``when``, itself included."""
    window = W.partitionBy(by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn(name, F.last(F.when(when, F.col(value)), ignorenulls=True).over(window))


def references(all_units: DataFrame) -> DataFrame:
    """One row a reference in a unit's text: doc_id, unit_id, type, target, position."""
    rows = all_units.select("doc_id", "unit_id", F.explode(refs.references(F.col("text"))).alias("ref"))
    return rows.select("doc_id", "unit_id", "ref.type", "ref.target", "ref.position")


def footnote_marks(all_units: DataFrame) -> DataFrame:
    rows = all_units.select("doc_id", "unit_id", F.explode(refs.footnote_marks(F.col("text"))).alias("mark"))
    return rows.select("doc_id", "unit_id", "mark.marker", "mark.type", "mark.position")


def occurrences(found: DataFrame, first: str = "unit_id") -> DataFrame:
    """How often each target is named in a document, in how many units, and where first."""
    return found.groupBy("doc_id", "type", "target").agg(
        F.count("*").alias("occurrences"), F.countDistinct("unit_id").alias("units"), F.min(first).alias("first_unit")
    )


def resolved_one_level(all_units: DataFrame) -> DataFrame:
    """References to paragraphs with the target's text and what that refers to in its turn.

    A paragraph's reference to itself is left out; the target's own are distinct, by position.
    Targets that are missing stay, with nulls. Units are made once: each brings its distinct
    references along, and paragraphs meet the references as one small table.
    """
    named = F.array_distinct(
        F.transform(F.filter(refs.references(F.col("text")), lambda r: r["type"] == "paragraph"), lambda r: r["target"])
    )
    own = F.filter(named, lambda t: F.concat(F.lit("paragraf-"), t) != F.col("unit_id"))
    asked = F.when(F.col("text").contains("§"), own)
    rows = all_units.select("doc_id", "unit_id", "level", "text", asked.alias("targets"))
    own_no = F.when(F.col("level") == "paragraph", F.regexp_replace("unit_id", "^paragraf-", ""))
    held = F.struct(
        F.col("unit_id").alias("target_id"), F.col("text").alias("target_text"),
        F.when(F.size("targets") > 0, F.array_join(F.array_sort("targets"), ",")).alias("target_refers_to"),
    )
    return _met(rows, F.col("targets"), own_no, held, "target")


def _met(rows: DataFrame, asked: Column, own: Column, held: Column, name: str) -> DataFrame:
    """doc_id, unit_id, ``name`` and the fields of ``held`` of each row of the document that goes by what a row asks for; nulls where none does.

    Rows that ask and rows that answer come from one pass over ``rows``: they are laid side by side and meet in a window of their
    document, so nothing is made twice and nothing is shuffled again.
    """
    none = F.array().cast("array<string>")
    sides = F.concat(
        F.transform(F.coalesce(asked, none), lambda x: F.struct(x.alias(name), F.lit(False).alias("answers"))),
        F.when(own.isNotNull(), F.array(F.struct(own.alias(name), F.lit(True).alias("answers")))).otherwise(F.array()),
    )
    dealt = rows.select("doc_id", "unit_id", held.alias("held"), F.inline(sides))
    answers = F.collect_list(F.when(F.col("answers"), F.col("held"))).over(W.partitionBy("doc_id", name))
    asking = dealt.withColumn("found", answers).filter(~F.col("answers"))
    return asking.select("doc_id", "unit_id", name, F.inline_outer("found"))


def resolved_footnotes(all_units: DataFrame) -> DataFrame:
    """Bracketed footnote marks with the footnote's text, null where there is none."""
    numbers = F.transform(refs.footnote_marks(F.col("text")), lambda x: F.regexp_extract(x["marker"], r"(\d+)", 1))
    own = F.when(F.col("level") == "footnote", F.coalesce(F.regexp_replace("unit_id", "^footnote-", ""), F.lit("")))
    return _met(all_units, F.filter(numbers, lambda n: n != ""), own, F.struct(F.col("text").alias("footnote_text")), "number")


def superior(all_units: DataFrame) -> DataFrame:
    """Each unit below paragraphs with its paragraph's and its part's text."""
    level = F.col("level")
    above = F.concat(F.lit("paragraf-"), F.regexp_extract("unit_id", r"^\w+-([0-9a-zA-Z]+)", 1))
    # Units meet their paragraph and their part in windows of their document, so they are made once.
    rows = all_units.withColumn("paragraph_id", F.when(level == "paragraph", F.col("unit_id")).otherwise(above))
    texts = lambda of, name, *by: F.collect_list(F.when(level == of, F.struct(F.col("text").alias(name)))).over(W.partitionBy("doc_id", *by))
    rows = rows.filter("level IN ('part', 'paragraph', 'odsek', 'pismeno', 'subitem')").withColumn("parts", texts("part", "part_text", "part_no"))
    rows = rows.filter("level <> 'part'").withColumn("paragraphs", texts("paragraph", "paragraph_text", "paragraph_id")).filter("level <> 'paragraph'")
    rows = rows.select("doc_id", "unit_id", "paragraph_id", "parts", F.inline_outer("paragraphs"))
    return rows.select("doc_id", "unit_id", "paragraph_id", "paragraph_text", F.inline_outer("parts"))


def full_blocks(items: DataFrame) -> DataFrame:
    """doc_id, paragraph, start, end (exclusive; null: to the document's end) of full paragraphs.

    A paragraph is full where its second successor is "(1)": "§ N" alone also occurs in lists
    of contents. The first such place of a number counts; a block ends at the next § that
    heads an element.
    """
    order = W.partitionBy("doc_id").orderBy("pos")
    number = m.paragraph(F.col("text"))
    heads = items.withColumn("number", number).withColumn("second", F.lead("text", 2).over(order)).filter("number IS NOT NULL")
    heads = heads.withColumn("next", F.lead("pos").over(order)).filter("second = '(1)'")
    first = F.row_number().over(W.partitionBy("doc_id", "number").orderBy("pos"))
    found = heads.withColumn("first", first).filter("first = 1")
    return found.select("doc_id", F.col("number").alias("paragraph"), F.col("pos").alias("start"), F.col("next").alias("end"))


def enriched(all_units: DataFrame, letters: DataFrame, least: int = 200) -> DataFrame:
    """Units with odseks and pismenos that pages hold and the stream lost.

    letters: doc_id, paragraph, letter, text, pos of a page's pismenos. Paragraphs without an
    odsek whose text is longer than ``least`` get one odsek, numbered 1, and its pismenos.
    """
    has = all_units.filter("level = 'odsek'").select("doc_id", F.col("parent_id").alias("unit_id")).distinct()
    long = all_units.filter((F.col("level") == "paragraph") & (F.length("text") > least)).join(has, ["doc_id", "unit_id"], "left_anti")
    bare = long.select("doc_id", F.regexp_replace("unit_id", "^paragraf-", "").alias("paragraph"), "part_no", F.col("pos").alias("head"))
    held = bare.join(letters, ["doc_id", "paragraph"])
    odsek = F.concat(F.lit("odsek-"), "paragraph", F.lit(".1"))
    odseks = held.select(
        "doc_id", odsek.alias("unit_id"), F.lit("odsek").alias("level"), F.col("head").alias("pos"),
        F.concat(F.lit("paragraf-"), "paragraph").alias("parent_id"), "part_no", F.lit("").alias("text"),
    ).distinct()
    pismenos = held.select(
        "doc_id", F.concat(F.lit("pismeno-"), "paragraph", F.lit(".1."), "letter").alias("unit_id"), F.lit("pismeno").alias("level"),
        "pos", odsek.alias("parent_id"), "part_no", "text",
    )
    return all_units.unionByName(odseks).unionByName(pismenos)
