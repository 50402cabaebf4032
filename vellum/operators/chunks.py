"""Chunks of documents: by unit level, by heading path, by page, and their renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK_LEVELS = ("pismeno", "odsek", "paragraph", "part")


def unit_chunks(all_units: DataFrame, level: str, emit_leaf: bool = False) -> DataFrame:
    """One row a unit of ``level``: chunk_id, level, content, has_subitems, content_length; annexes besides.

    content holds the unit's text and those of all units below it, by position. Paragraphs
    without a unit of ``level`` are chunks of their own. An odsek without pismenos makes no
    chunk at level pismeno unless ``emit_leaf``.
    """
    if level not in CHUNK_LEVELS:
        raise ValueError(f"no such chunk level: {level}")
    main = all_units.filter("level IN ('part', 'paragraph', 'odsek', 'pismeno', 'subitem', 'annex')")
    segments = F.split(F.regexp_extract("unit_id", r"^\w+-(.*)$", 1), r"\.")
    depth = {"paragraph": 1, "odsek": 2, "pismeno": 3}
    part = F.concat(F.lit("part-"), F.col("part_no").cast("string"))
    if level == "part":
        owned = main.withColumn("chunk_id", part).withColumn("chunk_level", F.lit("part"))
    else:
        name = {"paragraph": "paragraf"}.get(level, level)
        own = F.concat(F.lit(f"{name}-"), F.array_join(F.slice(segments, 1, depth[level]), "."))
        inside = ~F.col("level").isin("part", "annex") & (F.size(segments) >= depth[level])
        owned = main.withColumn("chunk_id", F.when(inside, own)).withColumn("chunk_level", F.lit(level))
        if level != "paragraph":
            paragraph = F.concat(F.lit("paragraf-"), F.element_at(segments, 1))
            whole = W.partitionBy("doc_id", F.when(F.col("level") != "annex", paragraph))
            has = F.max(inside.cast("int")).over(whole)
            bare = (F.col("level") == "paragraph") & (has == 0)
            owned = owned.withColumn("chunk_level", F.when(bare, "paragraph").otherwise(F.col("chunk_level")))
            owned = owned.withColumn("chunk_id", F.coalesce("chunk_id", F.when(F.col("chunk_level") == "paragraph", paragraph)))
            if emit_leaf and level == "pismeno":
                odsek = F.concat(F.lit("odsek-"), F.array_join(F.slice(segments, 1, 2), "."))
                full = F.max(inside.cast("int")).over(W.partitionBy("doc_id", odsek))
                leaf = (F.col("level") == "odsek") & (full == 0)
                owned = owned.withColumn("chunk_level", F.when(leaf, "odsek").otherwise(F.col("chunk_level")))
                owned = owned.withColumn("chunk_id", F.coalesce("chunk_id", F.when(F.col("chunk_level") == "odsek", odsek)))
    # Annexes are chunks as they stand; they go through the same grouping, one by one, so units are made once.
    annex = F.col("level") == "annex"
    rows = owned.withColumns(
        {
            "chunk_id": F.when(annex, F.col("unit_id")).otherwise(F.col("chunk_id")),
            "chunk_level": F.when(annex, F.lit("annex")).otherwise(F.col("chunk_level")),
            "alone": F.when(annex, F.col("pos")),
        }
    )
    # Below a paragraph all is in its chunk: a test that stays short where Spark pushes it down into the units.
    held = "level <> 'part'" if level == "paragraph" else "chunk_id IS NOT NULL"
    texts = F.transform(
        F.sort_array(F.collect_list(F.when((F.col("text") != "") & ~annex, F.struct("pos", "text")))), lambda x: x["text"]
    )
    return (
        rows.filter(held)
        .groupBy("doc_id", "chunk_id", F.col("chunk_level").alias("level"), "alone", F.when(annex, F.col("text")).alias("said"))
        .agg(
            F.array_join(texts, "\n").alias("joined"),
            F.bool_or(F.col("level") == "subitem").alias("has_subitems"),
            F.min("pos").alias("pos"),
        )
        .withColumn("content", F.when(F.col("level") == "annex", F.col("said")).otherwise(F.col("joined")))
        .select("doc_id", "chunk_id", "level", "content", "has_subitems", "pos", F.length("content").alias("content_length"))
    )


def rag_records(chunks: DataFrame) -> DataFrame:
    """text and metadata (JSON) of each chunk."""
    meta = F.to_json(F.struct("chunk_id", "level", "has_subitems", "content_length"))
    return chunks.select("doc_id", "chunk_id", F.col("content").alias("text"), meta.alias("metadata"))


def as_markdown(chunks: DataFrame) -> DataFrame:
    """One Markdown text a document: chunks under their ids, parted by rules."""
    block = F.concat(F.lit("## "), "chunk_id", F.lit("\n\n"), "content")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "chunk_id", block.alias("b")))), lambda x: x["b"])
    return chunks.groupBy("doc_id").agg(F.array_join(parts, "\n\n---\n\n").alias("markdown"), F.count("*").alias("n_chunks"))


def heading_paths(items: DataFrame, levels: int) -> DataFrame:
    """Content rows (level null) with the headings above them: a heading ends those at its level and below.

    One running maximum a level, in one window: heading L holds while it came after all
    headings of higher levels.
    """
    order = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = items
    for k in range(1, levels + 1):
        here = F.when(F.col("level") == k, F.struct("pos", "text"))
        rows = rows.withColumn(f"h{k}", F.last(here, ignorenulls=True).over(order))
    floor, kept = F.lit(-1).cast("long"), []
    for k in range(1, levels + 1):
        at = F.col(f"h{k}")
        kept.append(F.when(at["pos"] > floor, at["text"]))
        floor = F.greatest(floor, F.coalesce(at["pos"], F.lit(-1)))
    path = F.concat_ws(" > ", *kept)
    return rows.filter("level IS NULL").select("doc_id", "pos", "text", path.alias("path"))


def page_chunks(items: DataFrame, separator: str = "\n\n") -> DataFrame:
    """doc_id, page_no, text of all of a page's elements in order."""
    texts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    return items.groupBy("doc_id", "page_no").agg(F.array_join(texts, separator).alias("text"), F.count("*").alias("n_items"))


def contextualised(chunks: DataFrame, separator: str = "\n") -> DataFrame:
    """The text to embed: headings, then the chunk."""
    return chunks.withColumn("context", F.concat_ws(separator, F.nullif(F.col("path"), F.lit("")), F.col("text")))


def identified(all_units: DataFrame, level: str, identifier: str) -> DataFrame:
    """The chunks of ``level`` that ``identifier`` names ("5", "5.1", "5.1.a"), with what they refer to.

    doc_id, chunk_id, content, references (type, target, position) and footnotes (number, text):
    of several marks of one footnote one.
    """
    from vellum.functions import refs

    name = {"paragraph": "paragraf"}.get(level, level)
    wanted = unit_chunks(all_units, level, emit_leaf=True).filter(F.col("chunk_id") == f"{name}-{identifier}")
    found = wanted.select("doc_id", "chunk_id", "content", refs.references(F.col("content")).alias("references"))
    marks = F.transform(refs.footnote_marks(F.col("content")), lambda m: F.regexp_extract(m["marker"], r"(\d+)", 1))
    numbers = found.select("doc_id", "chunk_id", F.explode(F.array_distinct(F.filter(marks, lambda m: m != ""))).alias("number"))
    notes = all_units.filter("level = 'footnote'").select(
        "doc_id", F.regexp_replace("unit_id", "^footnote-", "").alias("number"), F.col("text").alias("note")
    )
    said = numbers.join(notes, ["doc_id", "number"]).groupBy("doc_id", "chunk_id").agg(
        F.sort_array(F.collect_list(F.struct("number", F.col("note").alias("text")))).alias("footnotes")
    )
    none = F.array().cast(said.schema["footnotes"].dataType)
    return found.join(said, ["doc_id", "chunk_id"], "left").withColumn("footnotes", F.coalesce("footnotes", none))


def generated(chunks: DataFrame, column: str = "text") -> DataFrame:
    """Chunks that say something: neither empty nor of an unknown element."""
    said = F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", "")
    return chunks.filter(F.coalesce((said != "") & (said != "<unknown>"), F.lit(False)))
