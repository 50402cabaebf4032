"""Chunks with the texts of what they refer to, in their own law and in others, and of what these refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.session import written

#: A paragraph, and the number of the law that has it if that is another one.
MENTION = r"§\s+([0-9]+[a-zA-Z]*)(?:\s+(?:zákona\s+)?č\.\s*([0-9]+/[0-9]{4}))?"
#: What tells a target: its document and paragraph, or the law as written where no document is known for it.
TARGET = ("target_doc", "law", "target")


def mentions(rows: DataFrame, register: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, ``key`` and TARGET of each paragraph that ``text`` names, once.

    register: law ("595/2003"), doc_id; of several documents of a law the smallest counts. A
    paragraph without a law is the document's own. A law that the register lacks has a null
    target_doc and keeps its number; law is null otherwise.
    """
    each = F.arrays_zip(F.regexp_extract_all(text, F.lit(MENTION), F.lit(1)).alias("target"), F.regexp_extract_all(text, F.lit(MENTION), F.lit(2)).alias("law"))
    found = rows.select("doc_id", key, F.explode(each).alias("m")).select("doc_id", key, "m.*").distinct()
    found = written(found, "mentions")
    # Own paragraphs don't go through the join: without a law they would all meet in one task.
    own = found.filter("law = ''").select("doc_id", key, F.col("doc_id").alias("target_doc"), F.lit(None).cast("string").alias("law"), "target")
    known = register.groupBy("law").agg(F.min("doc_id").alias("target_doc"))
    others = found.filter("law <> ''").join(known, "law", "left")
    law = F.when(F.col("target_doc").isNull(), F.col("law"))
    return own.unionByName(others.select("doc_id", key, "target_doc", law.alias("law"), "target")).distinct()


def reached(chunks: DataFrame, paragraphs: DataFrame, register: DataFrame, depth: int = 1) -> DataFrame:
    """doc_id, chunk_id, TARGET, distance: what chunks refer to in at most ``depth`` steps, each with its least distance.

    chunks: doc_id, chunk_id ("odsek-5.1" and the like), content; paragraphs: doc_id, target (its
    number), pos, text. The paragraph that a chunk belongs to isn't reached, so circles end; a
    target that is reached again isn't followed again. A step joins what is new with the
    paragraphs' own mentions and is written once. Chunks that share an id share what they reach.
    """
    own = F.regexp_extract("chunk_id", r"^[^-]+-([0-9a-zA-Z]+)", 1)
    itself = (F.col("target_doc") == F.col("doc_id")) & (F.col("target") == own)
    other = lambda rows: rows.filter(~F.coalesce(itself, F.lit(False)))
    found = written(other(mentions(chunks, register, "chunk_id", "content")).withColumn("distance", F.lit(1)), "reached")
    if depth < 2:
        return found
    named = mentions(paragraphs.withColumnRenamed("target", "at"), register, "at", "text")
    edges = written(named.withColumnRenamed("doc_id", "at_doc"), "edges")
    for step in range(2, depth + 1):
        front = found.filter((F.col("distance") == step - 1) & F.col("target_doc").isNotNull())
        front = front.select("doc_id", "chunk_id", F.col("target_doc").alias("at_doc"), F.col("target").alias("at"))
        further = other(front.join(edges, ["at_doc", "at"]).select("doc_id", "chunk_id", *TARGET)).withColumn("distance", F.lit(step))
        found = found.unionByName(further).groupBy("doc_id", "chunk_id", *TARGET).agg(F.min("distance").alias("distance"))
        found = written(found, "reached")
    return found


def with_references(chunks: DataFrame, paragraphs: DataFrame, register: DataFrame, depth: int = 1) -> DataFrame:
    """``chunks`` with ``references``: (distance, target_doc, law, target, text) of what they reach(), nearest first.

    Targets that are missing, for want of their law or of their paragraph in it, have a null
    text. Of paragraphs with one number the last by ``pos`` is the target. Chunks that refer to
    nothing, and those without a document or an id, have an empty array.
    """
    found = reached(chunks, paragraphs, register, depth)
    texts = paragraphs.groupBy(F.col("doc_id").alias("target_doc"), "target").agg(F.max_by("text", "pos").alias("text"))
    known = found.filter("target_doc IS NOT NULL").join(texts, ["target_doc", "target"], "left")
    said = known.unionByName(found.filter("target_doc IS NULL"), allowMissingColumns=True)
    each = F.sort_array(F.collect_list(F.struct("distance", *TARGET, "text"))).alias("references")
    held = said.groupBy("doc_id", "chunk_id").agg(each)
    none = F.array().cast(held.schema["references"].dataType)
    return chunks.join(held, ["doc_id", "chunk_id"], "left").withColumn("references", F.coalesce("references", none))
