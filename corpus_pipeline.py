"""From raw documents to packed training sequences: five stages, each over all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm.exact_dedup import deduplicated
from vellum.llm.jaccard import Alike, without_near_copies
from vellum.llm.mixing import mix, repeated
from vellum.llm.packing import Limits, pack_tokens
from vellum.llm.shared import written
from vellum.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts get the model's constant and stay, as all do without labels of both
    classes. Very long texts are judged whole, in pieces. Repeated rows and null ids are judged
    like any other; of labels that contradict each other 1 counts. An empty table stays empty;
    further columns come along, whatever their names.
    """
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the one with the smallest id, null last.

    Null texts are empty, and all empty texts are equal: one of them stays. Very long texts are
    compared whole. Of rows alike in id and text one stays. An empty table stays empty; further
    columns come along, whatever their names.
    """
    return deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts alike by shingles of five words stays: the one with the smallest id.

    Null and empty texts are like nothing and stay. Very long texts are compared whole. Rows that
    share an id go together; null ids come last. An empty table stays empty; further columns come
    along, whatever their names.
    """
    return without_near_copies(docs, Alike(words=5, percent=80))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come once for each slot of the mix that begins to take them, up to three times, in the slots' order.

    Documents without words aren't drawn; a null source is one of its own, the last. Very long
    texts lie in many blocks. Rows that share an id are drawn alike. An empty table stays empty;
    further columns come along, whatever their names.
    """
    return repeated(docs, mix(docs, weights=(1, 2, 3), most_passes=3))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: one row a piece of a document, with its ids.

    Null and empty texts are the end id alone, very long ones are cut. Repeated rows and null ids
    are packed like any other. An empty table gives no rows; further columns aren't read.
    """
    import public_tokenizers

    return pack_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limits=Limits(2048, 256, 2048))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has no n-gram classifier and no tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
