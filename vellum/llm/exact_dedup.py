"""Exact duplicates, safe under any skew, with DataFrame functions only.

Texts are equal when they are the same after white space is deleted. Digests find the
texts that may have copies; whether they are copies is decided by comparing the
normalised text itself, at every stage: within a task (the partial aggregation), within
a salted part of a digest's group, and among the salts' winners. A group of copies is
dealt to a number of salts that follows its size, so no task gets all of a hot group.
Texts without a possible copy are moved once at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import Sieve, hot_of, salted, spread, text_or_empty, without_spaces, written

#: About as many copies go to one salt.
COPIES_A_SALT = 256


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text stays, then
    the one with the smallest id. Null texts count as empty; all empty texts are equal.
    A null id is larger than any other. Rows that repeat an id and a text are copies of
    each other, and one of them is kept. Very long texts are compared whole. Further columns
    aren't read, whatever their names; an empty table gives no rows. Texts of one digest that
    differ stay apart.
    """
    prepared = _prepared(df, id_column, text_column)
    plain, suspects = _suspects(prepared, digest)
    singles = plain.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return singles.unionByName(_members(suspects).drop("row"))


def deduplicated(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The rows of ``df`` that exact_dedup keeps, with all their columns."""
    prepared = _prepared(df, id_column, text_column, whole=True)
    at = _suspect_ids(_digests(prepared, digest))
    sieve = Sieve(at)
    singles = sieve.others(prepared, "doc_id").select("whole.*")
    suspects = _fetched(prepared, at, sieve, digest)
    kept = suspects.join(_members(suspects).filter("kept").select("row"), "row", "left_semi")
    return singles.unionByName(kept.select("whole.*"))


def _prepared(df: DataFrame, id_column: str, text_column: str, whole: bool = False) -> DataFrame:
    """Only the id, the text and perhaps the whole row as a struct go on: no name can clash."""
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")] if whole else []
    return df.select(F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(F.col(f"`{text_column}`")).alias("body"), *row)


def _digests(prepared: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    norm = without_spaces(F.col("body"))
    return written(
        prepared.select("doc_id", F.sha2(norm, 256).alias("text_sha256"), digest(norm).alias("digest")), "digests"
    )


def _suspect_ids(digests: DataFrame) -> DataFrame:
    """Ids of rows whose digest occurs more than once, with the number of its rows."""
    counts = written(digests.groupBy("digest").agg(F.count("*").alias("rows")).filter("rows > 1"), "repeated")
    hot = hot_of(counts, "digest", digests.count())
    found = salted(digests.select("digest", "doc_id"), hot, "digest", "doc_id").join(spread(counts, hot, "digest"), ["digest", "__salt"])
    found = found.groupBy("doc_id").agg(F.max("rows").alias("rows"))
    return written(found.withColumnRenamed("doc_id", "suspect_id"), "suspects")


def _fetched(prepared: DataFrame, at: DataFrame, sieve: Sieve, digest: Callable[[Column], Column]) -> DataFrame:
    """The suspects' texts; ``row`` tells rows with the same id apart. Only texts that may have copies are moved."""
    kept = [c for c in ("whole",) if c in prepared.columns]
    norm = without_spaces(F.col("body"))
    some = sieve.held(prepared, "doc_id")
    found = some.join(at, some["doc_id"].eqNullSafe(at["suspect_id"])).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length("body").alias("points"),
        norm.alias("norm"),
        F.ceil(F.col("rows") / COPIES_A_SALT).cast("int").alias("salts"),
        *kept,
    )
    found = found.withColumn("digest", digest(F.col("norm"))).withColumn("text_sha256", F.sha2("norm", 256))
    return written(found, "copies")


def _suspects(prepared: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    digests = _digests(prepared, digest)
    at = _suspect_ids(digests)
    plain = digests.join(at, digests["doc_id"].eqNullSafe(at["suspect_id"]), "left_anti")
    return plain, _fetched(prepared, at, Sieve(at), digest)


def _members(suspects: DataFrame) -> DataFrame:
    """Each suspect with the row of its group that stays; equal content alone makes a group."""
    dealt = suspects.withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int"))
    place = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    merged = dealt.groupBy("digest", "norm", "salt").agg(
        F.min(place).alias("best"), F.count("*").alias("n"), F.max("salts").alias("salts")
    )
    winners = merged.groupBy("digest", "norm").agg(
        F.min("best").alias("best"), F.sum("n").alias("group_size"), F.max("salts").alias("salts")
    )
    winners = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return dealt.join(winners, ["digest", "norm", "salt"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "row",
    )
