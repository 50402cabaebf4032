"""Importance resampling towards a target corpus, by hashed n-grams, without replacement.

Each bucket of hashed features gets a gain, the logarithm of how much more often the target
has it; a text's weight is the sum over its features, looked up in an array. Weights with
Gumbel noise are whole numbers, so the highest of them are found by an exact histogram:
the number of rows above each score is a suffix sum, and the scores with less than the
wanted number above them are those from the cutoff on. Only their rows are put in order,
each score's by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.shared import bounded_batches, slices, text_or_empty, tidy, written


@dataclass(frozen=True)
class Draw:
    """``percent`` of the texts with ``least_words`` words are drawn; features are runs of 1 to ``grams`` words."""

    grams: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


#: Fixed value: what lies between words, after A-Z were made lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Texts are taken in slices of about so many bytes; distinct scores of a piece of the histogram.
SLICE, PIECE = 1 << 20, 50_000


def hashed(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words and how many features each text has, and all features' buckets, text by text.

    Each distinct feature of ``texts`` is hashed once.
    """
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    words, of = parts.flatten(), pc.list_parent_indices(parts)
    there = pc.not_equal(words, "")
    words, of = words.filter(there), of.filter(there).to_numpy()
    codes, owners = [], []
    for n in range(1, grams + 1):
        first = np.flatnonzero(of[: len(of) - n + 1] == of[n - 1 :]) if len(of) >= n else np.zeros(0, np.int64)
        runs = [words.take(pa.array(first + k)) for k in range(n)]
        features = (runs[0] if n == 1 else pc.binary_join_element_wise(*runs, " ")).dictionary_encode()
        known = np.fromiter((crc32(f.encode()) % buckets for f in features.dictionary.to_pylist()), np.int32, len(features.dictionary))
        codes.append(known[features.indices.to_numpy()])
        owners.append(of[first])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    size = len(texts)
    return np.bincount(of, minlength=size), np.bincount(owner, minlength=size), np.concatenate(codes)[order]


def features(docs: DataFrame, draw: Draw, *, id_column: str | None, text_column: str = "text") -> DataFrame:
    """doc_id, words, buckets: a bucket for each feature of each whole text. Without ``id_column`` no doc_id."""
    bounded_batches(docs.sparkSession)
    body = text_or_empty(F.col(f"`{text_column}`")).alias("body")
    rows = docs.select(body) if id_column is None else docs.select(body, F.col(f"`{id_column}`").alias("doc_id"))

    ids = rows.schema.fields[1:]
    names = [*(f.name for f in ids), "words", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "body", SLICE):
                words, counts, codes = hashed(some.column("body"), draw.grams, draw.buckets)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes, pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns[1:], pa.array(words, pa.int64()), lists], names)

    kinds = "".join(f"doc_id {f.dataType.simpleString()}, " for f in ids)
    return rows.mapInArrow(tidy(run), f"{kinds}words long, buckets array<int>")


def bucket_counts(found: DataFrame, buckets: int) -> list[int]:
    """How many of all features are in each bucket: ``buckets`` numbers, whatever the corpus."""
    counts = found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect()
    total = [0] * buckets
    for row in counts:
        total[row["bucket"]] = row["n"]
    return total


def gains(target: list[int], source: list[int]) -> np.ndarray:
    """A bucket's gain in thousandths, floored: the logarithm of its smoothed share in the target over that in the source."""
    big_t, big_s, width = sum(target), sum(source), len(source)
    pairs = zip(target, source, strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + width) / ((s + 1) * (big_t + width)))) for t, s in pairs], np.int64)


def gumbel(doc_id: Column, seed: str) -> Column:
    """Noise in thousandths that depends on the seed and the id only; a null id is taken as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    part = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((part + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, draw: Draw = Draw(), *, id_column: str = "doc_id", text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score of every row of ``docs``, and the rank of those that are drawn, else null.

    Of the texts with enough words the highest scores are drawn, ties to the smaller id. Null and empty
    texts have no words and weight 0. Rows that repeat an id are rows of their own with the same noise;
    among rows of equal score and id, any may come first, they differ in nothing but their features. Null ids come
    last among ties. Further columns aren't read, whatever their names. Without a target the gains
    favour what is rare; an empty table gives no rows.
    """
    found = written(features(docs, draw, id_column=id_column, text_column=text_column), "features")
    wanted = bucket_counts(features(target, draw, id_column=None, text_column=target_column), draw.buckets)
    table = docs.sparkSession.sparkContext.broadcast(gains(wanted, bucket_counts(found, draw.buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            sums = np.concatenate(([0], np.cumsum(table.value[lists.flatten().to_numpy()])))
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("words"), pa.array(np.diff(ends), pa.int64()), pa.array(np.diff(sums[ends]), pa.int64())],
                ["doc_id", "words", "n_features", "weight"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    weighed = found.mapInArrow(tidy(run), f"doc_id {kind}, words long, n_features long, weight long")
    weighed = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), draw.seed))
    scored = written(weighed.withColumn("eligible", F.col("words") >= draw.least_words), "scored")
    return ranked(scored, draw.percent).select("doc_id", "n_features", "weight", "score", "rank")


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``scored`` (doc_id, score, eligible and more) with ``rank``: 1, 2, 3 ... for the highest ``percent`` of the eligible rows."""
    size = scored.filter("eligible").count() * percent // 100
    above = _above(scored.filter("eligible"))
    cutoff = above.filter(F.col("above") < size).agg(F.min("score")).first()[0]
    if cutoff is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    survives = F.col("eligible") & (F.col("score") >= cutoff)
    place = F.row_number().over(W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight"))
    drawn = scored.filter(survives).join(above.filter(F.col("score") >= cutoff), "score")
    drawn = drawn.withColumn("rank", (F.col("above") + place).cast("long"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank")))
    rest = scored.filter(~survives).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*scored.columns, "rank").unionByName(rest)


def _above(rows: DataFrame) -> DataFrame:
    """score, above: for each distinct score, how many of ``rows`` have a higher one.

    The histogram is cut into ranges of scores; a range's first offset is the sum of the ranges
    above it, of which there are 4,096 at most.
    """
    spark = rows.sparkSession
    counts = written(rows.groupBy("score").agg(F.count("*").alias("n")), "histogram")
    pieces = min(4096, max(int(spark.conf.get("spark.sql.shuffle.partitions")), counts.count() // PIECE))
    dealt = counts.repartitionByRange(pieces, F.col("score").desc()).withColumn("piece", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    sums = dealt.groupBy("piece").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(W.orderBy("piece").rowsBetween(W.unboundedPreceding, -1))
    offsets = F.broadcast(sums.select("piece", F.coalesce(before, F.lit(0)).alias("before")))
    within = F.sum("n").over(W.partitionBy("piece").orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1))
    found = dealt.withColumn("within", F.coalesce(within, F.lit(0))).join(offsets, "piece")
    return written(found.select("score", (F.col("before") + F.col("within")).alias("above")), "above")
