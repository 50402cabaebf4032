"""Exact nearest neighbours among binary codes by incremental multi-index hashing.

A code is cut into segments, each with an index of its own: a code lies under its value in each
segment. A search looks up, segment by segment, every value that differs from the query's in
exactly r bits, and verifies the codes that it meets by their whole Hamming distance. Codes that no
segment has met within radius r differ by at least r + 1 in each of m segments; so once the
k-th verified distance is below m * (r + 1), no unseen code can be as near, and the search
ends. Otherwise r grows by one.

The index is laid out once by (segment, value); each radius sends only probes to it, each to one
value. Equal codes are one entry, so a vector that a third of all rows share is looked up
once; a value that very many codes have in a segment is dealt among salts. Lookup and
verification are joins and bit operations in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.shared import hot_of, salted, spread, tidy, written


@dataclass(frozen=True)
class Layout:
    """``segments`` of ``width`` bits each, as many of them in a 64-bit word as fit whole."""

    segments: int
    width: int

    @property
    def a_word(self) -> int:
        return 64 // self.width

    @property
    def words(self) -> int:
        return -(-self.segments // self.a_word)

    def values(self, code: Column) -> list[Column]:
        """The value of each segment of a code."""
        low = F.lit((1 << self.width) - 1) if self.width < 64 else F.lit(-1)
        word = lambda s: F.get(code, F.lit(s // self.a_word))
        return [F.shiftrightunsigned(word(s), self.width * (s % self.a_word)).bitwiseAND(low) for s in range(self.segments)]


def sign_codes(vectors: DataFrame, layout: Layout, *, id_column: str, vector_column: str) -> DataFrame:
    """id and ``code``, the signs of the vector's components, as 64-bit words by ``layout``.

    Bit i of the segments in a row is set where component i is above 0. Components that lack count as 0, as do
    nulls and NaN; rows without a vector or without an id have no code.
    """
    segments, width, words, a_word = layout.segments, layout.width, layout.words, layout.a_word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column(1)
            flat = vector.flatten().fill_null(0).to_numpy(zero_copy_only=False) > 0
            sizes = vector.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            signs = np.zeros((len(sizes), width * segments), np.uint64)
            signs[row, at] = flat
            values = (signs.reshape(len(sizes), segments, width) << np.arange(width, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
            code = np.zeros((len(sizes), words), np.uint64)
            for s in range(segments):
                code[:, s // a_word] |= values[:, s] << np.uint64(width * (s % a_word))
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * words, pa.int32()), pa.array(code.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes], ["id", "code"])

    chosen = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector")).dropna()
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(tidy(run), f"id {kind}, code array<long>")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    segments: int | None = None,
) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the ``k`` nearest rows of each query's id.

    ``queries`` holds ids of ``vectors``. Ties go to the smaller id; a query's own row is
    a neighbour like any other. With fewer than k rows there are as many neighbours.
    Queries without a vector, and null ids, have none. Rows that repeat an id with
    another vector are neighbours of their own. Further columns aren't read; an empty
    table gives no rows. Without ``segments`` a segment has about as many bits as the
    number of rows, so an entry of an index meets about one code.
    """
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size(F.col(f"`{vector_column}`"))).alias("bits")).first()
    rows, bits = facts["n"], max(facts["bits"] or 1, 1)
    m = segments or max(1, math.ceil(bits / max(4.0, math.log2(max(rows, 2)))))
    m = max(m, math.ceil(bits / 62))
    width = math.ceil(bits / m)
    layout = Layout(m, width)
    codes = written(sign_codes(vectors, layout, id_column=id_column, vector_column=vector_column), "codes")
    # Only the k smallest ids of a code can be among k nearest rows.
    place = F.row_number().over(W.partitionBy("code").orderBy("id"))
    members = codes.withColumn("place", place).filter(F.col("place") <= k)
    members = written(members.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "members")
    index, hot = indexed(members, layout)
    asked = queries.select(F.col(queries.columns[0]).alias("query_id")).distinct().join(codes, F.col("query_id") == F.col("id"))
    asked = written(asked.select("query_id", F.col("code").alias("q")).distinct(), "asked")
    opened = asked.select("q").distinct().withColumn("bound", F.lit(bits + 1))
    least = min(k, members.agg(F.sum(F.size("ids"))).first()[0] or 0)
    kind = codes.schema["id"].dataType.simpleString()
    best, finished = None, []
    for radius in range(width + 1 if least else 0):
        met = ring(opened, index, hot, layout, radius)
        found = met if best is None else best.join(opened, "q", "left_semi").unionByName(met)
        rank = F.row_number().over(W.partitionBy("q").orderBy("distance", "neighbour_id"))
        best = written(found.withColumn("rank", rank).filter(F.col("rank") <= k), "best")
        covered = m * (radius + 1) - 1
        done = best.filter((F.col("rank") == least) & (F.col("distance") <= covered)).select("q")
        finished.append(best.join(done, "q", "left_semi") if radius < width else best)
        furthest = best.groupBy("q").agg(F.max(F.when(F.col("rank") == least, F.col("distance"))).alias("last"))
        opened = opened.join(done, "q", "left_anti").join(furthest, "q", "left")
        opened = written(opened.select("q", F.coalesce("last", F.lit(bits + 1)).alias("bound")), "open")
        best = best.drop("rank")
        if not opened.limit(1).count():
            break
    index.unpersist()
    if not finished:
        return codes.sparkSession.createDataFrame([], f"query_id {kind}, rank int, neighbour_id {kind}, distance int")
    near = finished[0]
    for more in finished[1:]:
        near = near.unionByName(more)
    return asked.join(near, "q").select("query_id", "rank", "neighbour_id", "distance")


def indexed(members: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """key, __salt, segment, code, ids: each code under its value in each segment, laid out once; and the hot keys.

    The layout stays on the executors' disks; what a lost one held is read again from ``members``.
    """
    places = F.array(*[F.struct(F.lit(s).alias("segment"), v.alias("value")) for s, v in enumerate(layout.values(F.col("code")))])
    entries = members.select("code", "ids", F.inline(places)).withColumn("key", F.xxhash64("segment", "value"))
    counts = written(entries.groupBy("key").agg(F.count("*").alias("rows")), "values")
    hot = written(hot_of(counts, "key", counts.agg(F.sum("rows")).first()[0] or 0), "hot")
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = salted(entries, hot, "key", "code").select("key", F.col("__salt").alias("salt"), "segment", "code", "ids")
    return laid.repartition(parts, "key", "salt").persist(StorageLevel.DISK_ONLY), hot


def probed(opened: DataFrame, index: DataFrame, hot: DataFrame, layout: Layout, radius: int) -> DataFrame:
    """q, bound, segment, code, ids: the codes under each value that differs from the query's in ``radius`` bits."""
    masks = [sum(1 << i for i in chosen) for chosen in combinations(range(layout.width), radius)]
    places = F.array(*[F.struct(F.lit(s).alias("own"), v.alias("value")) for s, v in enumerate(layout.values(F.col("q")))])
    probes = opened.select("q", "bound", F.inline(places)).withColumn("mask", F.explode(F.lit(masks).cast("array<long>")))
    probes = probes.select("q", "bound", "own", F.xxhash64("own", F.col("value").bitwiseXOR(F.col("mask"))).alias("key"))
    sent = spread(probes, hot, "key").select("q", "bound", "own", "key", F.col("__salt").alias("salt"))
    # The index stays where it is: its size grows with the input, whatever Spark takes it for.
    return sent.join(index.hint("merge"), ["key", "salt"]).filter("own = segment").select("q", "bound", "segment", "code", "ids")


def ring(opened: DataFrame, index: DataFrame, hot: DataFrame, layout: Layout, radius: int) -> DataFrame:
    """q, neighbour_id, distance of codes that some segment meets at exactly ``radius`` and none nearer.

    The first segment of those reports the code, so it comes once. Beyond a query's bound,
    its k-th distance so far, nothing is reported.
    """
    met = probed(opened, index, hot, layout, radius)
    word = lambda c, j: F.get(c, F.lit(j))
    apart = [word("q", j).bitwiseXOR(word("code", j)) for j in range(layout.words)]
    met = met.withColumn("apart", F.array(*apart))
    each = [F.bit_count(v) for v in layout.values(F.col("apart"))]
    # Equal to the radius in its own segment; above it in those before, no less in those behind.
    first = F.lit(True)
    for s, far in enumerate(each):
        first = first & F.when(F.col("segment") > s, far > radius).otherwise(far >= radius)
    distance = sum(F.bit_count(word("apart", j)) for j in range(layout.words))
    met = met.filter(first).withColumn("distance", distance.cast("int")).filter("distance <= bound")
    return met.select("q", F.explode("ids").alias("neighbour_id"), "distance")
