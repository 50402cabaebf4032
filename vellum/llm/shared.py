"""What several operators need: the shared folder, written tables, text helpers."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.rolling import forget_powers

#: The white space of all word and normalisation contracts here.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and everything runs on one machine, as in tests, a temporary
    folder takes its place. On a cluster it would be another folder on each executor.
    """
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='vellum-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Rows and bytes of an Arrow batch: documents are long, and a batch lies in memory on both sides.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold BATCH_ROWS rows and about BATCH_BYTES bytes at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Free memory of this process goes back to the machine."""
    forget_powers()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which gives free memory back now and then, and at its end: the worker stays alive between tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        for k, batch in enumerate(run(batches)):
            yield batch
            if k % 16 == 15:
                give_back()
        give_back()

    return wrapped


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: cuts the lineage."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    """``text`` without any of SPACES; byte-wise replacing, no regular expression."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def with_own_ids(df: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc, body) whose ``doc`` tells them apart, and names (doc, name) where it isn't the id.

    Where ids are whole numbers, all there and different, doc is the id. Otherwise rows are
    numbered in the ids' order, null last, and written, so that all later reads agree on the
    numbers.
    """
    rows = df.select(F.col(f"`{id_column}`").alias("doc"), text_or_empty(F.col(f"`{text_column}`")).alias("body"))
    if rows.schema["doc"].dataType.typeName() in ("byte", "short", "integer", "long"):
        ids = rows.groupBy("doc").count()
        if ids.filter("doc IS NULL OR count > 1").limit(1).count() == 0:
            return rows.withColumn("doc", F.col("doc").cast("long")), None
    numbered = rows.orderBy(F.col("doc").asc_nulls_last(), "body").withColumn("number", F.monotonically_increasing_id())
    numbered = written(numbered.select(F.col("number").alias("doc"), F.col("doc").alias("name"), "body"), "numbered")
    return numbered.select("doc", "body"), numbered.select("doc", "name")


#: Keys that more than one in so many rows have are hot; there can't be more of them than that.
HOT = 256


def hot_of(counts: DataFrame, key: str, total: int, least: int = 2048) -> DataFrame:
    """__hot, __salts: the keys of ``counts`` (key, rows) that more than a HOT-th of ``total`` rows, and ``least``, have.

    Each goes into so many parts that one has about as many rows as the largest key that isn't
    hot. There are fewer than HOT hot keys whatever the table's size, so they may be broadcast.
    """
    most = max(least, total // HOT)
    return counts.filter(F.col("rows") > most).select(F.col(key).alias("__hot"), F.ceil(F.col("rows") / most).cast("int").alias("__salts"))


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The hot keys of ``rows``."""
    counts = written(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")), "counts")
    return hot_of(counts, key, counts.agg(F.sum("rows")).first()[0] or 0)


def salted(rows: DataFrame, hot: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with ``__salt``: hot keys are dealt by ``by`` among their salts, all others have salt 0."""
    found = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    salt = F.when(F.col("__salts").isNotNull(), F.pmod(F.xxhash64(by), F.col("__salts"))).otherwise(0).cast("int")
    return found.withColumn("__salt", salt).drop("__hot", "__salts")


def spread(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``facts``, one row a key, with a row for each salt of a hot key; joins with salted() by key and __salt."""
    found = facts.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    return found.withColumn("__salt", F.explode(salts)).drop("__hot", "__salts")


class Sieve:
    """Which ids a table may hold: a bit for each hash of one, SIEVE_BITS in all, whatever the table's size.

    Rows whose id isn't there needn't be shuffled to a join with the table. Where the table is
    large, most bits are set and nearly all rows are; the result is the same.
    """

    BITS, BUCKET = 1 << 23, 32768

    def __init__(self, ids: DataFrame):
        self.ids = ids.select(F.col(f"`{ids.columns[0]}`").alias("__sieve_id"))
        slot = self._slot(F.col("__sieve_id"))
        rows = self.ids.groupBy(F.floor(slot / self.BUCKET).cast("int").alias("__sieve_bucket"))
        # At most BITS / BUCKET rows of BUCKET / 8 bytes: 1 MB.
        self.bits = written(rows.agg(F.bitmap_construct_agg(slot % self.BUCKET).alias("__sieve_bits")), "sieve")

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.BITS))

    def _marked(self, df: DataFrame, id_column: str) -> DataFrame:
        slot = self._slot(F.col(f"`{id_column}`"))
        marked = df.withColumn("__sieve_bucket", F.floor(slot / self.BUCKET).cast("int")).withColumn("__sieve_at", slot % self.BUCKET)
        byte = F.conv(F.hex(F.substring("__sieve_bits", (F.col("__sieve_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.expr("shiftright(__sieve_byte, cast(__sieve_at % 8 AS int)) & 1") == 1
        found = marked.join(F.broadcast(self.bits), "__sieve_bucket", "left").withColumn("__sieve_byte", byte)
        return found.withColumn("__sieve_may", F.coalesce(bit, F.lit(False)))

    def perhaps(self, df: DataFrame, id_column: str) -> DataFrame:
        """The rows of ``df`` whose id the table may hold: to be joined with it."""
        return self._own(self._marked(df, id_column).filter("__sieve_may"), df)

    def held(self, df: DataFrame, id_column: str) -> DataFrame:
        """The rows of ``df`` whose id the table holds; null ids match null ids."""
        some = self._marked(df, id_column).filter("__sieve_may")
        return self._own(some.join(self.ids, F.col(f"`{id_column}`").eqNullSafe(F.col("__sieve_id")), "left_semi"), df)

    def others(self, df: DataFrame, id_column: str) -> DataFrame:
        """The rows of ``df`` whose id the table doesn't hold; only those that may be there are shuffled."""
        marked = self._marked(df, id_column)
        left = marked.filter("__sieve_may").join(self.ids, F.col(f"`{id_column}`").eqNullSafe(F.col("__sieve_id")), "left_anti")
        return self._own(marked.filter("NOT __sieve_may"), df).unionByName(self._own(left, df))

    def _own(self, rows: DataFrame, df: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`") for c in df.columns])


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes in ``column``; a longer row is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)
