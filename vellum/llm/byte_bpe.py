"""Byte-level BPE: texts to ids by a table of ranks, and ids back to bytes.

A long text is cut into overlapping chunks that are pre-tokenised on their own, wherever
they lie. A chunk's scan runs on into the next chunk; where it meets a boundary of that
chunk's own scan both go on alike, because a scan depends only on what follows. The text is
stitched there: the piece of one chunk ends and that of the next begins. Pieces are encoded
in parallel, and a text's ids are those of its pieces in a row. Decoding looks up each
id's bytes and lays them end to end.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.shared import bounded_batches, text_or_empty, tidy, written


@dataclass(frozen=True)
class Vocabulary:
    """``ranks``: a file of lines with a token in base 64 and its rank, which is its id. ``pattern``: the pre-tokens.

    Spark's workers open the file, so it lies at the same place on every machine.
    """

    ranks: str
    pattern: str


@dataclass(frozen=True)
class Chunks:
    """``size`` and ``overlap`` in code points. ``apart`` finds a place where every scan has a boundary behind its first character.

    Chunks overlap until behind such a place, so two scans always meet. ``margin``: how far behind a
    boundary the pattern may look.
    """

    size: int = 1 << 15
    overlap: int = 256
    apart: str = r"\S\s"
    margin: int = 8


class Codec:
    #: A run of white space from which on the encoder's own scan may exhaust its stack.
    RUN = re.compile(r"\s{50000}")

    def __init__(self, vocabulary: Vocabulary):
        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.scan = regex.compile(vocabulary.pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if len(text) >= 50000 and self.RUN.search(text):
            found = [i for m in self.scan.finditer(text) for i in self.encoding._encode_single_piece(m.group())]
        else:
            found = self.encoding.encode_ordinary(text)
        return np.array(found, "<u4").tobytes()

    def bounds(self, text: str, begin: int) -> Iterator[int]:
        """The ends of the pre-tokens of a scan from ``begin``."""
        return (m.end() for m in self.scan.finditer(text, begin))


@lru_cache(maxsize=2)
def codec(vocabulary: Vocabulary) -> Codec:
    """One a worker process."""
    return Codec(vocabulary)


def cuts(text: str, chunks: Chunks) -> Iterator[tuple[int, int, int]]:
    """begin, next chunk's begin, and end of what a chunk shows. The last chunk's next begin is the text's end."""
    begin, apart = 0, re.compile(chunks.apart)
    least = begin + chunks.size
    while least < len(text):
        place = apart.search(text, least + 1)
        if place is None:
            break
        shown = max(least + chunks.overlap, place.start() + 1 + chunks.margin)
        if shown >= len(text):
            break
        yield begin, least, shown
        # What a chunk shows of the next one ends within it, so stitches never cross.
        begin, least = least, max(least + chunks.size, shown)
    yield begin, len(text), len(text)


def stitch(shown: str, core: int, codec: Codec, margin: int) -> int:
    """Where the scan from 0 first meets the scan from ``core``; a boundary behind white space isn't used.

    Behind other characters the text up to there, scanned alone, ends in the same pre-token.
    """
    last = len(shown) - margin

    def usable(bounds: Iterator[int]) -> Iterator[int]:
        for p in bounds:
            if p > last:
                return
            if not shown[p - 1].isspace():
                yield p

    theirs = {core, *usable(codec.bounds(shown, core))}
    for p in usable(codec.bounds(shown, 0)):
        if p in theirs:
            return p
    raise ValueError("two scans don't meet: the pattern may join what Chunks.apart holds to be apart")


def encode(
    docs: DataFrame, vocabulary: Vocabulary, chunks: Chunks = Chunks(), *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) of every row of ``docs``, without special tokens.

    Null and empty texts have no ids. Names of special tokens are text like any other. Rows
    that repeat an id, or have none, are rows of their own; further columns aren't read,
    whatever their names; an empty table gives no rows. Only texts longer than a chunk are shuffled.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(F.col(f"`{text_column}`")).alias("body")
    )
    long = F.char_length("body") > chunks.size
    kind = rows.schema["doc_id"].dataType.simpleString()
    short = rows.filter(~long).select("doc_id", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            yield _ids(batch.column(0), [tool.ids(text.as_py()) for text in batch.column(1)])

    near = short.mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, ids binary")
    return near.unionByName(_long(rows.filter(long), vocabulary, chunks, kind))


def _ids(doc_id: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    return pa.RecordBatch.from_arrays([doc_id, pa.array(counts), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])


def _long(rows: DataFrame, vocabulary: Vocabulary, chunks: Chunks, kind: str) -> DataFrame:
    """encode() of texts that are longer than a chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, body in zip(*batch.columns, strict=True):
                text = body.as_py()
                for number, (a, core, b) in enumerate(cuts(text, chunks)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([doc_id], doc_id.type), pa.array([number], pa.int32()),
                         pa.array([core - a], pa.int32()), pa.array([core == len(text)]), pa.array([text[a:b]])],
                        ["key", "doc_id", "chunk", "core", "last", "body"],
                    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            facts = zip(batch.column("body"), batch.column("core").to_pylist(), batch.column("last").to_pylist(), strict=True)
            ends = [core if last else stitch(body.as_py(), core, tool, chunks.margin) for body, core, last in facts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "doc_id", "chunk", "core", "body")), pa.array(ends, pa.int32())],
                ["key", "doc_id", "chunk", "core", "body", "end"],
            )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in batches:
            facts = zip(batch.column("body"), batch.column("begin").to_pylist(), batch.column("end").to_pylist(), strict=True)
            ids = [tool.ids(body.as_py()[a:b]) for body, a, b in facts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "doc_id", "chunk")), pa.array(ids, pa.binary())], ["key", "doc_id", "chunk", "ids"]
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come in order of key and chunk; one text's are held at a time."""
        key, doc_id, held = None, None, []
        for batch in batches:
            for k, d, ids in zip(*(batch.column(c) for c in ("key", "doc_id", "ids")), strict=True):
                if held and k != key:
                    yield _ids(pa.array([doc_id], doc_id.type), [b"".join(held)])
                    held = []
                key, doc_id = k, d
                held.append(ids.as_py())
        if held:
            yield _ids(pa.array([doc_id], doc_id.type), [b"".join(held)])

    head = f"key long, doc_id {kind}, chunk int"
    cut_rows = rows.mapInArrow(tidy(cut), f"{head}, core int, last boolean, body string").repartition("key", "chunk")
    met = written(cut_rows.mapInArrow(tidy(meet), f"{head}, core int, body string, end int"), "chunks")
    # The end of a chunk's piece, counted from the next chunk's begin, is where that one's piece begins.
    begins = met.select("key", (F.col("chunk") + 1).alias("chunk"), (F.col("end") - F.col("core")).alias("begin"))
    whole = met.join(begins, ["key", "chunk"], "left").withColumn("begin", F.coalesce("begin", F.lit(0)))
    some = whole.select("key", "doc_id", "chunk", "body", "begin", "end").mapInArrow(tidy(pieces), f"{head}, ids binary")
    dealt = some.repartition("key").sortWithinPartitions("key", "chunk")
    return dealt.mapInArrow(tidy(join), f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary, *, ids_column: str = "ids", bytes_column: str = "bytes") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, which needn't be whole characters.

    Null ids give null, no ids give no bytes. An id that the vocabulary lacks ends the job with
    an error. Further columns stay as they are, but for one that ``bytes_column`` replaces.
    """
    bounded_batches(encoded.sparkSession)
    kept = encoded.drop(bytes_column)
    at, names = kept.columns.index(ids_column), [*kept.columns, bytes_column]
    schema = kept.withColumn(bytes_column, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(vocabulary).tokens
        for batch in batches:
            column = batch.column(at)
            sizes = column.is_null().to_numpy(zero_copy_only=False)
            raw = b"".join(x for x in column.to_pylist() if x)
            counts = np.array([len(x or b"") // 4 for x in column.to_pylist()], np.int64)
            found = tokens.take(pa.array(np.frombuffer(raw, "<u4")))
            if found.null_count:
                raise ValueError("an id isn't in the vocabulary")
            # The looked-up tokens lie end to end in one buffer: a row's bytes are a part of it.
            ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)
            bounds = ends[np.concatenate(([0], np.cumsum(counts)))] if len(found) else np.zeros(len(counts) + 1, np.int64)
            data = found.buffers()[2] if len(found) else pa.py_buffer(b"")
            joined = pa.Array.from_buffers(
                pa.large_binary(), len(counts), [pa.array(~sizes).buffers()[1], pa.py_buffer(bounds.tobytes()), data]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, joined.cast(pa.binary())], names)

    return kept.mapInArrow(tidy(run), schema)


def public_vocabulary() -> Vocabulary:
    """The public ranks and pattern that the installed tokenizers' package names."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
