"""Members of equal keys brought together, combined within a task before they are shuffled.

A task sends one entry a key, its smallest member and whether it has more; its other members
stay where they are and go on as they come. So a key that very many rows have sends one entry a
task, and only entries meet: as packed arrays, in buckets of keys that are sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vellum.llm.shared import bounded_batches, tidy

#: Numbers that are sorted together and that a task holds, keys of a packed array, and a key's bits in its bucket.
BUCKET, HELD, PACKED, KEY_BITS = 1 << 20, 1 << 21, 4096, 40


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as bytes: each less its least, the bytes of a place together, as few as are needed."""
    out = [len(columns[0]).to_bytes(4, "little")]
    for column in columns:
        low = int(column.min())
        rest = (column.astype(np.int64) - low).view(np.uint64)
        width = (int(rest.max()).bit_length() + 7) // 8
        planes = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
        out += [low.to_bytes(8, "little", signed=True), width.to_bytes(1, "little"), planes.tobytes()]
    return b"".join(out)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    rows, at, out = int.from_bytes(data[:4], "little"), 4, []
    for _ in range(columns):
        low, width = int.from_bytes(data[at : at + 8], "little", signed=True), data[at + 8]
        at += 9
        wide = np.zeros((rows, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, rows * width, at).reshape(width, rows).T
        out.append(wide.view("<u8").ravel().astype(np.int64) + low)
        at += rows * width
    return out


def _groups(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


class Combiner:
    """A task's keys and members, combined whenever it holds HELD of them.

    A member is a whole number, or several columns of them. The lowest ``flags`` bits of a single
    number say something about it: of members that differ only there the one with the larger bits
    stays.
    """

    def __init__(self, buckets: int, flags: int, hub: bool):
        self.buckets, self.flags, self.hub, self.task = buckets, flags, hub, TaskContext.get().partitionId()
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, keys: np.ndarray, *members: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keys are 64-bit hashes, members whole numbers."""
        self.held.append((keys, *members))
        self.size += len(keys) * (1 + len(members))
        if self.size >= HELD:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, *members = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        bucket = (keys >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)
        code = (bucket << np.uint64(KEY_BITS) | keys & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)
        rows = list(self._rows(*_sorted(code, members, self.flags)))
        for a in range(0, len(rows), 256):
            some = list(zip(*rows[a : a + 256], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[0], pa.int32()), pa.array(some[1], pa.int64()), pa.array(some[2], pa.binary())],
                ["bucket", "base", "entries"],
            )

    def _rows(self, code: np.ndarray, members: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
        """bucket, first key, packed entries. Members beside the smallest have a negative number, past the buckets."""
        first = _groups(code)
        sizes = np.diff(np.append(first, len(code)))
        later = np.ones(len(code), bool)
        later[first] = False
        other = np.flatnonzero(later)
        gone = [*members, np.repeat(members[0][first], sizes)] if self.hub else members
        for a in range(0, len(other), PACKED):
            some = other[a : a + PACKED]
            steps = np.diff(code[some], prepend=code[some[0]])
            # Any place will do, another one for each array: a group may lie in few tasks.
            yield -1 - (self.task * 10_007 + a // PACKED) % 1_000_003, int(code[some[0]]), packed(steps, *[m[some] for m in gone])
        code, members, more = code[first], [m[first] for m in members], (sizes > 1).astype(np.int64)
        ends = np.searchsorted(code >> KEY_BITS, np.arange(self.buckets + 1))
        for bucket in np.flatnonzero(np.diff(ends)).tolist():
            for a in range(int(ends[bucket]), int(ends[bucket + 1]), PACKED):
                some = slice(a, min(a + PACKED, int(ends[bucket + 1])))
                steps = np.diff(code[some], prepend=code[a]) << 1 | more[some]
                yield bucket, int(code[a]), packed(steps, *[m[some] for m in members])


def _groups(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def _sorted(code: np.ndarray, members: list[np.ndarray], flags: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys and members in order, each member once."""
    order = np.lexsort((*members[::-1], code))
    code, members = code[order], [m[order] for m in members]
    last = np.ones(len(code), bool)
    last[:-1] = code[1:] != code[:-1]
    for m in members:
        last[:-1] |= m[1:] >> flags != m[:-1] >> flags
    return code[last], [m[last] for m in members]


def tiles(
    df: DataFrame, keyed: Callable[[Iterator[pa.RecordBatch], Combiner], Iterator[pa.RecordBatch]], keys: int, *,
    flags: int = 0, columns: tuple[str, ...] = ("id",), hub: bool = True,
) -> DataFrame:
    """key, ``columns`` of all members of keys with two or more, of a task or of all; all are longs.

    ``keyed`` adds the keys of its batches to the combiner. ``keys``: about how many there are in
    all. With ``hub`` there is the smallest member besides: the smallest one of a task comes with
    the smallest of all, the others with that of their task. A member that several tasks have may
    come several times.
    """
    bounded_batches(df.sparkSession)
    buckets, names = max(1, -(-keys * (1 + len(columns)) // BUCKET)), ["key", *columns, *(["hub"] if hub else [])]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combined = Combiner(buckets, flags, hub)
        yield from keyed(batches, combined)
        yield from combined.end()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(*values: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(values[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in values], names)

        def together() -> Iterator[pa.RecordBatch]:
            flagged, *members = (np.concatenate(x) for x in zip(*held))
            more = np.unique(flagged[flagged & 1 > 0] >> 1)
            code, members = _sorted(flagged >> 1, members, flags)
            first = _groups(code)
            sizes = np.diff(np.append(first, len(code)))
            kept = np.repeat((sizes > 1) | np.isin(code[first], more), sizes)
            smallest = [np.repeat(members[0][first], sizes)] if hub else []
            yield from rows(*[x[kept] for x in (code, *members, *smallest)])

        held, last = [], None
        for batch in batches:
            for bucket, base, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket < 0:
                    steps, *members = unpacked(data, len(names))
                    yield from rows(base + np.cumsum(steps), *members)
                    continue
                if held and bucket != last:
                    yield from together()
                    held = []
                steps, *members = unpacked(data, 1 + len(columns))
                held.append(((base + np.cumsum(steps >> 1)) << 1 | steps & 1, *members))
                last = bucket
        if held:
            yield from together()

    dealt = df.mapInArrow(tidy(sent), "bucket int, base long, entries binary")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(tidy(met), ", ".join(f"{n} long" for n in names))
