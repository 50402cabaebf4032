"""Texts whose sets of word shingles are alike, exactly, by Jaccard similarity.

Two sets can only be alike if their sizes are, so everything happens within bands of
sizes. In a band the space of shingle hashes is cut into ranges, in a fixed order. A range
that holds enough shingles of a set is strong in it. Two sets differ by a bounded number of
shingles, and each of them spoils one range, so of two sets that are alike the first strong
range in which they agree is among the first ``most differences + 1`` strong ranges of both:
those are a set's keys, and no others are needed. Equal keys make tiles. A strong range mixes
shingles of all of a text, so a passage or line that many texts share rarely makes a tile.

Keys are sorted and combined within a task before they are shuffled, as packed arrays: a
task sends one entry a key, its smallest id, and keeps its other members. Tiles meet as
stars: each member with the smallest one of its task, and those with the smallest of all. So
links that are found join into groups, however large a tile is. Only tiles whose sets then
lie in several groups are left, and only there sets of different groups are compared: by
hashed bitmaps first, whose bit counts bound the overlap from above, and those that pass
by intersecting their sorted shingle arrays. What leaves a tile at each step is bounded by
the rows that went in: members that passed with another, and links that join groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.components import components
from vellum.llm.rolling import MULTIPLIER, OTHER, mix, prefix_sums, substring_hashes
from vellum.llm.shared import Sieve, hot_keys, hot_of, salted, slices, spread, tidy, with_own_ids, written
from vellum.llm.tiles import Combiner, tiles

#: Sets of a tile that are compared in one task, and their shingles.
TILE, WEIGHT = 512, 1 << 18


@dataclass(frozen=True)
class Alike:
    """Sets are alike when overlap / union >= percent / 100; shingles have ``words`` words."""

    words: int = 5
    percent: int = 80

    def band(self, n: int) -> int:
        """Bands are octaves: alike sets lie in the same one or in neighbouring ones."""
        return n.bit_length() - 1

    def top(self, band: int) -> int:
        """The largest size in ``band``."""
        return (2 << band) - 1

    def apart(self, n: int, m: int) -> int:
        """The most shingles that are in one only of two alike sets of these sizes."""
        return (n + m) * (100 - self.percent) // (100 + self.percent)

    def differences(self, n: int, band: int) -> int:
        """The most shingles by which a set differs from one that is alike, the smaller of them being in ``band``."""
        return self.apart(n, n * 100 // self.percent if self.band(n) == band else self.top(band))

    def ranges(self, band: int) -> tuple[int, int]:
        """How many ranges, and how many shingles make one of them strong.

        Any numbers give the same links. These are the strongest ranges of which sets at both
        ends of the band have more than they need, by two standard deviations.
        """
        low, high = 1 << band, self.top(band)
        best = (1, 1)
        for strong in (6, 5, 4, 3, 2):
            spare = -np.inf
            for mean in np.arange(0.5, 8, 0.1):
                count = max(1, round(float(np.sqrt(low * high) / mean)))
                least = np.inf
                for n in (low, high):
                    share = _share_strong(n / count, strong)
                    needed = self.differences(n, band) + 1
                    least = min(least, (count * share - needed) / np.sqrt(max(count * share * (1 - share), 1)))
                if least > spare:
                    spare, best = least, (count, strong)
            if spare >= 2:
                break
        return best


def _share_strong(mean: float, strong: int) -> float:
    """Of ranges with ``mean`` shingles on average, the share with ``strong`` or more."""
    term, below = float(np.exp(-mean)), 0.0
    for k in range(strong):
        below += term
        term *= mean / (k + 1)
    return 1 - below


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of texts that lie one after the other, and each text's bounds in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    space = SPACE[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begin = ~space
    begin[1:] &= space[:-1]
    begin[inner] = ~space[inner]
    stop = ~space
    stop[:-1] &= space[1:]
    stop[inner - 1] = ~space[inner - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, bounds)


def _rolled(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of ``words`` words that follow each other."""
    out = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        out = mix(out * np.uint64(MULTIPLIER) + hashes[k : k + len(out)])
    return out


def shingle_sets(texts: pa.Array, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct shingles as 128-bit hashes: two arrays, sorted by the first and then the second.

    A text of fewer words is one shingle; one without words has none.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = LOWER[np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]] if buffer else np.zeros(0, np.uint8)
    starts, ends, bounds = word_bounds(data, offsets - offsets[0])
    named = [substring_hashes(prefix_sums(data, v), starts, ends) for v in (None, OTHER)]
    rolled = [_rolled(h, words) for h in named]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            one, two = (r[a : b - words + 1] for r in rolled)
        elif b > a:
            one, two = (mix(_rolled(h[a:b], b - a) + np.uint64(b - a)) for h in named)
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.uint64)))
            continue
        order = np.argsort(one)
        one, two = one[order], two[order]
        same = one[1:] == one[:-1]
        if same.any() and (two[1:] != two[:-1])[same].any():  # different shingles of one first hash
            order = np.lexsort((two, one))
            one, two = one[order], two[order]
            same = one[1:] == one[:-1]
        fresh = np.concatenate(([True], ~(same & (two[1:] == two[:-1]))))
        out.append((one[fresh], two[fresh]))
    return out


def _digest(one: np.ndarray, two: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(one.tobytes() + two.tobytes(), digest_size=16).digest()


def bitmap(one: np.ndarray) -> np.ndarray:
    """Four bits a shingle or more, hashed, as bytes; sizes are powers of two, so bitmaps fold."""
    bits = 1 << max(6, (4 * len(one)).bit_length())
    marks = np.zeros(bits, bool)
    marks[(one & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks)


class Bitmaps:
    """Bitmaps of different sizes, folded to the smaller one's bits where two are compared."""

    def __init__(self, maps: list[bytes]):
        self.maps, self.lengths, self.folded = maps, np.fromiter(map(len, maps), np.int64, len(maps)), {}

    def _at(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a matrix with ``length`` bytes each, and where each bitmap that is no smaller lies."""
        if length not in self.folded:
            rows = np.flatnonzero((self.lengths >= length) & (self.lengths <= 4 * length))
            place = np.full(len(self.maps), -1)
            place[rows] = np.arange(len(rows))
            matrix = [
                np.bitwise_or.reduce(np.frombuffer(self.maps[r], np.uint8).reshape(-1, length), axis=0) for r in rows.tolist()
            ]
            self.folded[length] = np.stack(matrix).view(np.uint64), place
        return self.folded[length]

    def overlaps(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """No fewer than the shingles that sets x and y have in common, pair by pair."""
        least, out = np.minimum(self.lengths[x], self.lengths[y]), np.zeros(len(x), np.int64)
        for length in np.unique(least).tolist():
            matrix, place = self._at(length)
            for k in np.array_split(np.flatnonzero(least == length), -(-len(x) * length // 16_000_000)):
                p, q = matrix[place[x[k]]], matrix[place[y[k]]]
                apart = [np.bitwise_count(u & ~v).sum(axis=1, dtype=np.int64) for u, v in ((p, q), (q, p))]
                out[k] = np.minimum(size[x[k]] - apart[0], size[y[k]] - apart[1])
        return out


@lru_cache(maxsize=4096)
def _ranges(alike: Alike, band: int) -> tuple[int, int]:
    return alike.ranges(band)


def keys(one: np.ndarray, alike: Alike) -> np.ndarray:
    """Keys of the set's tiles, in its own band and, if smaller sets may be alike, in the one below.

    They are the first strong ranges, one more than the set's differences. A set with fewer has
    all of them, and the first ranges besides that hold any shingle, by which it meets its
    like; if those are too few as well, its smallest shingles, of which alike sets share one.
    """
    n, out = len(one), []
    own = alike.band(n)
    bands = [own]
    if own and alike.top(own - 1) * 100 >= n * alike.percent:
        bands.append(own - 1)
    for band in bands:
        (count, strong), needed = _ranges(alike, band), alike.differences(n, band) + 1
        # The upper 32 bits times the count: the range, from 0 to count - 1, in the hashes' order.
        place = ((one >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        sums = np.add.reduceat(mix(one + np.uint64(0x632BE59BD9B4E019)), first)
        salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        held = mix(sums + mix(place[first] + salt))
        full = held[np.diff(np.append(first, n)) >= strong]
        out.append(full[:needed])
        if len(full) < needed:
            out.append(mix(held[:needed] + np.uint64(1)))
            if len(held) < needed:
                least = -(-n * alike.percent // 100)
                out.append(mix((one[: n - least + 1] ^ salt) + np.uint64(2)))
    return np.concatenate(out)


def _sets(df: DataFrame, alike: Alike) -> DataFrame:
    """Per row: size, digest and bitmap of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1, 1_000_000):
                sets = shingle_sets(some.column(1), alike.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([len(one) for one, _ in sets], pa.int64()),
                        pa.array([_digest(*both) for both in sets], pa.binary()),
                        pa.array([bitmap(one).tobytes() for one, _ in sets], pa.binary()),
                    ],
                    ["doc_id", "n", "digest", "bitmap"],
                )

    return df.mapInArrow(tidy(run), "doc_id long, n long, digest binary, bitmap binary")


def _tiles(df: DataFrame, alike: Alike, shingles: int) -> DataFrame:
    """key, id, hub of all members of tiles with two or more. ``shingles``: about how many there are in all."""

    def keyed(batches: Iterator[pa.RecordBatch], combined: Combiner) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1, 1_000_000):
                for (one, _), doc in zip(shingle_sets(some.column(1), alike.words), some.column(0).to_pylist(), strict=True):
                    if len(one):
                        yield from combined.add(found := keys(one, alike), np.full(len(found), doc, np.int64))

    return tiles(df, keyed, shingles // 2)


def _arrays(df: DataFrame, alike: Alike) -> DataFrame:
    """Per row: its whole sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1, 1_000_000):
                sets = shingle_sets(some.column(1), alike.words)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([one.tobytes() + two.tobytes() for one, two in sets], pa.binary())],
                    ["id", "shingles"],
                )

    return df.mapInArrow(tidy(run), "id long, shingles binary")


def overlap(x: bytes, y: bytes) -> tuple[int, int, int]:
    """Shingles that both sets have, and the sizes of both."""
    p, q = (np.frombuffer(z, np.uint64).reshape(2, -1) for z in (x, y))
    n, m = p.shape[1], q.shape[1]
    if not n or not m:
        return 0, n, m
    at = np.minimum(np.searchsorted(p[0], q[0]), n - 1)
    hit = p[0][at] == q[0]
    both = int(np.count_nonzero(hit & (p[1][at] == q[1])))
    if (p[0][1:] == p[0][:-1]).any() or (q[0][1:] == q[0][:-1]).any():  # a first hash that two shingles share
        both = len({*zip(*p.tolist(), strict=True)} & {*zip(*q.tolist(), strict=True)})
    return both, n, m


def _agree(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, sa, sb) whose sets are alike, by intersecting sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both, n, m = overlap(x, y)
                keep.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in (batch.column(0), batch.column(1))], ["a", "b"]
            )

    return pairs.mapInArrow(tidy(run), "a long, b long")


#: How a tile that isn't settled is dealt to tasks; each block of it lies in one.
_BLOCK = ("key", "low", "high")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (key, id, component_id, n) of unsettled tiles of three sets or more, with the blocks in which groups meet.

    Sets of the tile's largest group needn't meet each other. They are cut into parts, as are
    the others; each part of the others meets all parts, its own included. So a large group is
    copied as often as the others have parts, once mostly.
    """
    weight = F.sum(F.greatest("n", F.lit(WEIGHT // TILE)))
    groups = rows.groupBy("key", "component_id").agg(weight.alias("weight"), F.count("*").alias("rows"))
    found = groups.groupBy("key").agg(
        F.max(F.struct("weight", "component_id")).alias("main"), F.sum("weight").alias("weight"), F.sum("rows").alias("rows")
    )
    parts = lambda x: F.ceil(x / WEIGHT).cast("int")
    found = found.filter("main.weight < weight AND rows > 2").select(
        "key", F.col("main.component_id").alias("main"), parts(F.col("main.weight")).alias("mains"),
        parts(F.col("weight") - F.col("main.weight")).alias("others"), "rows",
    )
    found = written(found, "unsettled")
    hot = hot_of(found, "key", rows.count())
    dealt = salted(rows, hot, "key", "id").join(spread(found.drop("rows"), hot, "key"), ["key", "__salt"])
    in_main, others = F.col("component_id") == F.col("main"), F.col("others")
    # Parts of the others come first, those of the largest group after them.
    own = F.pmod(F.xxhash64("id"), F.when(in_main, F.col("mains")).otherwise(others)).cast("int")
    own = own + F.when(in_main, others).otherwise(0)
    last = others - 1 + F.when(in_main, 0).otherwise(F.col("mains"))
    dealt = dealt.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select(
        "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "component_id", "n"
    )


def _by_block(dealt: DataFrame, compare: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``compare`` over whole blocks, some at a time, by rising size."""
    dealt = dealt.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            held.append(batch)
            weight += int(np.maximum(batch.column("n").to_numpy(), WEIGHT // TILE).sum())
            if weight < 2 * WEIGHT:
                continue
            table = pa.Table.from_batches(held)
            last = np.all([(t := table.column(c).to_numpy()) == t[-1] for c in _BLOCK], axis=0)
            whole = int(np.argmax(last))
            if whole:
                yield compare(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
                weight = int(np.maximum(table.column("n").to_numpy()[whole:], WEIGHT // TILE).sum())
        if weight:
            yield compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(tidy(run), schema)


def _pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of a block that are of different groups and whose sizes let them be alike.

    In a block of two parts, sets of the same part met elsewhere.
    """
    block = [table.column(c).to_numpy() for c in _BLOCK]
    group = np.cumsum(np.concatenate(([0], np.any([t[1:] != t[:-1] for t in block], axis=0))))
    across, part, size = block[1] != block[2], table.column("part").to_numpy(), table.column("n").to_numpy()
    component, at = table.column("component_id").to_numpy(), np.arange(len(group))
    for step in range(1, len(group)):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        # Sizes rise within a block: beyond the first that is too large, all are.
        at = at[100 * size[at] >= percent * size[at + step]]
        if not len(at):
            break
        keep = (component[at] != component[at + step]) & (~across[at] | (part[at] != part[at + step]))
        yield at[keep], at[keep] + step


#: What a step hands to the next one of each set that passed.
_PASSED = "key long, low int, high int, part int, id long, component_id long, n long"


def _near(table: pa.Table, maps: Bitmaps, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those of _pairs() whose bitmaps let them be alike."""
    size = table.column("n").to_numpy()
    for x, y in _pairs(table, percent):
        both = maps.overlaps(x, y, size)
        alike = 100 * both >= percent * (size[x] + size[y] - both)
        if alike.any():
            yield x[alike], y[alike]


def _passing(table: pa.Table, percent: int) -> pa.RecordBatch:
    """The rows that bitmaps let be alike with another one of their block; no more rows than come in."""
    passed = np.zeros(len(table), bool)
    for x, y in _near(table, Bitmaps(table.column("bitmap").to_pylist()), percent):
        passed[x] = passed[y] = True
    names = [c.split()[0] for c in _PASSED.split(", ")]
    kept = table.select(names).filter(pa.array(passed))
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in kept.columns], names)


def _joining(table: pa.Table, percent: int) -> pa.RecordBatch:
    """Pairs (a, b) of alike sets that join groups: none between groups that others of the block have joined."""
    ids, component = table.column("id").to_numpy(), table.column("component_id").to_numpy()
    sets, root, a, b = table.column("shingles").to_pylist(), {}, [], []
    maps = Bitmaps([bitmap(np.frombuffer(x, np.uint64)[: len(x) // 16]).tobytes() for x in sets])

    def find(x: int) -> int:
        while (above := root.get(x, x)) != x:
            root[x] = x = root.get(above, above)
        return x

    for x, y in _near(table, maps, percent):
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            p, q = find(int(component[i])), find(int(component[j]))
            if p != q:
                both, n, m = overlap(sets[i], sets[j])
                if 100 * both >= percent * (n + m - both):
                    root[max(p, q)] = min(p, q)
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


class JaccardJoin:
    """All links between rows of ``df``, and the groups that they make.

    Null and empty texts have an empty set, linked with nothing. Equal sets are one class,
    however many rows have it; very long texts are taken whole, one at a time. Rows that repeat
    an id, and rows with a null id, are rows of their own; a null id is larger than any other.
    Further columns of ``df`` aren't read, whatever their names; an empty table gives no rows.
    Shingles are told apart by 128 bits of hashes.
    """

    def __init__(self, df: DataFrame, alike: Alike = Alike(), *, id_column: str = "doc_id", text_column: str = "text"):
        self.alike = alike
        docs, self.names = with_own_ids(df, id_column, text_column)
        self.docs = docs.withColumnRenamed("doc", "doc_id")

    def groups(self) -> DataFrame:
        """doc_id, n_shingles, class_id, component_id of every row.

        class_id is the smallest id with an equal set; component_id the smallest that
        links reach. Rows with empty sets stand alone.
        """
        sets = written(_sets(self.docs, self.alike), "sets")
        full = sets.filter("n > 0")
        classes = written(full.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows")), "classes")
        several = classes.filter("rows > 1").select("digest", "class_id")
        heads = full.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n", "bitmap")
        copies = full.select("doc_id").join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_anti")
        labels = self._labels(Sieve(written(copies, "copies")).others(self.docs, "doc_id"), written(heads, "heads"))
        named = several.join(labels, F.col("class_id") == F.col("id"), "left").select(
            "digest", "class_id", F.coalesce("component_id", "class_id").alias("class_component")
        )
        hot = hot_keys(full, "digest")
        found = salted(full.select("doc_id", "n", "digest"), hot, "digest", "doc_id").join(
            spread(written(named, "named"), hot, "digest"), ["digest", "__salt"], "left"
        )
        found = found.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("class_component", "component_id", "doc_id").alias("component_id"),
        )
        alone = sets.filter("n = 0").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")
        )
        grouped = found.unionByName(alone)
        for column in ("doc_id", "class_id", "component_id") if self.names is not None else ():
            named = self.names.select(F.col("doc").alias(column), F.col("name").alias("own"))
            grouped = grouped.join(named, column).drop(column).withColumnRenamed("own", column)
        return grouped.select("doc_id", "n_shingles", "class_id", "component_id")

    def _labels(self, docs: DataFrame, heads: DataFrame) -> DataFrame:
        """id, component_id of the classes' first rows ``docs`` that have links."""
        percent = self.alike.percent
        shingles = heads.agg(F.sum("n")).first()[0] or 0
        shared = written(_tiles(docs, self.alike, shingles), "tiles")
        wide = heads.withColumnRenamed("doc_id", "id").join(shared.select("id").distinct(), "id", "left_semi")
        wide = written(wide, "bitmaps")
        stars = shared.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
        first = self._verified(written(stars, "stars"), wide)
        known = components(first)
        members = shared.select("key", "id").join(wide.select("id", "n"), "id").join(known, "id", "left")
        members = written(members.withColumn("component_id", F.coalesce("component_id", "id")), "members")
        open_rows = written(_blocks(members), "open")
        passing = _by_block(open_rows.join(wide.select("id", "bitmap"), "id"), lambda t: _passing(t, percent), _PASSED)
        passing = written(passing, "passing")
        arrays = self._arrays_of(passing.select("id"))
        second = _by_block(passing.join(arrays, "id"), lambda t: _joining(t, percent), "a long, b long").distinct()
        return written(components(first.unionByName(written(second, "links"))), "labels")

    def _arrays_of(self, ids: DataFrame) -> DataFrame:
        ids = written(ids.distinct().select(F.col("id").alias("doc_id")), "ids")
        return written(_arrays(Sieve(ids).held(self.docs, "doc_id"), self.alike), "arrays")

    def _verified(self, pairs: DataFrame, wide: DataFrame) -> DataFrame:
        """The pairs (a, b), of a hub and a member, that are alike: by bitmaps, then by whole sets."""
        pairs = written(self._bounded(pairs, wide), "pairs")
        arrays = self._arrays_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
        hot = hot_keys(pairs, "a")
        hubs = arrays.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
        hubs = spread(hubs.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), hot, "a")
        both = salted(pairs, hot, "a", "b").join(arrays.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        both = both.join(hubs, ["a", "__salt"])
        return written(_agree(both.select("a", "b", "sa", "sb"), self.alike.percent), "links")

    def _bounded(self, pairs: DataFrame, wide: DataFrame) -> DataFrame:
        """Pairs whose sizes and bitmaps let them be alike."""
        percent, hot = self.alike.percent, hot_keys(pairs, "a")
        hubs = wide.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
        hubs = spread(hubs.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma")), hot, "a")
        other = wide.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb"))
        both = salted(pairs, hot, "a", "b").join(other, "b").join(hubs, ["a", "__salt"])
        sized = both.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size = np.concatenate([batch.column(k).to_numpy() for k in (2, 3)])
                x = np.arange(batch.num_rows)
                y = x + batch.num_rows
                maps = Bitmaps(batch.column(4).to_pylist() + batch.column(5).to_pylist())
                overlaps = maps.overlaps(x, y, size)
                keep = pa.array(100 * overlaps >= percent * (size[x] + size[y] - overlaps))
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["a", "b"])

        return sized.select("a", "b", "na", "nb", "ma", "mb").mapInArrow(tidy(run), "a long, b long")


def without_near_copies(df: DataFrame, alike: Alike = Alike(), *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df``, one of each group: that with the smallest id. Empty texts stay.

    Rows that share an id stay or go together; they stay if one of them does. All columns come
    along, whatever their names.
    """
    groups = JaccardJoin(df, alike, id_column=id_column, text_column=text_column).groups()
    judged = groups.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays"))
    return Sieve(written(judged.filter("NOT stays").select("doc_id"), "gone")).others(df, id_column)
