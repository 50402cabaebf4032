"""Lines that are equal or within a few edits of each other, over a whole corpus.

Lines are cut into one segment more than the edits allowed, so two lines within the edits
share a segment, nearly in place. Each line offers its segments under (length, segment,
content) and looks there for shorter and equally long lines with the few substrings that
edits on either side can have shifted into place. Candidates must agree in counts of
characters, and are then verified by a banded bit-parallel edit distance: the band is one
machine word that moves along the diagonal, for many pairs at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.components import components
from vellum.llm.linear import text_slices
from vellum.llm.rolling import mix, prefix_sums, substring_hashes
from vellum.llm.shared import SPACES, Sieve, hot_of, salted, spread, tidy, with_own_ids, written
from vellum.llm.tiles import Combiner, tiles

#: Lines of one tile that are compared in one task.
TILE = 512
#: Classes of characters that are counted.
COUNTS = 16
STRIP = "".join(SPACES)


@dataclass(frozen=True)
class Near:
    """Lines are near within ``edits``; lines of fewer than ``least`` code points only if equal.

    ``short`` allows shorter lines fewer edits: (length, edits) for pairs whose shorter line
    has fewer than ``least`` code points and at least that length.
    """

    edits: int = 2
    least: int = 20
    short: tuple[tuple[int, int], ...] = ()

    def tiers(self) -> list[tuple[int, int, int | None]]:
        """(least length, edits, least length of the next tier) of the shorter line of a pair."""
        steps = [*sorted(self.short), (self.least, self.edits)]
        return [(a, edits, following) for (a, edits), following in zip(steps, [a for a, _ in steps[1:]] + [None])]

    def shortest(self) -> int:
        return self.tiers()[0][0]

    def allowed(self, lengths: np.ndarray) -> np.ndarray:
        """The edits for pairs whose shorter lines have these lengths; -1: none, not even if equal."""
        out = np.full(len(lengths), -1, np.int64)
        for a, edits, _ in self.tiers():
            out[lengths >= a] = edits
        return out

    def segments(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the edits + 1 segments of lines of these lengths, one row a line."""
        parts = self.edits + 1
        base, longer = lengths // parts, lengths % parts
        sizes = base[:, None] + (np.arange(parts) >= parts - longer[:, None])
        return np.cumsum(sizes, axis=1) - sizes, sizes

    def probes(self) -> list[tuple[int, int, int]]:
        """(letters more than the other line, segment, shift against its start) that can match."""
        out = []
        for more in range(self.edits + 1):
            for i in range(self.edits + 1):
                low = max(-i, more - (self.edits - i))
                high = min(i, more + (self.edits - i))
                out += [(more, i, shift) for shift in range(low, high + 1)]
        return out


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate(([0], np.cumsum(lengths)))


def names(lines: list[str]) -> np.ndarray:
    """63-bit names of lines, in the upper bits. Lines that share one are told apart later."""
    points, bounds = _points(lines)
    return substring_hashes(prefix_sums(points), bounds[:-1], bounds[1:]) & ~np.uint64(1)


def tile_keys(lines: list[str], near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the name of the line; the name's last bit is set where the line offers a segment."""
    lines = [x for x in lines if len(x) >= near.shortest()]
    if not lines:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    keys, members = [], []
    for least, edits, following in near.tiers():
        # The shorter line of a pair is of this tier; the longer one may reach into the next.
        some = [x for x in lines if len(x) >= least and (following is None or len(x) < following + edits)]
        if some:
            k, m = _tier_keys(some, Near(edits, least), following)
            keys.append(k)
            members.append(m)
    return np.concatenate(keys), np.concatenate(members)


def _tier_keys(lines: list[str], near: Near, following: int | None) -> tuple[np.ndarray, np.ndarray]:
    points, bounds = _points(lines)
    sums, first, lengths = prefix_sums(points), bounds[:-1], np.diff(bounds)
    named = substring_hashes(sums, bounds[:-1], bounds[1:]) & ~np.uint64(1)
    keys, members = [], []
    for more in range(near.edits + 1):
        other = lengths - more
        starts, sizes = near.segments(other)
        for _, i, shift in (p for p in near.probes() if p[0] == more):
            a = starts[:, i] + shift
            b = a + sizes[:, i]
            fits = (a >= 0) & (b <= lengths) & (other >= near.least)
            if following is not None:
                fits &= other < following
            a, b = (first + a)[fits], (first + b)[fits]
            place = (other[fits] * (near.edits + 1) + i).astype(np.uint64)
            keys.append(mix(substring_hashes(sums, a, b) ^ mix(place + np.uint64(0x51ED270B))))
            members.append(named[fits] | np.uint64(more == 0 and shift == 0))
    return np.concatenate(keys), np.concatenate(members)


def within(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Which pairs are within ``edits`` edits: Hyyrö's banded bit-vectors, all pairs at once.

    The band holds 2 * edits + 1 cells of a column and moves down a row each column, so one
    word is enough for lines of any length. vp and vn hold the band's vertical steps.
    """
    n = len(a)
    la, lb = np.fromiter(map(len, a), np.int64, n), np.fromiter(map(len, b), np.int64, n)
    out = np.zeros(n, bool)
    order = np.flatnonzero(np.abs(la - lb) <= edits)
    order = order[np.argsort(lb[order], kind="stable")]
    for k in range(0, len(order), 4096):
        some = order[k : k + 4096]
        out[some] = _within([a[i] for i in some], [b[i] for i in some], la[some], lb[some], edits)
    return out


def _within(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray, edits: int) -> np.ndarray:
    n, width = len(a), 2 * edits + 1
    pad = edits + 1
    rows = np.zeros((int(la.max(initial=0)) + 2 * pad + edits, n), np.uint32)
    columns = np.zeros((int(lb.max(initial=0)) + 1, n), np.uint32)
    for lines, sizes, into, at in ((a, la, rows, pad), (b, lb, columns, 0)):
        points, bounds = _points(lines)
        line = np.repeat(np.arange(n), sizes)
        # One more than the code point: 0 matches nothing.
        into[at + np.arange(len(points)) - bounds[:-1][line], line] = points + 1
    one = np.uint64(1)
    full, top = np.uint64((1 << width) - 1), np.uint64(width - 1)
    # Cell t of column j is row j - edits + t; rows before the first match nothing.
    # The steps are kept for the next column, whose cells lie a row further down.
    vp = np.full(n, ((1 << (edits + 1)) - 1) << edits & ((1 << width) - 1), np.uint64)
    vn = np.zeros(n, np.uint64)
    score = np.full(n, edits, np.int64)  # of the band's last cell, row j + edits
    final = np.full(n, np.iinfo(np.int64).max)
    final[lb == 0] = la[lb == 0]
    for j in range(1, int(lb.max(initial=0)) + 1):
        match = np.zeros(n, np.uint64)
        letter = columns[j - 1]
        for t in range(width):
            row = j - edits + t
            if row >= 1:
                at = pad + row - 1
                if at < len(rows):
                    match |= ((rows[at] == letter) & (letter > 0)).astype(np.uint64) << np.uint64(t)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        x = d0 >> one
        score += 1 - ((d0 >> top) & one).astype(np.int64)
        vp = (hn | ~(x | hp)) & full
        vn = (x & hp) & full
        if (ended := lb == j).any():
            # From the band's last cell up to row la of this column.
            back = j + edits - la
            value = score.copy()
            for step in range(width - 1):
                bit = np.uint64(width - 2 - step)
                going = back > step
                value -= np.where(going, ((vp >> bit) & one).astype(np.int64) - ((vn >> bit) & one).astype(np.int64), 0)
            final[ended] = value[ended]
    return final <= edits


def _lines(texts: list[str | None]) -> list[str]:
    """The texts' distinct lines, without white space around them, and without empty ones."""
    return list(dict.fromkeys(x for t in texts for line in (t or "").split("\n") if (x := line.strip(STRIP))))


def _tiles(docs: DataFrame, near: Near, characters: int) -> DataFrame:
    """key, id, hub of the segments and probes of all lines that two lines or more have."""

    def keyed(batches: Iterator[pa.RecordBatch], combined: Combiner) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(0), 2_000_000):
                keys, members = tile_keys(_lines(texts), near)
                for a in range(0, len(keys), 500_000):
                    yield from combined.add(keys[a : a + 500_000], members[a : a + 500_000].view(np.int64))

    # Some dozen segments and probes a line of some dozen characters: about a key a character.
    return tiles(docs.select("body"), keyed, characters // 2, flags=1)


def _facts(docs: DataFrame, needed: DataFrame, near: Near) -> DataFrame:
    """name, line_id, line, length and counts of characters of the needed lines."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_slices(batch.column(0), 2_000_000):
                lines = [x for x in _lines(texts) if len(x) >= near.shortest()]
                if lines:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names(lines).view(np.int64)), pa.array(lines, pa.string())], ["name", "line"]
                    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(1).to_pylist()
            points, bounds = _points(lines)
            lengths = np.diff(bounds)
            kind = (mix(points.astype(np.uint64)) % np.uint64(COUNTS)).astype(np.int64)
            counts = np.bincount(np.repeat(np.arange(len(lines)), lengths) * COUNTS + kind, minlength=len(lines) * COUNTS)
            counts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, COUNTS)
            counts = pa.array([c.tobytes() for c in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths), counts], ["name", "line", "length", "counts"])

    # Lines that meet no other aren't shuffled.
    found = Sieve(written(needed, "names")).held(docs.select("body").mapInArrow(tidy(named), "name long, line string"), "name").distinct()
    facts = found.mapInArrow(tidy(counted), "name long, line string, length long, counts binary")
    return facts.withColumn("line_id", F.unhex(F.md5("line")))


def _candidates(rows: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) of lines of one tile that lengths and counts of characters let be near; ``parts`` is the tile's."""
    part = F.pmod(F.xxhash64("line_id"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = rows.withColumn("part", part).withColumn("other", other)
    dealt = dealt.select(
        "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "line_id", F.col("member").bitwiseAND(1).alias("offers"), "length", "counts",
    )
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def compare(table: pa.Table) -> pa.RecordBatch:
        tile = [table.column(c).to_numpy() for c in ("key", "low", "high")]
        part, offers, length = (table.column(c).to_numpy() for c in ("part", "offers", "length"))
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8).reshape(-1, COUNTS).astype(np.int16)
        group = np.cumsum(np.concatenate(([0], np.any([t[1:] != t[:-1] for t in tile], axis=0))))
        across = tile[1] != tile[2]
        firsts, seconds, at = [], [], np.arange(len(group))
        for step in range(1, len(group)):
            at = at[at + step < len(group)]
            at = at[group[at] == group[at + step]]
            if not len(at):
                break
            a, b = at, at + step
            edits = near.allowed(np.minimum(length[a], length[b]))
            keep = (offers[a] + offers[b] > 0) & (np.abs(length[a] - length[b]) <= edits)
            keep &= ~across[a] | (part[a] != part[b])
            a, b, edits = a[keep], b[keep], edits[keep]
            keep = np.abs(counts[a] - counts[b]).sum(axis=1) <= 2 * edits
            firsts.append(a[keep])
            seconds.append(b[keep])
        ids = table.column("line_id")
        x, y = (ids.take(pa.array(np.concatenate(z) if z else np.zeros(0, np.int64))).to_pylist() for z in (firsts, seconds))
        pairs = {(min(p), max(p)) for p in zip(x, y, strict=True) if p[0] != p[1]}
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 20_000:
                continue
            table = pa.Table.from_batches(held)
            last = [table.column(c)[-1].as_py() for c in ("key", "low", "high")]
            tile = [table.column(c).to_numpy() for c in ("key", "low", "high")]
            whole = int(np.flatnonzero(~np.all([t == v for t, v in zip(tile, last, strict=True)], axis=0))[-1:].sum() + 1)
            if whole > 1:
                yield compare(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                size = len(table) - whole
        if size:
            yield compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(tidy(run), "a binary, b binary").distinct()


def line_links(docs: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) of ids of different lines of ``docs`` (doc, body) within the edits."""
    characters = docs.agg(F.sum(F.length("body"))).first()[0] or 0
    met = written(_tiles(docs, near, characters).select("key", F.col("id").alias("member")).distinct(), "members")
    # Lines that only look for others meet nobody without one that offers its segment.
    name = F.col("member").bitwiseAND(-2)
    kinds = met.groupBy("key").agg(
        F.min(name).alias("low"), F.max(name).alias("high"), F.max(F.col("member").bitwiseAND(1)).alias("offered"), F.count("*").alias("rows")
    )
    kinds = written(kinds.filter("low < high AND offered = 1").select("key", "rows"), "kinds")
    hot = hot_of(kinds, "key", met.count())
    shared = salted(met, hot, "key", "member").join(spread(kinds, hot, "key"), ["key", "__salt"])
    shared = written(shared.select("key", "member", name.alias("name"), F.ceil(F.col("rows") / TILE).cast("int").alias("parts")), "segments")
    facts = written(_facts(docs, shared.select("name").distinct(), near), "lines")
    rows = shared.join(facts.select("name", "line_id", "length", "counts"), "name")
    pairs = written(_candidates(rows, near), "pairs")
    text = facts.select("line_id", "line").distinct()
    both = pairs.join(text.select(F.col("line_id").alias("a"), F.col("line").alias("x")), "a")
    both = both.join(text.select(F.col("line_id").alias("b"), F.col("line").alias("y")), "b").select("a", "b", "x", "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            allowed = near.allowed(np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64))
            hit = np.zeros(len(x), bool)
            for edits in {e for _, e, _ in near.tiers()}:
                at = np.flatnonzero(allowed == edits)
                hit[at] = within([x[i] for i in at], [y[i] for i in at], edits)
            keep = pa.array(hit)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["a", "b"])

    return written(both.mapInArrow(tidy(verify), "a binary, b binary"), "links")


def line_dedup(
    df: DataFrame, near: Near = Near(), *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row a line: doc_id, line_no, line_id, component_id, n_links, n_copies, kept.

    Lines end at line feeds; white space around them is cut off, and empty ones are no
    lines. line_no counts all lines of the text from 0. line_id names the line's content,
    component_id the smallest content that links reach. n_links counts different lines
    within the edits, n_copies all lines of equal content. Of a component the first line
    by document and number is kept. Null and empty texts have no lines; very long texts and
    lines are taken whole. Rows that repeat an id, or have none, are documents of their own,
    null last. Further columns aren't read, whatever their names; an empty table gives no rows.
    """
    docs, own = with_own_ids(df, id_column, text_column)
    lines = docs.select("doc", F.posexplode(F.split("body", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(STRIP))).filter("line <> ''")
    lines = written(lines.select("doc", F.col("line_no").cast("long").alias("line_no"), F.unhex(F.md5("line")).alias("line_id")), "places")
    links = line_links(docs, near)
    groups = components(links).withColumnRenamed("id", "line_id")
    ends = links.select(F.col("a").alias("line_id")).unionByName(links.select(F.col("b").alias("line_id")))
    groups = groups.join(ends.groupBy("line_id").agg(F.count("*").alias("n_links")), "line_id")
    firsts = lines.groupBy("line_id").agg(F.min(F.struct("doc", "line_no")).alias("first"), F.count("*").alias("n_copies"))
    firsts = firsts.join(groups, "line_id", "left").filter("n_copies > 1 OR component_id IS NOT NULL")
    firsts = written(firsts.withColumn("component_id", F.coalesce("component_id", "line_id")), "firsts")
    best = firsts.groupBy("component_id").agg(F.min("first").alias("first"))
    known = firsts.drop("first").join(best, "component_id")
    hot = hot_of(firsts.select("line_id", F.col("n_copies").alias("rows")), "line_id", lines.count())
    lines = lines.withColumn("place", F.struct("doc", "line_no"))
    found = salted(lines, hot, "line_id", "place").join(spread(known, hot, "line_id"), ["line_id", "__salt"], "left")
    if own is None:
        found = found.withColumn("name", F.col("doc"))
    else:
        found = found.join(own, "doc")
    return found.select(
        F.col("name").alias("doc_id"),
        "line_no",
        F.lower(F.hex("line_id")).alias("line_id"),
        F.lower(F.hex(F.coalesce("component_id", "line_id"))).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce(F.struct("doc", "line_no") == F.col("first"), F.lit(True)).alias("kept"),
    )
