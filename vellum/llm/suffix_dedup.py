"""Removal of repeated byte strings over a whole corpus.

A byte goes if some string of ``length`` bytes that covers it also starts earlier. Each
window of that length is named by an anchor, the window's k-gram with the smallest hash,
so equal windows have equal anchors and meet under the anchor's hash. Runs of windows with
one anchor are fragments. Only three kinds of fragments matter:

* alone under their anchor: nothing is repeated;
* equal to an earlier fragment: all their windows are repeated, since the repeated interval is
  longer than a fragment;
* others that share an anchor: they are cut into slices by blocks aligned with the anchor,
  and slices whose core occurs again go to tasks that merge Burrows-Wheeler transforms and
  read repeated windows off the intervals.

A core that very many texts share with different surroundings would make a large task. Its
slices are halved, so that their cores take in bytes of the surroundings, and meet again under
those, until no core is shared by more than a task takes. All of them end in a transform, or
alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.bwt import merged
from vellum.llm.rolling import OTHER, mix, powers, prefix_sums, substring_hashes
from vellum.llm.shared import Sieve, hot_of, salted, spread, tidy, with_own_ids, written
from vellum.llm.tiles import Combiner, tiles

#: A k-gram's bytes; aligned blocks and how many of them every window holds.
GRAM, BLOCK = 24, 25
#: Bytes of a text that are taken at once, and of slices that are transformed together.
CHUNK, BATCH = 400_000, 200_000
#: Different slices under one core that a transform takes.
MOST = 4096
#: The bits of a fragment's place that hold its anchor's distance and its windows, half each.
SHAPE = 32


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(keys)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = keys
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def fragments(data: np.ndarray, bounds: np.ndarray, length: int):
    """Of texts that lie one after the other: anchor hash, content hashes (64 and 31 bits), start, windows, anchor's distance."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    sums = prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    # The same as substring_hashes() up to the length, which is the same for all.
    hashes = mix((sums[GRAM:] - sums[:-GRAM]) * powers(len(sums))[1][: len(at)])
    # Equal hashes: the later k-gram, whose place counts downwards in the lower bits.
    keys = (hashes & ~np.uint64(0xFFFFFF)) | (np.uint64(0xFFFFFF) - at.astype(np.uint64))
    least = _sliding_least(keys, length - GRAM + 1)
    anchor = (np.uint64(0xFFFFFF) - (least & np.uint64(0xFFFFFF))).astype(np.int64)
    text = np.repeat(np.arange(len(bounds)), np.diff(bounds, prepend=0))[: len(anchor)]
    inside = np.arange(length, len(anchor) + length) <= bounds[text]
    change = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])))
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(anchor)))
    first, count = first[inside[first]], count[inside[first]]
    place = anchor[first]
    ends = first + count + length - 1
    content = mix(substring_hashes(sums, first, ends) + (place - first).astype(np.uint64))
    check = (substring_hashes(prefix_sums(data, OTHER), first, ends) >> np.uint64(33)).astype(np.int64)
    return hashes[place], content, check, first, count, place - first


def _chunks(batch: pa.RecordBatch, length: int):
    """Rows' indices, their bytes one after the other, bounds, and where each part starts in its text.

    A text beyond CHUNK comes in parts that overlap so that each window lies in one.
    """
    texts = batch.column(1)
    rows, parts, begins, held = [], [], [], 0
    for row in range(batch.num_rows):
        raw = texts[row].as_buffer()
        raw = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        for begin in range(0, max(len(raw) - length + 1, 1), CHUNK):
            part = raw[begin : begin + CHUNK + length - 1]
            if held and held + len(part) > CHUNK:
                yield rows, np.concatenate(parts), np.cumsum([len(p) for p in parts]), begins
                rows, parts, begins, held = [], [], [], 0
            rows.append(row)
            parts.append(part)
            begins.append(begin)
            held += len(part)
    if rows:
        yield rows, np.concatenate(parts), np.cumsum([len(p) for p in parts]), begins


def _fragments(docs: DataFrame, length: int) -> DataFrame:
    """key, content, check, doc, place (start, anchor's distance, windows) of fragments that share their anchor's hash."""
    half = SHAPE // 2

    def keyed(batches: Iterator[pa.RecordBatch], combined: Combiner) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for rows, data, bounds, begins in _chunks(batch, length):
                anchor, content, check, start, count, far = fragments(data, bounds, length)
                text = np.searchsorted(bounds, start, side="right")
                inner = start - np.concatenate(([0], bounds))[text] + np.array(begins, np.int64)[text]
                place = inner << SHAPE | far << half | count
                # Anchors are the smallest hashes around: mixed again they are spread evenly.
                yield from combined.add(mix(anchor), content.view(np.int64), check, doc[np.array(rows, np.int64)[text]], place)

    total = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # A fragment has about half as many windows as a window has k-grams.
    return tiles(docs, keyed, 2 * total // (length - GRAM + 1), columns=("content", "check", "doc", "place"), hub=False)


def _firsts(rows: DataFrame, by: list, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (key, doc, place, …): the earliest of each content, the others, and how many contents each key has.

    The first and the third are written; ``by`` tells contents of a key apart. Nothing gathers a
    key's rows in one task: contents are combined where they lie, then counted.
    """
    first = F.min(F.struct("doc", "place")).alias("first")
    firsts = written(rows.groupBy("key", *by).agg(first).select("key", *[c for c in by if isinstance(c, str)], "first.*"), name)
    again = rows.select("key", "doc", "place", *[c for c in ("windows",) if c in rows.columns])
    again = again.join(firsts.select("key", "doc", "place"), ["key", "doc", "place"], "left_anti")
    kinds = firsts.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    return firsts, again, written(kinds, f"{name}-keys")


def _shared(firsts: DataFrame, kinds: DataFrame) -> DataFrame:
    """``firsts`` of keys with several contents, and how many; hot keys are dealt among salts."""
    hot = hot_of(kinds, "key", firsts.count())
    met = salted(firsts, hot, "key", "place").join(spread(kinds, hot, "key"), ["key", "__salt"])
    return met.drop("__salt")


#: What a slice is beside its text's number, its start and its windows: bytes, and where its windows lie around the block.
_SLICE = ["body", "lead", "low", "high"]


def _slices(docs: DataFrame, open_fragments: DataFrame, length: int) -> DataFrame:
    """Open fragments (doc, place) cut into slices: key, doc, place (the start), windows and _SLICE.

    A slice's windows begin from ``lead`` bytes before an aligned block on, and all of its key's
    from ``high`` to ``low`` bytes before it. Equal windows begin equally far before their block.
    """
    by_text = written(open_fragments.groupBy("doc").agg(F.collect_list("place").alias("places")), "places")
    core, half = length - BLOCK, SHAPE // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc", "place", "windows", *_SLICE]
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column(1)[row].as_buffer()
                data = np.frombuffer(raw, np.uint8)
                place = np.sort(batch.column(2)[row].values.to_numpy(zero_copy_only=False))
                start, far, count = place >> SHAPE, (place >> half) & ((1 << half) - 1), place & ((1 << half) - 1)
                top, low = far // BLOCK, (far - count + 1) // BLOCK
                n = top - low + 1
                of = np.repeat(np.arange(len(n)), n)
                step = np.repeat(low, n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                anchor = (start + far)[of]
                at = anchor - BLOCK * step
                first = np.maximum(start[of], at - BLOCK + 1)
                end = np.minimum((start + count)[of], at + 1)
                for a in range(0, len(of), 50_000):
                    some = slice(a, a + 50_000)
                    f, e, c, g = first[some], end[some] + length - 1, at[some], anchor[some]
                    base = int(min(f.min(), g.min()))
                    sums = prefix_sums(data[base : int(max(e.max(), (g + GRAM).max()))])
                    key = mix(substring_hashes(sums, g - base, g - base + GRAM) + step[some].astype(np.uint64))
                    key = mix(key ^ substring_hashes(sums, c - base, c - base + core))
                    # One copy of the texts' bytes for all bodies.
                    sizes = e - f
                    bounds = np.concatenate(([0], np.cumsum(sizes)))
                    bodies = data[np.repeat(f - bounds[:-1], sizes) + np.arange(int(bounds[-1]))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            batch.column(0).take(pa.array(np.full(len(f), row))),
                            pa.array(f),
                            pa.array(sizes - length + 1),
                            pa.BinaryArray.from_buffers(
                                pa.binary(), len(f), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(bodies)]
                            ),
                            pa.array((c - f).astype(np.int32)),
                            pa.array(np.zeros(len(f), np.int32)),
                            pa.array(np.full(len(f), BLOCK - 1, np.int32)),
                        ],
                        names,
                    )

    some = Sieve(by_text.select("doc")).perhaps(docs, "doc")
    joined = some.join(by_text, "doc").select("doc", "body", "places")
    return joined.mapInArrow(tidy(run), "key long, doc long, place long, windows long, body binary, lead int, low int, high int")


def _halves(slices: DataFrame, length: int) -> DataFrame:
    """Slices cut in two by where their windows begin, each part under the bytes that all windows there hold."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    windows = F.octet_length("body") - (length - 1)

    def part(low: Column, high: Column) -> Column:
        far, near = F.least("lead", high), F.greatest(F.col("lead") - windows + 1, low)
        skipped, count = F.col("lead") - far, far - near + 1
        body = F.substring("body", skipped + 1, count + (length - 1))
        # From the last window's begin to the first one's end, whatever part of them a slice has.
        core = F.substring(body, far - low + 1, F.lit(length) - (high - low))
        return F.struct(
            F.xxhash64("key", low, core).alias("key"), (F.col("place") + skipped).alias("place"), count.cast("long").alias("windows"),
            body.alias("body"), far.alias("lead"), low.alias("low"), high.alias("high"),
        )

    cut = slices.select("doc", F.explode(F.array(part(middle + 1, F.col("high")), part(F.col("low"), middle))).alias("x"))
    return cut.select("x.key", "doc", "x.place", "x.windows", *[f"x.{c}" for c in _SLICE]).filter("windows > 0")


def _around(body: bytes, lead: int, low: int, width: int, length: int) -> tuple[bytes, np.ndarray]:
    """The bytes that all windows of the slice hold, and the slice as characters with one mark in their place.

    Windows of ``length`` bytes are equal just if those bytes are and their ``width + 1`` characters
    around the mark: what is the same everywhere needn't be sorted.
    """
    first, last = lead - low, lead - low + length - width
    data = np.frombuffer(body, np.uint8).astype(np.uint16) + 1
    return body[first:last], np.concatenate((data[:first], MARK, data[last:]))


MARK = np.array([257], np.uint16)


def repeated_windows(slices: list[tuple[int, int, bytes, int, int, int]], length: int) -> list[tuple[int, int, int]]:
    """doc, start, end of windows of slices (doc, place, body, lead, low, high) that an earlier slice has, as runs.

    Their transforms are merged, and windows that share an interval and the bytes around their
    mark are the same; all but the earliest are returned.
    """
    out = []
    for width in sorted({high - low for *_, low, high in slices}):
        some = [x for x in slices if x[5] - x[4] == width]
        docs, places = (np.array([x[k] for x in some], np.int64) for k in (0, 1))
        cores, texts, known = [], [], {}
        for _, _, body, lead, low, _ in some:
            core, text = _around(body, lead, low, width, length)
            cores.append(known.setdefault(core, len(known)))
            texts.append(text)
        core = np.array(cores)
        sizes = np.array([len(t) + 1 for t in texts])
        ends = np.cumsum(sizes)
        order, interval = merged(texts, width + 1)
        item = np.searchsorted(ends, order, side="right")
        offset = order - (ends - sizes)[item]
        full = offset + width + 1 < sizes[item]
        item, offset, interval = item[full], offset[full], interval[full]
        by = np.lexsort((places[item] + offset, docs[item], core[item], interval))
        item, offset, interval = item[by], offset[by], interval[by]
        again = np.concatenate(([False], (interval[1:] == interval[:-1]) & (core[item[1:]] == core[item[:-1]])))
        item, offset = item[again], offset[again]
        by = np.lexsort((offset, item))
        item, offset = item[by], offset[by]
        if len(item):
            first = np.flatnonzero(np.concatenate(([True], (item[1:] != item[:-1]) | (offset[1:] != offset[:-1] + 1))))
            last = np.append(first[1:], len(item)) - 1
            begin, end = places[item[first]] + offset[first], places[item[last]] + offset[last] + length
            out += zip(docs[item[first]].tolist(), begin.tolist(), end.tolist(), strict=True)
    return out


def _covers_by_transform(slices: DataFrame, length: int) -> DataFrame:
    """doc, start, end of windows that occur earlier, from merged transforms of bounded batches of whole keys."""
    dealt = slices.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def out() -> pa.RecordBatch:
            found = list(zip(*repeated_windows(held, length), strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["doc", "start", "end"])

        for batch in batches:
            for key, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= BATCH and key != last:
                    yield out()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
                last = key
        if held:
            yield out()

    return dealt.select("key", "doc", "place", *_SLICE).mapInArrow(tidy(run), "doc long, start long, end long")


def removed_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc, start, end (bytes), by (how it was found) of strings that also start earlier; spans may overlap."""
    found = written(_fragments(docs, length), "fragments")
    shape = F.col("place").bitwiseAND((1 << SHAPE) - 1)
    firsts, again, kinds = _firsts(found, ["content", "check", shape], "first-fragments")
    start, windows = F.shiftright("place", SHAPE), F.col("place").bitwiseAND((1 << SHAPE // 2) - 1)
    spans = again.select("doc", start.alias("start"), (start + windows + (length - 1)).alias("end"), F.lit("fragment").alias("by"))
    rows = written(_slices(docs, _shared(firsts, kinds).select("doc", "place"), length), "slices")
    few = None
    while True:
        # Bodies themselves are compared, not hashes of them.
        firsts, again, kinds = _firsts(rows, _SLICE, "first-slices")
        end = F.col("place") + F.col("windows") + (length - 1)
        spans = spans.unionByName(again.select("doc", F.col("place").alias("start"), end.alias("end"), F.lit("slice").alias("by")))
        met = written(_shared(firsts, kinds), "met-slices")
        some = met.filter(F.col("rows") <= MOST).select("key", "doc", "place", *_SLICE)
        few = some if few is None else few.unionByName(some)
        many = met.filter(F.col("rows") > MOST)
        if not many.limit(1).count():
            break
        rows = written(_halves(many, length), "halves")
    read = _covers_by_transform(few, length).withColumn("by", F.lit("interval"))
    return spans.unionByName(read)


def suffix_dedup(
    df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length: int = 100
) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans of every row of ``df``.

    Texts are their UTF-8 bytes; null texts are empty. A string is judged on the input,
    whatever else is removed; strings never cross texts. Earlier is: in a text with a
    smaller id, or at an earlier start in the same text. Rows with a null id come last;
    rows that repeat an id come in the order of their texts. Texts shorter than ``length``
    lose nothing; very long ones are taken in parts that overlap. Further columns aren't read,
    whatever their names; an empty table gives no rows. ``length`` may be from 50 to 10,000.
    """
    if not 2 * BLOCK <= length <= 10_000:
        raise ValueError(f"length must be from {2 * BLOCK} to 10000")
    docs, names = with_own_ids(df, id_column, text_column)
    docs = docs.withColumn("body", F.col("body").cast("binary"))
    spans = written(removed_spans(docs, length), "spans")
    by_text = written(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans-of-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for row in range(batch.num_rows):
                raw = batch.column(1)[row].as_buffer()
                body = raw.to_pybytes() if raw is not None else b""
                cuts = batch.column(2)[row].values
                parts, at, gone, runs, upto = [], 0, 0, 0, -1
                if cuts is not None and len(cuts):
                    starts, ends = cuts.field(0).to_numpy(), cuts.field(1).to_numpy()
                    by = np.argsort(starts, kind="stable")
                    for a, b in zip(starts[by].tolist(), ends[by].tolist(), strict=True):
                        if a > upto:
                            parts.append(body[at:a])
                            runs += 1
                            gone += b - a
                            at = upto = b
                        elif b > upto:
                            gone += b - upto
                            at = upto = b
                parts.append(body[at:])
                kept.append(b"".join(parts))
                n_bytes.append(len(body))
                n_removed.append(gone)
                n_spans.append(runs)
            counts = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), *counts], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
            )

    # Texts that lose nothing stay where they are.
    sieve = Sieve(by_text.select("doc"))
    none = F.array().cast(by_text.schema["spans"].dataType)
    cut = sieve.held(docs, "doc").join(by_text, "doc").select("doc", "body", "spans")
    joined = cut.unionByName(sieve.others(docs, "doc").withColumn("spans", none))
    done = joined.mapInArrow(tidy(run), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
    if names is None:
        return done
    named = done.join(names, F.col("doc_id") == F.col("doc"))
    return named.select(F.col("name").alias("doc_id"), "kept", "n_bytes", "n_removed", "n_spans")
