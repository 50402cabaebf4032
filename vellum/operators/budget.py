"""Chunks by a budget of tokens, counted by a real tokenizer that each worker loads once.

An item too long for its room is cut at the coarsest separators that make its parts fit: blank lines,
lines, sentences, clauses, words, tokens. Its tokens are counted once, by where they begin, so the
parts' sizes are differences of prefix counts and each piece's end is found by binary search. Pieces are
then put together in order, again by prefix counts, as many as fit. Counting and cutting is
done where the items lie; only the putting together goes by document, as a stream of batches
that holds one open chunk.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What tokens never reach across: a tokenizer is taken to cut at white space, so the sizes of words add up.
WORD, KNOWN = re.compile(r"[^\x20\x09-\x0D]+"), 500_000
#: Where to cut, best first; a separator stays at the end of the part before it.
SEPARATORS = (r"\n\s*\n", r"\n", r"(?<=[.!?…])\s+", r"(?<=[;:,])\s+", r"\s+")


@dataclass(frozen=True)
class Budget:
    """``tokens`` of a chunk with its headings. ``merge_peers``: neighbours with equal headings share a chunk.

    ``vocabulary``: a tokenizer's file, at the same place on every machine; without one, tokens are words between white space.
    """

    tokens: int = 512
    merge_peers: bool = True
    vocabulary: str | None = None


class Counter:
    def __init__(self, vocabulary: str | None):
        self.model, self.known = None, {}
        if vocabulary is not None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores out
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(vocabulary)
            self.model.no_truncation()
            self.model.no_padding()
            self.model.encode_special_tokens = True

    def _learn(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Where the tokens of words begin: each distinct one is looked at once, as long as KNOWN of them are kept."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if new and self.model is None:
            self.known.update((w, (0,)) for w in new)
        elif new:
            found = self.model.encode_batch(new, add_special_tokens=False)
            self.known.update((w, tuple(a for a, _ in e.offsets)) for w, e in zip(new, found, strict=True))
        return self.known

    def sizes(self, texts: list[str]) -> np.ndarray:
        split = [WORD.findall(t) for t in texts]
        known = self._learn({w for words in split for w in words})
        return np.array([sum(map(len, map(known.__getitem__, words))) for words in split], np.int64)

    def begins(self, text: str) -> np.ndarray:
        """Where each token begins, in code points."""
        found = [(m.start(), m.group()) for m in WORD.finditer(text)]
        known = self._learn({w for _, w in found})
        return np.array([at + a for at, w in found for a in known[w]], np.int64)


@lru_cache(maxsize=4)
def counter(vocabulary: str | None) -> Counter:
    """One a worker process."""
    return Counter(vocabulary)


def pieces(text: str, room: int, tool: Counter) -> list[str]:
    """``text`` in parts of at most ``room`` tokens, which make it up again when put in a row."""
    begins = tool.begins(text)
    size = lambda a, b: int(np.searchsorted(begins, b) - np.searchsorted(begins, a))
    # The bounds of parts that fit, each cut no finer than it has to be.
    todo, bounds = [(0, len(text), 0)], [0]
    while todo:
        a, b, level = todo.pop()
        if size(a, b) <= room or b - a == 1:
            bounds.append(b)
            continue
        if level < len(SEPARATORS):
            inner = [m.end() for m in re.compile(SEPARATORS[level]).finditer(text, a, b) if a < m.end() < b]
        else:
            inner = [int(x) for x in begins[np.searchsorted(begins, a, "right") : np.searchsorted(begins, b)] if a < x < b] or [(a + b) // 2]
        todo += reversed([(x, y, level + 1) for x, y in zip([a, *inner], [*inner, b], strict=True)])
    # As many neighbouring parts as fit: the last bound whose prefix count is within the room.
    ends, before, out = np.array(bounds), np.searchsorted(begins, bounds), []
    at = 0
    while at < len(ends) - 1:
        upto = max(at + 1, int(np.searchsorted(before, before[at] + room, "right")) - 1)
        out.append(text[ends[at] : ends[upto]])
        at = upto
    # Tokens can differ where a cut goes through what was one: what doesn't fit is cut again, with less room.
    fitting = []
    for part, over in zip(out, (tool.sizes(out) - room).tolist(), strict=True):
        if over <= 0 or len(part) == 1:
            fitting.append(part)
        elif len(out) > 1 and over < room:
            fitting += pieces(part, room - over, tool)
        else:
            half = len(part) // 2
            fitting += pieces(part[:half], room, tool) + pieces(part[half:], room, tool)
    return fitting


def sized(items: DataFrame, budget: Budget) -> DataFrame:
    """doc_id, pos, piece, path, head, size, text: items cut to fit, with their tokens and their headings'.

    items: doc_id, pos, path, text. Headings that leave no room are dropped. Items without a token give no row.
    """
    schema = StructType([*items.select("doc_id", "pos").schema, *StructType.fromDDL("piece int, path string, head long, size long, text string")])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(budget.vocabulary)
        for batch in batches:
            paths = [p or "" for p in batch.column(2).to_pylist()]
            distinct = list(dict.fromkeys(paths))
            heads = dict(zip(distinct, tool.sizes([p + "\n" if p else "" for p in distinct]).tolist(), strict=True))
            shown = [p if heads[p] < budget.tokens else "" for p in paths]
            texts = [t or "" for t in batch.column(3).to_pylist()]
            counts, of, found, sizes = tool.sizes(texts), [], [], []
            for k, text in enumerate(texts):
                room = budget.tokens - (heads[shown[k]] if shown[k] else 0)
                parts = [text] if counts[k] <= room else pieces(text, room, tool)
                of += [k] * len(parts)
                found += parts
                sizes += [counts[k]] if len(parts) == 1 else tool.sizes(parts).tolist()
            place = np.array(of, np.int64)
            number = np.arange(len(of)) - np.searchsorted(place, place)
            made = pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place)), batch.column(1).take(pa.array(place)), pa.array(number, pa.int32()),
                 pa.array([shown[k] for k in of], pa.string()), pa.array([heads[shown[k]] if shown[k] else 0 for k in of], pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(found, pa.string())],
                names,
            )
            yield made.filter(pa.array(np.array(sizes, np.int64) > 0))

    return items.select("doc_id", "pos", "path", "text").mapInArrow(run, schema)


def token_chunks(items: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """doc_id, seq, path, text, tokens, text_tokens, first_pos, last_pos: chunks in order, none above its budget.

    items: doc_id, pos, path (headings, null or empty: none), text. ``tokens`` counts the headings too, a line each before the
    text; they are left out where they alone fill the budget. Items of one chunk are joined by line feeds; the
    parts of an item too long for a chunk follow each other without anything lost. Null and empty texts are in no chunk; items
    with equal positions may come in either order. One token alone may exceed a budget that is smaller.
    """
    sort = ["doc_id", "pos", "piece"]
    dealt = sized(items, budget).repartition("doc_id").sortWithinPartitions(*sort)
    kind = items.schema["doc_id"].dataType.simpleString()
    place = items.schema["pos"].dataType.simpleString()

    def chunk(tool: Counter, rows: pa.Table) -> Iterator[dict]:
        """One chunk, or more where the tokens of joined items are more than those of the items."""
        piece, texts = rows.column("piece").to_pylist(), rows.column("text").to_pylist()
        path = rows.column("path")[0].as_py()
        text = "".join(("\n" if k and not piece[k] else "") + t for k, t in enumerate(texts))
        # Parts of one item may meet within a word; else sizes add up.
        alone = int(tool.sizes([text])[0]) if any(piece[1:]) else sum(rows.column("size").to_pylist())
        tokens = alone + rows.column("head")[0].as_py()
        if tokens > budget.tokens and len(rows) > 1:
            half = len(rows) // 2
            yield from chunk(tool, rows.slice(0, half))
            yield from chunk(tool, rows.slice(half))
            return
        pos = rows.column("pos")
        yield {"doc_id": rows.column("doc_id")[0].as_py(), "path": path, "text": text, "tokens": tokens, "text_tokens": alone,
               "first_pos": pos[0].as_py(), "last_pos": pos[-1].as_py()}

    names = ["doc_id", "seq", "path", "text", "tokens", "text_tokens", "first_pos", "last_pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(budget.vocabulary)
        held: pa.Table | None = None
        last: list = [None, 0]  # the document in progress, and its next number

        def emitted(done: list[dict]) -> pa.RecordBatch:
            for row in done:
                last[:] = [row["doc_id"], last[1] if row["doc_id"] == last[0] else 0]
                row["seq"] = last[1]
                last[1] += 1
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in done], arrow.get(n, pa.int64())) for n in names], names)

        arrow: dict = {"path": pa.string(), "text": pa.string()}
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            arrow |= {"doc_id": table.schema.field("doc_id").type} | {n: table.schema.field("pos").type for n in ("first_pos", "last_pos")}
            doc, path = table.column("doc_id").to_pylist(), table.column("path").to_pylist()
            fresh = np.array([k == 0 or doc[k] != doc[k - 1] or path[k] != path[k - 1] for k in range(len(doc))])
            if not budget.merge_peers:
                fresh |= np.ones(len(doc), bool)
            ends = np.append(np.flatnonzero(fresh)[1:], len(doc))
            end_of = ends[np.cumsum(fresh) - 1]
            before = np.concatenate(([0], np.cumsum(table.column("size").to_numpy())))
            head, at, done = table.column("head").to_numpy(), 0, []
            while at < len(doc):
                room = budget.tokens - head[at]
                upto = min(int(end_of[at]), max(at + 1, int(np.searchsorted(before, before[at] + room, "right")) - 1))
                if upto == len(doc):
                    break
                done += chunk(tool, table.slice(at, upto - at))
                at = upto
            held = table.slice(at).combine_chunks()
            if done:
                yield emitted(done)
        if held is not None and len(held):
            yield emitted(list(chunk(tool, held)))

    return dealt.mapInArrow(run, f"doc_id {kind}, seq long, path string, text string, tokens long, text_tokens long, first_pos {place}, last_pos {place}")


def line_windows(chunks: DataFrame, budget: Budget, least: int = 300) -> DataFrame:
    """chunk_id, part, text, tokens: chunks of code above the budget cut between lines; parts below ``least`` tokens are left out.

    chunks: chunk_id, text. Others stay whole, as part 0; parts count from 1. A line above the budget is a part of its own.
    """
    names = ["chunk_id", "part", "text", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(budget.vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            of, part, found, sizes = [], [], [], []
            for k, (text, whole) in enumerate(zip(texts, tool.sizes(texts).tolist(), strict=True)):
                made = [(0, text, whole)]
                if whole > budget.tokens:
                    lines = text.split("\n")
                    before = np.concatenate(([0], np.cumsum(tool.sizes(lines))))
                    parts, at = [], 0
                    while at < len(lines):
                        upto = max(at + 1, int(np.searchsorted(before, before[at] + budget.tokens, "right")) - 1)
                        parts.append("\n".join(lines[at:upto]))
                        at = upto
                    kept = [(t, n) for t, n in zip(parts, tool.sizes(parts).tolist(), strict=True) if n >= least]
                    made = [(j, t, n) for j, (t, n) in enumerate(kept, 1)]
                of += [k] * len(made)
                for column, values in zip((part, found, sizes), zip(*made), strict=False):
                    column += values
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), pa.array(part, pa.int32()), pa.array(found, pa.string()), pa.array(sizes, pa.int64())], names
            )

    kind = chunks.schema["chunk_id"].dataType.simpleString()
    return chunks.select("chunk_id", "text").mapInArrow(run, f"chunk_id {kind}, part int, text string, tokens long")


def judged(chunks: DataFrame, budget: Budget) -> DataFrame:
    """doc_id, text, within, tight: the chunks' texts in a row, whether none is above the budget, and whether no two neighbours fit into one."""
    each = F.sort_array(F.collect_list(F.struct("seq", "path", "text", "tokens", "text_tokens")))
    held = chunks.groupBy("doc_id").agg(each.alias("all"), F.max("tokens").alias("most"))
    pairs = F.zip_with(F.slice("all", F.lit(1), F.size("all") - 1), F.slice("all", F.lit(2), F.size("all")),
                       lambda a, b: (a["path"] == b["path"]) & (a["tokens"] + b["text_tokens"] <= budget.tokens))
    text = F.array_join(F.transform("all", lambda x: x["text"]), "")
    return held.select("doc_id", text.alias("text"), (F.col("most") <= budget.tokens).alias("within"), (~F.exists(pairs, lambda x: x)).alias("tight"))
