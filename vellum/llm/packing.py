"""Packing examples into training sequences by vector bin packing.

Every example is a vector: its tokens, its segments and its loss-bearing tokens.
A sequence is a bin with a limit in each of these dimensions. Within a block of
examples the open bin takes, again and again, the fitting example whose demand has
the largest weighted dot product with what is left in the bin. Bins that stay
incomplete are then topped up by cutting pieces off the emptiest bins, and what is
left at the end of a block is cut at powers of two, where no padding is needed.

Blocks never span partitions of the input, so packing needs no shuffle: a hot source
or a huge group of copies only changes what lies in a block, and a lost task repeats
its own blocks with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vellum.llm.shared import bounded_batches, give_back, slices, text_or_empty, tidy

PACKED = (
    "start long, length long, ids binary, doc_tokens long, loss_tokens long, "
    "sequence_id long, offset long, padded_length long"
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


@dataclass
class Piece:
    """Tokens [start, start + length) of an example."""

    item: int
    start: int
    length: int
    loss: int


class Losses:
    """Loss-bearing tokens within a range of an example; without spans all tokens count."""

    def __init__(self, lengths: np.ndarray, spans: list[np.ndarray | None] | None = None):
        self.lengths, self.sums = lengths, {}
        for item, span in enumerate(spans or ()):
            if span is not None:
                marks = np.zeros(int(lengths[item]) + 1, np.int64)
                for a, b in span:
                    marks[a + 1 : b + 1] = 1
                self.sums[item] = np.cumsum(marks)

    def between(self, item: int, start: int, end: int) -> int:
        sums = self.sums.get(item)
        return end - start if sums is None else int(sums[end] - sums[start])

    def reach(self, item: int, start: int, tokens: int, loss: int) -> int:
        """The most tokens from ``start`` on within both allowances."""
        most = min(tokens, int(self.lengths[item]) - start)
        sums = self.sums.get(item)
        if sums is None:
            return min(most, loss)
        return min(most, int(np.searchsorted(sums, sums[start] + loss, side="right")) - 1 - start)


class Sequence:
    """An open bin."""

    def __init__(self) -> None:
        self.pieces: list[Piece] = []
        self.tokens = self.loss = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.tokens += piece.length
        self.loss += piece.loss


def _head(losses: Losses, piece: Piece, length: int) -> tuple[Piece, Piece]:
    """``piece`` cut after ``length`` tokens."""
    middle = piece.start + length
    a = Piece(piece.item, piece.start, length, losses.between(piece.item, piece.start, middle))
    return a, Piece(piece.item, middle, piece.length - length, piece.loss - a.loss)


def _closed(sequence: Sequence, limits: Limits) -> bool:
    """Whether nothing more can go in, or padding isn't needed."""
    return sequence.tokens == limits.tokens


def place(lengths: np.ndarray, losses: Losses, limits: Limits) -> list[Sequence]:
    """Whole examples into bins by the dot-product heuristic; longer ones are cut first."""
    bins: list[Sequence] = []
    items: list[Piece] = []
    for item, length in enumerate(lengths.tolist()):
        start = 0
        while start < length:
            n = losses.reach(item, start, limits.tokens, limits.loss_tokens)
            piece = Piece(item, start, n, losses.between(item, start, start + n))
            if n == limits.tokens:
                full = Sequence()
                full.add(piece)
                bins.append(full)
            else:
                items.append(piece)
            start += n
    if not items:
        return bins
    demand = np.array([(p.length, 1, p.loss) for p in items], np.float64)
    limit = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.float64)
    share = demand / limit
    weight = share.mean(axis=0)
    left = np.argsort(-share.max(axis=1), kind="stable")  # the largest first among equal scores
    share = share[left]
    while len(left):
        room, taken, open_bin = np.ones(3), [], Sequence()
        candidates = np.arange(len(left))
        scores = share * weight
        while len(candidates):
            best = candidates[int(np.argmax(scores[candidates] @ room))]
            taken.append(best)
            room = room - share[best]
            candidates = candidates[candidates != best]
            candidates = candidates[(share[candidates] <= room + 1e-12).all(axis=1)]
        for k in taken:
            open_bin.add(items[left[k]])
        bins.append(open_bin)
        keep = np.ones(len(left), bool)
        keep[taken] = False
        left, share = left[keep], share[keep]
    return bins


def top_up(bins: list[Sequence], losses: Losses, limits: Limits) -> list[Sequence]:
    """Full bins: the fullest incomplete ones take pieces cut off the emptiest ones."""
    done = [b for b in bins if _closed(b, limits)]
    rest = sorted((b for b in bins if not _closed(b, limits)), key=lambda b: -b.tokens)
    front, back = 0, len(rest) - 1
    while front < back:
        taker, giver = rest[front], rest[back]
        if not giver.pieces:
            back -= 1
            continue
        room = limits.tokens - taker.tokens
        if not room or len(taker.pieces) >= limits.segments or taker.loss >= limits.loss_tokens:
            front += 1
            done.append(taker)
            continue
        piece = giver.pieces.pop()
        giver.tokens -= piece.length
        giver.loss -= piece.loss
        n = losses.reach(piece.item, piece.start, min(room, piece.length), limits.loss_tokens - taker.loss)
        if n <= 0:
            giver.add(piece)
            front += 1
            done.append(taker)
            continue
        if n < piece.length:
            piece, tail = _head(losses, piece, n)
            giver.add(tail)
        taker.add(piece)
    return done + [b for b in rest[front : back + 1] if b.pieces]


def at_powers(sequence: Sequence, losses: Losses, limits: Limits) -> list[Sequence]:
    """An incomplete bin as bins whose tokens are powers of two."""
    out, pieces, tokens = [], sequence.pieces[::-1], sequence.tokens
    while tokens:
        size = limits.tokens if tokens >= limits.tokens else 1 << (tokens.bit_length() - 1)
        part, tokens = Sequence(), tokens - size
        while part.tokens < size:
            piece = pieces.pop()
            if piece.length > size - part.tokens:
                piece, tail = _head(losses, piece, size - part.tokens)
                pieces.append(tail)
            part.add(piece)
        out.append(part)
    return out


def pack_block(lengths: np.ndarray, losses: Losses, limits: Limits) -> list[Sequence]:
    """All examples of a block, each token in exactly one piece."""
    packed = top_up(place(lengths, losses, limits), losses, limits)
    return [part for b in packed for part in ([b] if _closed(b, limits) else at_powers(b, losses, limits))]


class PieceTokenizer:
    """Whole-text token ids of a tokenizer that never joins across white space or ASCII kinds.

    The ids are those of the tokenizer as its file has it, without special tokens added; names of
    special tokens that a text holds are their ids, as there. Texts are cut where the tokenizer
    surely cuts: at ASCII white space, and between ASCII letters, digits and marks. Each distinct
    piece is encoded once and kept; the kept pieces are bounded, so memory is too. Other
    characters stay with their neighbours, and such pieces go through the whole tokenizer.
    """

    #: Kinds of bytes: white space, letters, digits, marks, and parts of other characters.
    KINDS = np.full(256, 3, np.uint8)
    KINDS[[9, 10, 11, 12, 13, 32]] = 0
    KINDS[[*range(65, 91), *range(97, 123)]] = 1
    KINDS[48:58] = 2
    KINDS[128:] = 4
    LOWER = np.arange(256, dtype=np.uint8)
    LOWER[65:91] += 32
    PLAIN = re.compile(rb"[a-z]+|[!-/:-@\[-`{-~]+")
    #: Stands between pieces that are encoded together.
    BETWEEN = b"\x01"

    def __init__(self, path: str, kept: int = 200_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.full.model)  # the same vocabulary in memory
        special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        # Plain pieces are normal already, and one word each.
        words = pre_tokenizers.Split(" ", "removed")
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [words, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.kept, self.pieces, self.older = kept, {}, {}
        # Every word's last token ends the word, so ids of many words can be parted again.
        ending = sorted(i for token, i in self.full.get_vocab().items() if token.endswith("</w>"))
        self.ends = np.zeros(self.full.get_vocab_size(), bool)
        self.ends[ending] = True
        self.between = self._ids(self.full, [self.BETWEEN])[0]

    @staticmethod
    def _ids(tokenizer, texts: list[bytes]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, pieces: list[bytes]) -> None:
        """Pieces are encoded together, parted by what they can't hold; where that fails, one by one."""
        plain, odd = [], []
        for p in pieces:
            (plain if self.PLAIN.fullmatch(p) else odd).append(p)
        for a in range(0, len(plain), 4096):
            some = plain[a : a + 4096]
            ids = self._ids(self.plain, [b" ".join(some)])[0]
            self._keep(some, ids, np.flatnonzero(self.ends[ids]) + 1, 0, self.plain)
        mark = len(self.between)
        for a in range(0, len(odd), 4096):
            some = odd[a : a + 4096]
            ids = self._ids(self.full, [b"".join(p + b" " + self.BETWEEN + b" " for p in some)])[0]
            if mark == 1 and not any(self.BETWEEN in p for p in some):
                self._keep(some, ids, np.flatnonzero(ids == self.between[0]) + 1, 1, self.full)
            else:
                self._keep(some, ids, np.zeros(0, np.int64), 1, self.full)

    def _keep(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray, mark: int, tokenizer) -> None:
        """``ends``: where each piece's ids end, the ``mark`` last ones of them not being its own."""
        if len(ends) == len(pieces):
            raw, starts = ids.tobytes(), [0, *(4 * ends[:-1]).tolist()]
            self.pieces.update(
                (p, raw[a:b]) for p, a, b in zip(pieces, starts, (4 * (ends - mark)).tolist(), strict=True)
            )
        else:
            self.pieces.update((p, x.tobytes()) for p, x in zip(pieces, self._ids(tokenizer, pieces), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, and where each text starts (one more than texts)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        named = pc.match_substring_regex(texts, self.special.pattern).to_numpy(zero_copy_only=False)
        if named.any():
            return self._apart(texts.to_pylist(), named)
        return self._pieces_of(texts)

    def _apart(self, texts: list[str], named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that name special tokens, each through the whole tokenizer, and the others."""
        plain = [t for t, n in zip(texts, named, strict=True) if not n]
        ids, bounds = self._pieces_of(pa.array(plain, pa.large_string()))
        rest = iter(ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
        own = [self._ids(self.full, [t.encode()])[0] if n else next(rest) for t, n in zip(texts, named, strict=True)]
        return np.concatenate(own), np.concatenate(([0], np.cumsum([len(x) for x in own])))

    def _pieces_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return np.zeros(0, np.uint32), np.zeros(len(ends) + 1, np.int64)
        raw = texts.buffers()[2]
        first = int(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset])
        data = self.LOWER[np.frombuffer(raw, np.uint8)[first : first + total]]
        kind = self.KINDS[data]
        cut = kind[1:] != kind[:-1]
        one_sided = (kind[1:] == 4) | (kind[:-1] == 4) | ((data[:-1] == 39) & (kind[1:] == 1))
        cut &= ~(one_sided & (kind[1:] > 0) & (kind[:-1] > 0))
        at = np.concatenate(([True], cut, [True]))
        at[ends] = True
        offsets = np.flatnonzero(at)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self._found(pieces.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        begin = np.cumsum(sizes) - sizes
        index = pieces.indices.to_numpy()
        n = sizes[index]
        upto = np.cumsum(n)
        ids = pool[np.repeat(begin[index] - (upto - n), n) + np.arange(int(upto[-1]))]
        before = np.concatenate(([0], upto))
        return ids, before[np.searchsorted(offsets, np.concatenate(([0], ends)))]

    def _found(self, names: list[bytes]) -> list[bytes]:
        """The pieces' ids. Pieces kept longest without being asked for are forgotten, half of all at a time."""
        if len(self.pieces) > self.kept:
            self.pieces, self.older = {}, self.pieces
        found = list(map(self.pieces.get, names))
        if None in found:
            missing = [p for p, ids in zip(names, found, strict=True) if ids is None]
            known = {p: ids for p in missing if (ids := self.older.get(p)) is not None}
            self.pieces.update(known)
            self._learn([p for p in missing if p not in known])
            found = list(map(self.pieces.__getitem__, names))
        return found


def pack_tokens(
    df: DataFrame,
    tokenizer_path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    loss_column: str | None = None,
    limits: Limits = Limits(),
    end_id: int = 1,
    block_tokens: int = 1_000_000,
) -> DataFrame:
    """Tokenise and pack every row of ``df``; one row a piece, with its ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers, the form in
    which training readers map them. ``padded_length`` is the sequence's length after
    padding: ``limits.tokens``, or its own where that is a power of two.

    All tokens of plain texts bear loss. With ``loss_column`` the text column holds an array of
    texts, such as the turns of a conversation, and the loss column an array that says of each
    whether its tokens bear loss; texts without a word there don't. An example's end id does as
    its last text does. ``loss_tokens`` counts a piece's tokens that bear loss.

    Null and empty texts are the end id alone, as are null arrays and those without texts.
    Very long texts are cut. Repeated rows and rows with a null or repeated id are packed like
    any other. An empty table gives no rows. Further columns of ``df`` aren't read, whatever
    their names. ``sequence_id`` holds the number of the input partition in its upper bits: it
    is unique, and the same again when a task is repeated.
    """
    from pyspark.sql import functions as F

    bounded_batches(df.sparkSession)
    text = F.col(f"`{text_column}`")
    columns = [F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(text).alias("text")]
    if loss_column is not None:
        bears = F.coalesce(F.col(f"`{loss_column}`").cast("array<boolean>"), F.array().cast("array<boolean>"))
        columns[1:] = [F.coalesce(text.cast("array<string>"), F.array().cast("array<string>")).alias("text"), bears.alias("bears")]
    chosen = df.select(*columns)
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    arrow_id = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())
    if arrow_id == pa.string():
        chosen = chosen.withColumn("doc_id", F.col("doc_id").cast("string"))
        id_type = "string"
    return chosen.mapInArrow(
        tidy(_packer(tokenizer_path, limits, end_id, block_tokens, arrow_id)), f"doc_id {id_type}, {PACKED}"
    )


@dataclass
class Examples:
    """Encoded examples of a block: ids one after the other, each example's end id included."""

    doc_ids: list[pa.Array]
    ids: list[np.ndarray]
    lengths: list[np.ndarray]
    spans: list[np.ndarray | None]
    tokens: int = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray, end_id: int, spans: list | None) -> None:
        n = len(bounds) - 1
        sizes = np.diff(bounds)
        ended = np.empty(len(ids) + n, np.uint32)
        ended[np.arange(len(ids)) + np.repeat(np.arange(n), sizes)] = ids
        ended[bounds[1:] + np.arange(n)] = end_id
        self.doc_ids.append(doc_ids)
        self.ids.append(ended)
        self.lengths.append(sizes + 1)
        self.spans += spans if spans is not None else [None] * n
        self.tokens += len(ended)


def _loss_spans(texts: pa.Array, bears: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bounds of the examples, and of each the token ranges that bear loss."""
    offsets = texts.offsets.to_numpy() - texts.offsets[0].as_py()
    whole, spans = bounds[offsets], []
    for row, marks in enumerate(bears.to_pylist()):
        first, n = int(offsets[row]), int(offsets[row + 1] - offsets[row])
        marks = [bool(m) for m in marks[:n]] + [False] * (n - len(marks))
        at = bounds[first : first + n + 1] - whole[row]
        own = [(int(at[k]), int(at[k + 1])) for k in range(n) if marks[k]]
        end = int(whole[row + 1] - whole[row])
        spans.append(np.array(own + ([(end, end + 1)] if n and marks[-1] else []), np.int64).reshape(-1, 2))
    return whole, spans


def _packer(tokenizer_path: str, limits: Limits, end_id: int, block_tokens: int, arrow_id: pa.DataType):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset", "padded_length"]

    def flush(block: Examples, first: int) -> tuple[pa.RecordBatch, int]:
        lengths = np.concatenate(block.lengths)
        ids, begin = np.concatenate(block.ids), np.cumsum(lengths) - lengths
        sequences = pack_block(lengths, Losses(lengths, block.spans), limits)
        pieces = [p for sequence in sequences for p in sequence.pieces]
        item, start, length, loss = (
            np.fromiter((getattr(p, name) for p in pieces), np.int64, len(pieces)) for name in ("item", "start", "length", "loss")
        )
        of = np.repeat(np.arange(len(sequences)), [len(s.pieces) for s in sequences])
        tokens = np.array([s.tokens for s in sequences], np.int64)
        upto = np.cumsum(length)
        padded = np.where(tokens & (tokens - 1) == 0, tokens, limits.tokens)
        at = begin[item] + start
        body = ids[np.repeat(at - (upto - length), length) + np.arange(int(upto[-1]))].astype("<u4")
        bounds = (4 * np.concatenate(([0], upto))).astype(np.int32)
        offset = (upto - length) - (np.cumsum(tokens) - tokens)[of]
        arrays = [
            pa.concat_arrays([a.cast(arrow_id) for a in block.doc_ids]).take(pa.array(item)), pa.array(start), pa.array(length),
            pa.BinaryArray.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(bounds), pa.py_buffer(body)]),
            pa.array(lengths[item]), pa.array(loss), pa.array(of + first), pa.array(offset), pa.array(padded[of]),
        ]
        return pa.RecordBatch.from_arrays(arrays, names), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 36
        block = Examples([], [], [], [])
        for batch in batches:
            for some in slices(batch, 1, 1_500_000) if batch.num_columns == 2 else _rows(batch, 64):
                spans = None
                if batch.num_columns == 2:
                    ids, bounds = tokenizer.encode(some.column(1))
                else:
                    ids, bounds = tokenizer.encode(some.column(1).flatten())
                    bounds, spans = _loss_spans(some.column(1), some.column(2), bounds)
                block.add(some.column(0), ids, bounds, end_id, spans)
                if block.tokens >= block_tokens:
                    out, sequence = flush(block, sequence)
                    block = Examples([], [], [], [])
                    yield out
                    give_back()
        if block.tokens:
            yield flush(block, sequence)[0]
        tokenizer.pieces, tokenizer.older = {}, {}  # the worker lives on; other work needs the memory

    return run


def _rows(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    return (batch.slice(a, most) for a in range(0, batch.num_rows, most))


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def _tokenizer(path: str) -> PieceTokenizer:
    """One a Python worker: it serves all the tasks that the worker runs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]
