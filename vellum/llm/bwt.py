"""Repeated strings among short texts, from merged Burrows-Wheeler transforms.

Each shard of texts is sorted and transformed on its own. The shards' transforms are then
merged without sorting suffixes again: an interleave says from which shard each place of
the merged order comes, and each round of refinement makes it right for one more
character. The round in which two neighbours part is their common prefix; neighbours that
no round up to ``length`` parts share a string of that length.
"""

from __future__ import annotations

import numpy as np


def suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` (16-bit characters) sorted by ``depth`` characters at least."""
    rank, n, h = text.astype(np.int64), len(text), 1
    order = np.argsort(text, kind="stable")
    at = np.arange(n)
    while True:
        ahead = rank[(at + h) % n] if h else rank
        key = rank * (int(rank.max()) + 1) + ahead
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        h *= 2
        if h >= depth or new[-1] == n - 1:
            return order


def shards(texts: list[bytes | np.ndarray], shard_bytes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each shard: its characters, each text ended by 0, and the place of each in all texts.

    Texts are bytes, or characters from 1 on.
    """
    ended = np.zeros(1, np.uint16)
    symbols = lambda t: t if isinstance(t, np.ndarray) else np.frombuffer(t, np.uint8).astype(np.uint16) + 1
    out, some, held, first = [], [], 0, 0
    for k, t in enumerate(texts):
        some.append(t)
        held += len(t) + 1
        if held >= shard_bytes or k == len(texts) - 1:
            joined = np.concatenate([part for x in some for part in (symbols(x), ended)])
            out.append((joined, np.arange(first, first + held)))
            first, some, held = first + held, [], 0
    return out


def merged(texts: list[bytes | np.ndarray], length: int, shard_bytes: int = 8_192) -> tuple[np.ndarray, np.ndarray]:
    """Places of all characters in merged order, and the interval of each: equal where ``length`` characters are.

    Places count the texts' characters with one more after each text.
    """
    parts = shards(texts, shard_bytes)
    sorted_places, last = [], []
    for text, places in parts:
        order = suffixes(text, length)
        sorted_places.append(places[order])
        last.append(text[order - 1])
    places, transform = np.concatenate(sorted_places), np.concatenate(last)
    small = np.uint8 if len(parts) <= 256 else np.uint16 if len(parts) <= 65536 else np.uint32
    interleave = np.repeat(np.arange(len(parts)), [len(p) for p in sorted_places]).astype(small)
    interval, parted = np.zeros(len(places), np.int32), np.zeros(len(places), bool)
    # The k-th place that a shard has in the interleave is the k-th of its own order.
    column, own, found = np.empty_like(transform), np.argsort(interleave, kind="stable"), 0
    for _ in range(length):
        column[own] = transform
        step = np.argsort(column, kind="stable")
        before, character = interval.take(step), column.take(step)
        np.not_equal(before[1:], before[:-1], out=parted[1:])
        parted[1:] |= character[1:] != character[:-1]
        interleave = interleave.take(step)
        own = np.argsort(interleave, kind="stable")
        np.cumsum(parted, out=interval)
        if found == interval[-1] or interval[-1] == len(places) - 1:
            break  # no two neighbours part at this depth, so none do at a greater one
        found = interval[-1]
    out = np.empty_like(places)
    out[own] = places
    return out, interval
