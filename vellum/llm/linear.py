"""Hashed features and linear models, fitted on a bounded sample, applied to any number of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, white space made a space, and the texts' bounds.

    Every text begins and ends with a space, so n-grams know where words begin and end.
    """
    spaced = [f" {(t or '').lower()} " for t in texts]
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, spaced), np.int64, len(spaced)))))
    points = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[points < 32] = 32
    return points, bounds


def grams(points: np.ndarray, bounds: np.ndarray | None, sizes: tuple[int, ...], bits: int):
    """For each n: the buckets of all n-grams, and which of them don't reach over a text's end (where bounds are given)."""
    wide = points.astype(np.uint64)
    left = None if bounds is None else np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(points))
    code = np.zeros(len(points), np.uint64)
    for n in range(1, max(sizes) + 1):
        code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + wide[n - 1 :]
        if n in sizes and len(code):
            mixed = code >> np.uint64(29)
            mixed ^= code
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed += np.uint64(n)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed >>= np.uint64(64 - bits)
            yield mixed.view(np.int64), None if left is None else left[: len(code)] >= n


#: Characters whose n-grams are taken together; a longer text is taken in pieces.
PIECE = 400_000


def present(texts: list[str | None], sizes: tuple[int, ...], bits: int, used: np.ndarray | None = None):
    """Pairs (text, bucket), each once, of the buckets in ``used``."""
    points, bounds = characters(texts)
    if len(points) > 2 * PIECE and len(texts) == 1:
        return _present_by_piece(points, sizes, bits, used)
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    keys = []
    for buckets, inside in grams(points, bounds, sizes, bits):
        keep = inside if used is None else inside & used[buckets]
        at = np.flatnonzero(keep)
        keys.append((text_of[at] << bits) | buckets[at])
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return keys >> bits, keys & ((1 << bits) - 1)


def _present_by_piece(points: np.ndarray, sizes: tuple[int, ...], bits: int, used: np.ndarray | None):
    """present() of one very long text: its pieces overlap so that each n-gram lies in one."""
    marks = np.zeros(1 << bits, bool)
    for a in range(0, len(points), PIECE):
        some = points[a : a + PIECE + max(sizes) - 1]
        for buckets, inside in grams(some, np.array([0, len(some)]), sizes, bits):
            marks[buckets[inside]] = True
    if used is not None:
        marks &= used
    buckets = np.flatnonzero(marks)
    return np.zeros(len(buckets), np.int64), buckets


def gram_sets(texts: list[str | None], sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """The buckets of each text's n-grams, each once, as 32-bit numbers."""
    out = []
    for some in _some(texts, PIECE):
        rows, buckets = present(some, sizes, bits)
        out += np.split(buckets.astype(np.int32), np.searchsorted(rows, np.arange(1, len(some))))
    return out


def _some(texts: Iterable[str | None], most: int) -> Iterator[list[str | None]]:
    """Lists of texts of about ``most`` characters; a longer text is a list of its own."""
    out, held = [], 0
    for text in texts:
        if out and held + len(text or "") > most:
            yield out
            out, held = [], 0
        out.append(text)
        held += len(text or "")
    if out:
        yield out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(
    sets: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, weights: np.ndarray,
    penalty: float = 1.0, steps: int = 1000, enough: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by accelerated gradient steps.

    ``sets`` holds the columns of each row, ``scale`` the value of each column wherever it is
    set; the list is left empty. Steps end after ``steps``, or when 50 of them lessen the loss by less than ``enough``
    of itself: at the optimum but for what a score's second decimal shows.
    """
    n, sizes = len(labels), np.array([len(s) for s in sets], np.int64)
    columns = np.concatenate([*sets, np.zeros(0, np.int32)])
    sets.clear()
    columns = columns.astype(np.int64)
    filled = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[filled]
    total = max(float(weights.sum()), 1.0)
    squared = np.add.reduceat((scale**2)[columns], starts).max(initial=1.0) + 1.0 if len(filled) else 2.0
    rate = 1.0 / (0.25 * squared + penalty / total)
    w, bias = np.zeros(len(scale)), 0.0
    v, vb, momentum, before = w.copy(), bias, 1.0, np.inf
    for step in range(steps):
        z = np.full(n, vb)
        if len(filled):
            z[filled] += np.add.reduceat((v * scale)[columns], starts)
        error = weights * (sigmoid(z) - labels) / total
        new = v - rate * (scale * np.bincount(columns, np.repeat(error, sizes), len(scale)) + penalty / total * v)
        new_bias = vb - rate * error.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / following
        v, vb = new + push * (new - w), new_bias + push * (new_bias - bias)
        w, bias, momentum = new, new_bias, following
        if step % 50 == 49:
            loss = float((weights * (np.logaddexp(0, z) - labels * z)).sum() / total + penalty / total / 2 * (w @ w))
            if before - loss < enough * loss:
                break
            before = loss
    return w, float(bias)


@dataclass(frozen=True)
class Grams:
    """A linear model over the presence of hashed n-grams; ``weights`` has 2 ** bits entries."""

    sizes: tuple[int, ...]
    bits: int
    weights: np.ndarray
    bias: float

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The sum of the weights of each text's different n-grams, and the bias.

        A text's last n-gram in a bucket is the one that a table of the buckets names when all of
        them have been written there.
        """
        points, bounds = characters(texts)
        if len(points) > 2 * PIECE and len(texts) == 1:
            _, buckets = present(texts, self.sizes, self.bits, self.weights != 0)
            return np.array([self.weights[buckets].sum(dtype=np.float64) + self.bias])
        sizes, coded = sorted(self.sizes), [b for b, _ in grams(points, None, self.sizes, self.bits)]
        known, named = self.weights != 0, np.empty(1 << self.bits, np.int32)
        numbers = np.arange(int(np.diff(bounds).max(initial=0)) * len(sizes), dtype=np.int32)
        out = np.full(len(texts), self.bias)
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            own = np.concatenate([c[a : b - n + 1] for n, c in zip(sizes, coded, strict=False) if b - a >= n] or [numbers[:0]])
            own = own[known[own]]
            at = numbers[: len(own)]
            named[own] = at
            out[k] += self.weights[own[named[own] == at]].sum(dtype=np.float64)
        return out


def text_slices(column: pa.Array, most: int = PIECE) -> Iterator[list[str | None]]:
    """Lists of texts of about ``most`` characters; a longer text is a list of its own."""
    return _some((x.as_py() for x in column), most)
