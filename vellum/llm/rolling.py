"""64-bit hashes of all substrings of a byte array, from one running sum."""

from __future__ import annotations

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2 ** 64, and of its inverse; the length is bounded by a slice's."""
    if len(_POWERS.get(0, ())) < n:
        size = 1 << (n - 1).bit_length()
        for key, base in ((0, MULTIPLIER), (1, pow(MULTIPLIER, -1, 1 << 64))):
            table = np.ones(size, np.uint64)
            done, power = 1, np.uint64(base)
            with np.errstate(over="ignore"):
                while done < size:
                    table[done : 2 * done] = table[:done] * power
                    power, done = power * power, 2 * done
            _POWERS[key] = table
    return _POWERS[0], _POWERS[1]


def forget_powers() -> None:
    """Powers are made anew when they are needed again."""
    _POWERS.clear()


#: A number for each byte, by which a second, independent hash of the same bytes comes.
OTHER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def prefix_sums(data: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Running sums s with (s[b] - s[a]) * powers()[1][a] depending on data[a:b] only.

    ``values`` holds a number for each element that ``data`` can have; without it that is the
    element and one.
    """
    up = powers(len(data) + 1)[0]
    sums = np.zeros(len(data) + 1, np.uint64)
    numbers = data.astype(np.uint64) + np.uint64(1) if values is None else values[data]
    np.cumsum(numbers * up[: len(data)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts:ends], element by element."""
    down = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
