"""Words and hashes of whole texts as numpy arrays, for use inside tasks.

A word is a run of bytes other than the separators ``\\x20 \\x09-\\x0D``. Hashes of byte
strings are polynomials modulo 2**64 with an odd base, taken from running sums, so the hash
of any stretch of a text costs two lookups. All constants are fixed: every task, whichever
machine it runs on, hashes alike.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
#: Bytes that are hashed at a time; working memory is some 40 times this.
SLICE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values over the whole word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the bases and of their inverses, worked out once in a task and lengthened as needed."""

    def __init__(self):
        self.kept: dict[int, np.ndarray] = {}

    def of(self, base: np.uint64, n: int) -> np.ndarray:
        table = self.kept.get(int(base))
        if table is None or len(table) < n:
            table = self.kept[int(base)] = powers(base, n)
        return table[:n]


class Sums:
    """Running sums of one array under one base, from which the hash of any stretch takes two lookups."""

    def __init__(self, values: np.ndarray, base: np.uint64, kept: Powers):
        n = len(values)
        self.inverse = kept.of(U(pow(int(base), -1, 1 << 64)), n + 1)
        self.sums = np.zeros(n + 1, dtype=U)
        terms = values.astype(U)
        terms += U(1)
        terms *= kept.of(base, n)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of each stretch; equal stretches of any arrays hash alike."""
        # Dividing by the power at the start makes the hash the same wherever the stretch lies.
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start] ^ (stop - start).astype(U))

    def every(self, width: int) -> np.ndarray:
        """The hash of the stretch of ``width`` values at every place that has one."""
        out = self.sums[width:] - self.sums[: len(self.sums) - width]
        out *= self.inverse[: len(out)]
        out ^= U(width)
        return mix(out)


def stretch_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: np.uint64 = BASES[0]) -> np.ndarray:
    """Hash of each ``values[start:stop]``; equal stretches of any arrays hash alike."""
    return Sums(values, base, Powers()).of(start, stop)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of every word."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def word_hashes(text: bytes, lower: bool = False, base: np.uint64 = BASES[0], kept: Powers | None = None) -> np.ndarray:
    """One 64-bit hash per word of the text, worked out slice by slice."""
    data, kept = np.frombuffer(text, dtype=np.uint8), kept or Powers()
    if lower:
        data = lower_ascii(data)
    start, stop = word_bounds(data)
    if len(data) <= SLICE:
        return Sums(data, base, kept).of(start, stop)
    out, first = [], 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(stop, start[first] + SLICE, side="right")))
        a, b = start[first], stop[last - 1]
        out.append(Sums(data[a:b], base, kept).of(start[first:last] - a, stop[first:last] - a))
        first = last
    return np.concatenate(out) if out else np.zeros(0, dtype=U)


def word_hashes_of(texts: list[bytes], kept: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts in a row, and the number of words of each; short texts are hashed together."""
    if sum(map(len, texts)) > 2 * SLICE:
        parts = [word_hashes(t, kept=kept) for t in texts]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    start, stop = word_bounds(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return Sums(data, BASES[0], kept).of(start, stop), np.diff(np.searchsorted(start, ends), prepend=0)


def gram_hashes(words: np.ndarray, n: int, base: np.uint64 = BASES[1]) -> np.ndarray:
    """One hash per run of ``n`` values."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=U)
    out = np.zeros(count, dtype=U)
    for i in range(n):
        out = out * base + words[i : i + count]
    return mix(out)
