"""Plain single-process versions that the corpus operators are held against."""

from __future__ import annotations

import hashlib
import re

SEPARATED = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_bytes(docs: dict[int, str | None], window: int = 50) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    texts = {i: (docs[i] or "").encode() for i in sorted(docs)}
    for i, t in texts.items():
        for s in range(len(t) - window + 1):
            first.setdefault(t[s : s + window], i)
    out = {}
    for i, t in texts.items():
        gone = [False] * len(t)
        for s in range(len(t) - window + 1):
            if first[t[s : s + window]] < i:
                gone[s : s + window] = [True] * window
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g)))
    return out


def repeated_words(docs: dict[int, str | None], window: int = 20) -> dict[int, tuple]:
    first: dict[tuple, tuple[int, int]] = {}
    texts = {i: SEPARATED.findall((docs[i] or "").encode()) for i in sorted(docs)}
    for i, w in texts.items():
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), (i, s))
    out = {}
    for i, w in texts.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone[s : s + window] = [True] * window
        out[i] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text: str | None, size: int) -> frozenset:
    words = SEPARATED.findall((text or "").encode().translate(LOWER))
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else frozenset()


def near_components(docs: dict[int, str | None], size: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(docs[i], size) for i in sorted(docs)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def best_products(vectors: dict[int, list[int]], queries: list[int], k: int) -> dict[int, list[tuple[int, int]]]:
    out = {}
    for q in queries:
        scored = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out
