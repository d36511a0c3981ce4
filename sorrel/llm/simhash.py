"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits of each other have a fingerprint between them that is within half
the radius of both. So every distinct fingerprint emits all its *variants* with up to ``radius / 2``
flipped bits, variants are brought together by value, and two fingerprints under one variant are a
colliding pair.

Variants are shuffled by their leading bits. All variants of a fingerprint with the same leading bits
travel as one entry: the fingerprint itself, addressed to these bits; the task there knows how many flips
are left and writes out the variants with their remaining bits. So 2,081 variants of 64 bits cross the
network as a few dozen entries. As many leading bits are taken as bring the fullest bucket
within a bound; a bucket that is fuller still is worked through by further leading bits, one part after
the other, so that memory is bounded for any distribution.

Equal variants put their fingerprints side by side. A run of them is linked as a chain, not pair by pair,
since any two fingerprints under one variant are within the radius. Every linked pair is verified by its
differing bits. Of the pairs of a bucket only links that connect something new leave it, and connected
components of all links give the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import bound_rows, shuffle_partitions, stored
from sorrel.llm.components import connected_components
from sorrel.operators.joins import lookup_join

U = np.uint64
BITS = 64
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16
#: Fingerprints of a bucket aimed at, and the numbers of leading bits to choose from.
BUCKET, LEADING = 8_192, (4, 8, 12, 16, 20)
#: Variants written out at a time, and the leading bits by which a fuller part is cut.
VARIANTS, CUT = 1 << 21, 4


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """64 bits, each set if it is set in more than half of the hashes of the text's shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count, ones, digest = len(words) - size + 1, np.zeros(BITS, np.int64), xxhash.xxh64_digest
    for first in range(0, count, COUNTED):
        last = min(count, first + COUNTED)
        stretches = zip(starts[first:last].tolist(), ends[first + size - 1 : last + size - 1].tolist())
        hashes = b"".join([digest(joined[a:b], seed) for a, b in stretches])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bound_rows(batches, "text"):
            found = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], dtype=U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "node"])

    return run


def ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


@lru_cache(maxsize=256)
def flips(width: int, most: int) -> np.ndarray:
    """All masks over the ``width`` lowest bits with up to ``most`` bits set."""
    masks = [np.zeros(1, U)]
    for _ in range(most):
        # Each further bit lies above the highest one so far, so that no mask comes twice.
        masks.append(np.array([int(m) | 1 << b for m in masks[-1] for b in range(int(m).bit_length(), width)], dtype=U))
    return np.concatenate(masks)


def _addressed(leading: int, half: int):
    """Every fingerprint once for each value of the leading bits that one of its variants has."""
    masks = flips(leading, half).astype(np.int64)
    schema = pa.schema([("to", pa.int64()), ("nodes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy().view(U)
            to = ((nodes >> U(BITS - leading)).astype(np.int64)[:, None] ^ masks).ravel()
            order = np.argsort(to, kind="stable")
            to, sent = to[order], np.repeat(nodes, len(masks))[order]
            cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, int)
            parts = [sent[a:b].tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(to)])]
            yield pa.RecordBatch.from_arrays([pa.array(to[cuts]), pa.array(parts, pa.binary())], schema=schema)

    return run


class Links:
    """Which fingerprints of a bucket are connected, as a forest over their places."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            one, other = root[a], root[b]
            apart = one != other
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(one, other)[apart], np.minimum(one, other)[apart])
            while (up := root[root] != root).any():
                root[up] = root[root[up]]


def collide(nodes: np.ndarray, at: np.ndarray, prefix: int, leading: int, half: int, radius: int, links: Links) -> None:
    """Link the fingerprints ``nodes[at]`` that share a variant with these ``leading`` bits.

    ``at`` are those with at most ``half`` flips in the leading bits.
    """
    left = half - (ones(nodes[at] >> U(BITS - leading) ^ U(prefix)) if leading else np.zeros(len(at), int)).astype(int)
    width = BITS - leading
    sizes = np.array([sum(comb(width, j) for j in range(k + 1)) for k in range(half + 1)])
    total = int(sizes[left].sum())
    if len(at) < 2:
        return
    if total > VARIANTS and width > CUT:
        # One more piece of the leading bits: the parts are worked through one after the other.
        deeper = leading + CUT
        tops = nodes[at] >> U(BITS - deeper)
        for piece in range(1 << CUT):
            below = prefix << CUT | piece
            collide(nodes, at[ones(tops ^ U(below)) <= half], below, deeper, half, radius, links)
        return
    rest, variants, owners = U((1 << width) - 1), [], []
    for k in range(half + 1):
        mine = at[left == k]
        variants.append(((nodes[mine] & rest)[:, None] ^ flips(width, k)).ravel())
        owners.append(np.repeat(mine, sizes[k]))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants)
    variants, owners = variants[order], owners[order]
    same = np.flatnonzero(variants[1:] == variants[:-1])
    pairs = np.unique(owners[same] * len(nodes) + owners[same + 1])
    a, b = pairs // len(nodes), pairs % len(nodes)
    verified = ones(nodes[a] ^ nodes[b]) <= radius
    links.join(a[verified], b[verified])


def bucket_links(frame: pd.DataFrame, leading: int, half: int, radius: int) -> pd.DataFrame:
    """Links of one bucket, from every connected fingerprint to the first of its group."""
    nodes = np.unique(np.frombuffer(b"".join(frame["nodes"]), U))
    links = Links(len(nodes))
    collide(nodes, np.arange(len(nodes)), int(frame["to"].iloc[0]), leading, half, radius, links)
    linked = np.flatnonzero(links.root != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[linked].view(np.int64), "b": nodes[links.root[linked]].view(np.int64)})


def leading_bits(nodes: DataFrame, bucket: int = BUCKET) -> int:
    """The fewest leading bits for which no value of them has more than ``bucket`` fingerprints, if any."""
    levels = F.explode(F.array(*[F.lit(n) for n in LEADING]))
    value = F.expr(f"shiftrightunsigned(node, {BITS} - level)")
    counts = nodes.select("node", levels.alias("level")).groupBy("level", value.alias("value")).count()
    fullest = {r["level"]: r["most"] for r in counts.groupBy("level").agg(F.max("count").alias("most")).collect()}
    return next((n for n in LEADING if fullest.get(n, 0) <= bucket), LEADING[-1])


def near_fingerprints(nodes: DataFrame, radius: int = 4, leading: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints (distinct longs in ``node``) within ``radius`` bits of each other."""
    half = -(-radius // 2)
    leading = leading_bits(nodes) if leading is None else leading
    sent = nodes.mapInArrow(_addressed(leading, half), "to long, nodes binary")
    dealt = sent.repartition(shuffle_partitions(nodes.sparkSession), "to").groupBy("to")
    return dealt.applyInPandas(lambda f: bucket_links(f, leading, half, radius), "a long, b long").distinct()


def simhash_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, leading: int | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``: fingerprints within ``radius`` bits are linked.

    The fingerprint is 16 hexadecimal digits. A null or empty text has fingerprint zero, which is linked like
    any other. Repeated rows share a component; rows of one id are one document, so that their
    fingerprints are linked. A row without an id is linked as well and bears the smallest id of its
    component, null if there is none. Texts are read whole, the hashes of a very long one in pieces. Further
    columns do not matter; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(rows.mapInArrow(_fingerprints(size), "doc_id long, node long"))
    nodes = stored(signed.groupBy("node").agg(F.min("doc_id").alias("least")))
    near = near_fingerprints(nodes.select("node"), radius, leading)
    shared = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("c"))
    same_id = signed.join(shared.where("b <> c"), "doc_id").select(F.col("node").alias("a"), "b").where("a <> b")
    parts = connected_components(near.union(same_id))
    placed = nodes.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    named = stored(placed.select("node", "part").join(least, "part").select("node", "component_id"))
    found = lookup_join(signed, named, ["node"], ["doc_id"])
    return found.select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")
