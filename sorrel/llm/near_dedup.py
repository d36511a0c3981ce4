"""Near-duplicate detection by an inverted join over MinHash coordinates, confirmed on full sets.

Documents with the same shingle set are one *node*, found by a digest of the set and numbered. A node's
signature has ``COORDINATES`` values, each the hash of ``ROWS`` minima, so that unrelated
texts seldom agree in one. Nodes are posted under every (coordinate, value) pair. Two sets
with similarity 0.8 agree in fewer than ``MATCHES`` of 32 coordinates with a probability of
about 6e-8, and that is the only way in which a link can be lost.

Pairs of a large group are never all written out:

1. every node meets the smallest nodes of its lists; the two with most collisions are
   compared on full sets, and the links contract into components;
2. lists whose nodes are all in one component are skipped from here on. In short lists
   the remaining pairs are posted, collisions are counted, and pairs that reach the match
   threshold are compared on full sets;
3. in long lists the nodes meet, with their sets, in blocks of bounded size, where the
   exact overlaps of nodes outside the block's main component are counted by an inverted
   index. Only links that connect components leave a block.

Components of all links then give the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import bound_rows, shuffle_partitions, stored
from sorrel.llm.components import connected_components
from sorrel.llm.tokens import U, gram_hashes, mix, word_hashes
from sorrel.operators.joins import lookup_join

COORDINATES, ROWS, MATCHES = 32, 3, 3
SHORT_LIST = 64
BLOCK = 1_024
CHUNK = 256


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles; a text with fewer words has its whole sequence as one."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"), lower=True)
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(size, len(words))))


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One 64-bit value per coordinate, each from ``ROWS`` minima and the coordinate's number."""
    least = np.full(len(multipliers), ~U(0), dtype=U)
    for start in range(0, len(shingles), CHUNK):
        part = shingles[start : start + CHUNK, None] * multipliers
        np.minimum(least, part.min(axis=0), out=least)
    rows = least.reshape(-1, ROWS)
    out = np.arange(1, len(rows) + 1, dtype=U)
    for r in range(ROWS):
        out = mix(out * U(0xC2B2AE3D27D4EB4F) + rows[:, r])
    return out


def digest_of(shingles: np.ndarray, multipliers: np.ndarray) -> bytes:
    """128 bits that name a shingle set."""
    return b"".join(int(np.add.reduce(mix(shingles * m), dtype=U)).to_bytes(8, "big") for m in multipliers[:2])


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(COORDINATES * ROWS)
        for batch in bound_rows(batches, "text"):
            ns, digests, values = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), size)
                ns.append(len(shingles))
                one = signature(shingles, multipliers) if len(shingles) else np.zeros(0, dtype=U)
                values.append(one.view(np.int64))
                digests.append(digest_of(shingles, multipliers))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(values, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return run


def signatures(docs: DataFrame, size: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sign(size), "doc_id long, n_shingles long, digest binary, signature array<long>")


def _sets(size: int):
    """The set of each wanted node, from the text under its id that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(2)
        for batch in bound_rows(batches, "text"):
            nodes, sets = [], []
            columns = (batch.column(c).to_pylist() for c in ("node", "digest", "text"))
            for node, digest, text in zip(*columns):
                shingles = shingle_set(text, size)
                if digest_of(shingles, multipliers) == digest:
                    nodes.append(node)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])

    return run


def similar(overlap: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (one + other - overlap)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bound_rows(batches, "sb"):
            kept = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                one, other = np.frombuffer(sa.as_py(), dtype=U), np.frombuffer(sb.as_py(), dtype=U)
                both = np.intersect1d(one, other, assume_unique=True).size
                kept.append(bool(similar(both, len(one), len(other), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    small = F.octet_length("sa") * 100 >= F.octet_length("sb") * percent
    large = F.octet_length("sb") * 100 >= F.octet_length("sa") * percent
    met = pairs.join(left, "a").join(right, "b").where(small & large)
    return met.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _short_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of different components in short lists, with the number of lists they share."""
    nodes = F.array_sort(F.collect_list(F.struct("node", "component")))
    grouped = lists.groupBy("key").agg(nodes.alias("nodes"))
    one = grouped.select("nodes", F.posexplode("nodes").alias("at", "x"))
    later = F.filter(F.slice("nodes", F.col("at") + 2, F.lit(SHORT_LIST)), lambda y: y["component"] != F.col("x.component"))
    pairs = one.select(F.col("x.node").alias("a"), F.explode(later).alias("y")).select("a", F.col("y.node").alias("b"))
    return pairs.groupBy("a", "b").count().where(F.col("count") >= MATCHES).select("a", "b")


def block_links(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Exact links between components within one pair of blocks, as many as it takes to connect what they connect."""
    nodes, side = frame["node"].to_numpy(), frame["side"].to_numpy()
    crossing = side.min() != side.max()
    comps, names = pd.factorize(frame["component"])
    main = np.bincount(comps).argmax()
    strays = np.flatnonzero(comps != main)
    if not len(strays):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sets = [np.frombuffer(s, dtype=U) for s in frame["set"]]
    sizes = np.array([len(s) for s in sets])
    shingles = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owners = shingles[order], owners[order]
    out, root = [], list(range(len(names)))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    for x in strays:
        start = np.searchsorted(shingles, sets[x], side="left")
        stop = np.searchsorted(shingles, sets[x], side="right")
        spans = stop - start
        # Positions of all postings of x's shingles, without a loop over shingles.
        at = np.repeat(start - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
        overlap = np.bincount(owners[at], minlength=len(sets))
        fits = similar(overlap, sizes[x], sizes, percent) & (comps != comps[x])
        if crossing:
            fits &= side != side[x]
        # One link per component, and none between components that are connected by now.
        linked = np.flatnonzero(fits)
        for y in linked[np.unique(comps[linked], return_index=True)[1]]:
            one, other = find(comps[x]), find(comps[y])
            if one != other:
                root[one] = other
                out.append((nodes[x], nodes[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _block_links(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between components among the ``(group, node, component)`` rows of long lists."""
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = members.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = cut.withColumn("with", other).select(
        "group", "node", "component", F.col("own").alias("side"),
        F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
    )
    n = shuffle_partitions(members.sparkSession)
    keyed = met.join(sets, "node").repartition(n, "group", "i", "j").groupBy("group", "i", "j")
    return keyed.applyInPandas(lambda frame: block_links(frame, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``.

    Rows without words, or without an id, are linked with nothing and kept. Rows with one id are
    one document: the sets of all its texts with words are linked, whatever their order, and its rows
    are kept if its id is the smallest of the component. Very long texts are hashed whole. Further columns
    do not matter; an empty table gives an empty result.
    """
    signed = stored(signatures(docs, shingle))
    worded = signed.where("n_shingles > 0 and doc_id is not null")
    classes = worded.groupBy("digest").agg(F.min("doc_id").alias("least"), F.any_value("signature").alias("signature"))
    # Numbered as they are stored, so that every later step sees the same numbers.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    posted = classes.select("node", F.explode("signature").alias("key"))
    lists = posted.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("first")).where("size > 1")
    live = stored(posted.join(lists, "key"))
    # Fewer shared lists than the threshold leave no candidate.
    wanted = live.groupBy("node").count().where(F.col("count") >= MATCHES).select("node")
    named = classes.join(wanted, "node").select(F.col("least").alias("_id"), "node", "digest")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    # Another text under the same id has another set, and repeated rows have one.
    needed = texts.join(named, "_id").dropDuplicates(["_id", "node", "text"]).select("node", "digest", "text")
    sets = stored(needed.mapInArrow(_sets(shingle), "node long, set binary"))

    stars = live.where("node <> first").groupBy("node", "first").count().where(F.col("count") >= MATCHES)
    ranked = F.slice(F.sort_array(F.collect_list(F.struct(F.col("count"), F.col("first"))), asc=False), 1, 2)
    best = stars.groupBy("node").agg(ranked.alias("best")).select(F.col("node").alias("a"), F.explode("best").alias("s"))
    links = stored(confirm(best.select("a", F.col("s.first").alias("b")), sets, percent))
    parts = connected_components(links)

    placed = stored(live.join(parts, "node", "left").select(
        "key", "size", "node", F.coalesce("component", "node").alias("component")
    ))
    mixed = placed.groupBy("key").agg(F.min("component").alias("group"), F.max("component").alias("most"))
    mixed = mixed.where(F.col("group") != F.col("most")).select("key", "group")
    left = stored(placed.join(mixed, "key"))
    short = confirm(_short_pairs(left.where(F.col("size") <= SHORT_LIST)), sets, percent)
    members = stored(left.where(F.col("size") > SHORT_LIST).select("group", "node", "component").distinct())
    more = stored(short.union(_block_links(members, sets, percent, block)))
    # Components found first stand for their nodes, so their links need not be walked again.
    first = parts.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    mark = F.xxhash64("digest")
    shared = worded.groupBy("doc_id").agg(F.min(mark).alias("b"), F.max(mark).alias("c")).where("b <> c").select("doc_id")
    borne = worded.join(shared, "doc_id").select("doc_id", "digest").distinct()
    borne = stored(borne.join(classes.select("digest", "node"), "digest").select("doc_id", F.col("node").alias("a")))
    same_id = borne.join(borne.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b").where("a <> b")
    final = connected_components(first.union(more).union(same_id))

    placed = classes.join(final, "node", "left").select("digest", "node", "least", F.coalesce("component", "node").alias("part"))
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    ids = lookup_join(placed.select("digest", "node", "part"), stored(least), ["part"], ["node"]).select("digest", "component_id")
    # Without words the digest is that of the empty set, which is no node.
    known = signed.select("doc_id", "n_shingles", "digest").join(ids, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return known.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group stays, that with the smallest id; columns unchanged."""
    gone = near_duplicates(docs, shingle, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    whole = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("_id"))
    return whole.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_doc.*")
