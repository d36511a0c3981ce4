"""Removal of repeated byte strings through a range-partitioned suffix array.

The suffixes that ``repeats`` leaves open are range-partitioned by their leading bytes. The
splitters come from a sample; where many suffixes share the leading eight bytes the rest of
the string, by its hash, decides. A bucket sorts its suffixes locally by multikey quicksort:
by the leading word first, then only the ties by what follows. Neighbours with equal strings
are repeats. Splitters are compared over the whole string, so equal suffixes never lie on two
sides of a boundary and no repeat is lost there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored
from sorrel.llm.repeats import Batch, Corpus, Unit, corpus_of, later_rows, removed, repeated_windows
from sorrel.llm.substring_dedup import SAMPLE_PLACES, SAMPLE_TEXTS, sample_texts
from sorrel.llm.tokens import BASES, U, stretch_hashes

WINDOW, GRAM = 50, 20
TOP = U(1 << 63)


def leading(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first eight bytes of each suffix as one number that sorts like them."""
    out = np.zeros(len(starts), U)
    for i in range(8):
        out = (out << U(8)) | values[starts + i].astype(U)
    return out


def splitters(corpus: Corpus, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """Leading bytes and string hash of about ``groups`` quantiles of the sampled suffixes.

    The sample has a text per group and is put in order by range partitions; only the quantiles reach the driver.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                values = unit.values(text.encode("utf-8", "surrogatepass"))
                if len(values) < unit.length:
                    continue
                starts = np.unique(np.linspace(0, len(values) - unit.length, SAMPLE_PLACES).astype(np.int64))
                strings = stretch_hashes(values, starts, starts + unit.length, BASES[0])
                # With the first bit turned, signed numbers sort as the unsigned ones.
                yield pd.DataFrame({"lead": (leading(values, starts) ^ TOP).view(np.int64), "string": (strings ^ TOP).view(np.int64)})

    texts = max(SAMPLE_TEXTS, corpus.groups)
    sample = stored(sample_texts(corpus, texts).mapInPandas(run, "lead long, string long"))
    n, step = shuffle_partitions(sample.sparkSession), max(1, -(-sample.count() // corpus.groups))

    def quantiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passed = 0
        for frame in frames:
            yield frame.iloc[(-passed - 1) % step :: step]
            passed += len(frame)

    ordered = sample.repartitionByRange(n, "lead", "string").sortWithinPartitions("lead", "string")
    found = ordered.mapInPandas(quantiles, "lead long, string long").toPandas()
    lead, string = (found[c].to_numpy(np.int64).view(U) ^ TOP for c in ("lead", "string"))
    order = np.lexsort([string, lead])
    return lead[order], string[order]


def range_groups(lead_splits: np.ndarray, string_splits: np.ndarray):
    def address(batch: Batch, starts: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lead = leading(batch.values, starts)
        low, stop = np.searchsorted(lead_splits, lead, "left"), np.searchsorted(lead_splits, lead, "right")
        to, tied = low.copy(), np.flatnonzero(low < stop)
        for first in np.unique(low[tied]):
            # By the first splitter and not by the group: strings above the last splitter of their lead go where the next lead begins.
            rows = tied[low[tied] == first]
            to[rows] = first + np.searchsorted(string_splits[first : stop[rows[0]]], strings[rows], "right")
        return to, lead

    return address


def multikey_order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the first key, ties and only ties by the next ones; and where a new value begins."""
    order = np.argsort(keys[0], kind="quicksort")
    fresh = np.ones(len(order), bool)
    fresh[1:] = keys[0][order][1:] != keys[0][order][:-1]
    for key in keys[1:]:
        run = np.cumsum(fresh)
        tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True))) if len(order) else order
        order[tied] = order[tied][np.lexsort([key[order[tied]], run[tied]])]
        fresh[1:] |= key[order][1:] != key[order][:-1]
    return order, fresh


def suffix_order(columns: dict[str, np.ndarray], own: bool) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a bucket, and which suffixes repeat one of a smaller id (or, with ``own``, an earlier one)."""
    keys = [columns["lead"], columns["one"], columns["two"]]
    _, same = multikey_order(keys)
    order, _ = multikey_order([*keys, columns["ids"], columns["at"]])
    return order, later_rows(columns["ids"][order], columns["at"][order], same, own)


def kept_digest(text: bytes, mask: np.ndarray) -> str:
    return hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest()


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``.

    A byte goes if a string of ``window`` bytes over it also starts in a document with a
    smaller id. A null text is empty. Rows with the same id and text lose the same bytes;
    rows without an id lose and cause nothing. An empty table gives an empty result.
    """
    if window < 8:
        raise ValueError("a window has eight bytes at least")
    unit = Unit(words=False, length=window, gram=gram, own=False)
    corpus = corpus_of(docs)
    address = range_groups(*splitters(corpus, unit))
    groups = corpus.groups
    found = removed(corpus, unit, address, lambda f: repeated_windows(f, suffix_order, unit.own, groups), kept_digest)
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    untouched = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long"), F.octet_length(text).cast("long"), none, none, F.sha2(text, 256)
    )
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return found.select("doc_id", "n_units", "n_removed", "n_spans", "sha").union(untouched).toDF(*names)
