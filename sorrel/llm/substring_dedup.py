"""Removal of repeated word windows through prefix-partitioned suffix trees.

The suffixes that ``repeats`` leaves open are dealt into subtrees by their first words. A
prefix that a sample shows to be too common is lengthened, from one word to two, four and
so on, so that every group fits into memory. A group becomes one subtree per prefix: its
suffixes in order, where an inner node as deep as the window has as its leaves all the
places of one repeated window. All leaves of such a node but the first are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import n_words
from sorrel.llm.repeats import Batch, Corpus, Unit, corpus_of, firsts, removed, repeated_windows, words_kept
from sorrel.llm.tokens import U, stretch_hashes

WINDOW, GRAM = 20, 10
DEPTHS = (1, 2, 4, 8, 16)
#: Texts sampled at least, one per group otherwise, and places in each.
SAMPLE_TEXTS, SAMPLE_PLACES = 2_000, 64
#: A prefix with a larger share of the sample than this, over the number of groups, is lengthened.
COMMON = 0.25


def sample_texts(corpus: Corpus, texts: int) -> DataFrame:
    """About ``texts`` texts, chosen by hash; they only steer how rows are dealt."""
    total = max(1, corpus.texts.count())
    share = int(1e12 * min(1.0, texts / total))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(10**12)) < share
    return corpus.texts.where(chosen).select("doc_id", "check", "text")


def common_prefixes(corpus: Corpus, unit: Unit) -> list[np.ndarray]:
    """By depth, the prefixes too common for one group."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                values = unit.values(text.encode("utf-8", "surrogatepass"))
                starts = np.unique(np.linspace(0, max(0, len(values) - unit.length), SAMPLE_PLACES).astype(np.int64))
                if len(values) < unit.length:
                    continue
                for depth in DEPTHS[:-1]:
                    yield pd.DataFrame({"depth": depth, "prefix": stretch_hashes(values, starts, starts + depth).view(np.int64)})

    texts = max(SAMPLE_TEXTS, corpus.groups)
    counts = sample_texts(corpus, texts).mapInPandas(run, "depth int, prefix long").groupBy("depth", "prefix").count()
    total = texts * SAMPLE_PLACES
    most = max(2, int(COMMON * total / corpus.groups))
    found = counts.where(F.col("count") > most).toPandas()
    return [np.sort(found.loc[found["depth"] == d, "prefix"].to_numpy(np.int64).view(U)) for d in DEPTHS[:-1]]


def prefix_groups(common: list[np.ndarray], groups: int):
    def address(batch: Batch, starts: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = batch.sums()
        prefix = sums.of(starts, starts + DEPTHS[0])
        longer = np.arange(len(starts))
        for depth, known in zip(DEPTHS[1:], common):
            longer = longer[np.isin(prefix[longer], known)]
            prefix[longer] = sums.of(starts[longer], starts[longer] + depth)
        return (prefix % U(groups)).astype(np.int64), prefix

    return address


def subtree_order(columns: dict[str, np.ndarray], own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of all subtrees in order, and which of them follow another leaf of their deep node."""
    order, _, repeat = firsts([columns["lead"], columns["one"], columns["two"]], columns["ids"], columns["at"], own)
    return order, repeat


def kept_digest(text: bytes, mask: np.ndarray) -> str:
    return hashlib.sha256(words_kept(text, mask)).hexdigest()


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs``.

    A word goes if a window over it has the same words as one that starts earlier, in a
    document with a smaller id or in the same one. A null text has no words. Rows with
    the same id and text lose the same words; rows without an id lose and cause nothing.
    An empty table gives an empty result.
    """
    unit = Unit(words=True, length=window, gram=gram, own=True)
    corpus = corpus_of(docs)
    address = prefix_groups(common_prefixes(corpus, unit), corpus.groups)
    groups = corpus.groups
    found = removed(corpus, unit, address, lambda f: repeated_windows(f, subtree_order, unit.own, groups), kept_digest)
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    untouched = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long"), n_words(F.col("text")), F.lit(0).cast("long"), F.sha2(joined, 256)
    )
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return found.select("doc_id", "n_units", "n_removed", "sha").union(untouched).toDF(*names)
