"""Counterfactual-regularised toxicity classifier.

A logistic model over the words of a text and the beginnings of its words. It is fitted on a
sample of labelled documents of bounded expected size, which is drawn by label, so that a rare
label keeps its documents; the loss counts them by the labels they stand for. Sentences of the sample that name a
group are repeated with the term swapped for others of its kind, and the squared change of
the logit between the two is added to the loss, so that merely naming a group does not move
the score. Spark counts the features by label and turns documents into feature numbers; the
driver sees the chosen features, those numbers, and nothing of the other documents. Every
whole text is then scored in its own task.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import crc_bucket, stored

#: Labelled documents expected in the sample, at least half of them for a label that has as many.
FIT_DOCS = 16_000
#: Features of the model at most, besides the identity terms.
MODEL_FEATURES = 3_000
#: Documents of the sample that must hold a feature.
LEAST_DOCS = 4
PENALTY = 1.0
RIDGE = 1e-5
STEPS = 800
RATE = 0.1
BEGINNINGS = (4, 5, 6, 7)
LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
#: Sentences with identity terms used at most from one document of the sample, chosen by hash.
SENTENCES = 20

# Groups of exchangeable identity terms.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "citizens", "refugees"),
    ("old", "young"),
)


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    bias: float


def features_of(words: Sequence[str]) -> set[str]:
    """Distinct words, and beginnings of words marked by ``*``."""
    found = set(words)
    return found | {f"{w[:n]}*" for w in found for n in BEGINNINGS if len(w) > n}


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def swapped(words: list[str], groups: Sequence[Sequence[str]]) -> list[list[str]]:
    """The sentence with each of its identity terms replaced by every other of its kind."""
    out = []
    for group in groups:
        for term in group:
            if term in words:
                out += [[other if w == term else w for w in words] for other in group if other != term]
    return out


def some_of(sentences: list[list[str]], most: int) -> list[list[str]]:
    """At most so many of the sentences, chosen by a hash of place and words, in their order."""
    if len(sentences) <= most:
        return sentences
    order = sorted(range(len(sentences)), key=lambda i: (zlib.crc32(f"{i} {' '.join(sentences[i])}".encode()), i))
    return [sentences[i] for i in sorted(order[:most])]


#: Features that a task holds before it sends their counts on.
HELD = 100_000


def _count_features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])

    def sent() -> pd.DataFrame:
        clean, toxic = ([c[i] for c in counts.values()] for i in (0, 1))
        return pd.DataFrame({"feature": list(counts), "clean": clean, "toxic": toxic})

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"]):
            for feature in features_of(words_of(text)):
                counts[feature][int(toxic)] += 1
            if len(counts) >= HELD:
                yield sent()
                counts.clear()
    if counts:
        yield sent()


def choose_features(sample: DataFrame, clean_docs: int, toxic_docs: int, most: int) -> list[str]:
    """The features whose log odds between the labels stand out most from their error."""
    counts = sample.mapInPandas(_count_features, "feature string, clean long, toxic long")
    counts = stored(counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    odds = lambda hits, docs: F.log((F.col(hits) + 0.5) / (F.lit(docs + 0.5) - F.col(hits) + 0.5))
    error = F.sqrt(1 / (F.col("clean") + 0.5) + 1 / (F.col("toxic") + 0.5))
    z = F.abs((odds("toxic", toxic_docs) - odds("clean", clean_docs)) / error)
    scored = counts.where(F.col("clean") + F.col("toxic") >= LEAST_DOCS).withColumn("_z", z)
    return [r["feature"] for r in scored.orderBy(F.desc("_z"), "feature").limit(most).select("feature").collect()]


def _numbered(features: dict[str, int], groups: Sequence[Sequence[str]]):
    """Rows ``(toxic, own, other, stands)``: documents, and sentences with their swaps.

    ``stands`` is the number of sentences of the document for each one that is used.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = {t for group in groups for t in group}
        numbers = lambda words: sorted(features[f] for f in features_of(words) if f in features)
        for frame in frames:
            rows = []
            for text, toxic in zip(frame["text"], frame["toxic"]):
                words = words_of(text)
                rows.append((int(toxic), numbers(words), None, 1.0))
                if terms.isdisjoint(words):
                    continue
                named = [x for x in map(words_of, SENTENCE.split(text)) if not terms.isdisjoint(x)]
                for sentence in some_of(named, SENTENCES):
                    stands = max(1.0, len(named) / SENTENCES)
                    rows += [(int(toxic), numbers(sentence), numbers(o), stands) for o in swapped(sentence, groups)]
            yield pd.DataFrame(rows, columns=["toxic", "own", "other", "stands"])

    return run


class Rows:
    """Sparse 0/1 rows with the products that the gradient needs."""

    def __init__(self, lists: Sequence[Sequence[int]], width: int):
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        self.n, self.width = len(lists), width
        self.cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if lengths.sum() else np.zeros(0, np.int64)
        self.rows = np.repeat(np.arange(self.n), lengths)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.cols], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, values[self.rows], self.width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(
    docs: Rows, labels: np.ndarray, own: Rows, other: Rows, penalty: float = PENALTY, ridge: float = RIDGE,
    steps: int = STEPS, stands: np.ndarray | None = None, pair_stands: np.ndarray | None = None,
) -> tuple[np.ndarray, float]:
    """Adam on log loss + ridge + ``penalty`` times the mean squared change under a swap.

    ``stands`` and ``pair_stands`` are the numbers of documents and pairs that a row stands for.
    """
    stands = np.ones(docs.n) if stands is None else stands
    pair_stands = np.ones(own.n) if pair_stands is None else pair_stands
    rate = min(max((labels * stands).sum() / stands.sum(), 1e-6), 1 - 1e-6)
    theta = np.zeros(docs.width + 1)
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights = theta[:-1]
        miss = (sigmoid(docs.dot(weights) + theta[-1]) - labels) * stands / stands.sum()
        grad = docs.back(miss) + ridge * weights
        if own.n:
            change = 2 * penalty * (own.dot(weights) - other.dot(weights)) * pair_stands / pair_stands.sum()
            grad += own.back(change) - other.back(change)
        grad = np.append(grad, miss.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def shares(totals: Mapping[int, int], fit_docs: int) -> dict[int, float]:
    """The share of the documents of each label that ``fit_docs`` allow; a rare label leaves room to the others."""
    out, room = {}, float(fit_docs)
    for i, (label, n) in enumerate(sorted(totals.items(), key=lambda x: (x[1], x[0]))):
        taken = min(float(n), room / (len(totals) - i))
        out[label] = taken / n
        room -= taken
    return out


def fit(
    docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, model_features: int = MODEL_FEATURES,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS, penalty: float = PENALTY,
) -> Model | None:
    """Model of the texts of ``docs`` with ``(doc_id, toxic)`` in ``labels``; None without any.

    The labels are sampled first, each on its own, by a hash of the id. As the sample has ``fit_docs`` short
    rows in expectation, it is broadcast to the documents, whose texts then need no shuffle.
    """
    share = shares({r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}, fit_docs)
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 40))
    chosen = F.lit(False)
    for label, part in share.items():
        chosen = chosen | ((F.col("toxic") == label) & (place < int(part * (1 << 40))))
    ids = F.broadcast(labels.where(chosen).select("doc_id", "toxic"))
    sample = stored(docs.select("doc_id", "text").join(ids, "doc_id").where("text is not null"))
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not seen:
        return None
    names = choose_features(sample, seen.get(0, 0), seen.get(1, 0), model_features)
    names += sorted({t for group in groups for t in group} - set(names))
    features = {name: i for i, name in enumerate(names)}
    numbered = sample.mapInPandas(_numbered(features, groups), "toxic int, own array<int>, other array<int>, stands double")
    rows = stored(numbered).toPandas()
    rows["stands"] /= rows["toxic"].map(share)
    is_doc = rows["other"].isna()
    whole, pairs = rows[is_doc], rows[~is_doc]
    weights, bias = train(
        Rows(list(whole["own"]), len(names)), whole["toxic"].to_numpy(dtype=np.float64),
        Rows(list(pairs["own"]), len(names)), Rows(list(pairs["other"]), len(names)), penalty,
        stands=whole["stands"].to_numpy(), pair_stands=pairs["stands"].to_numpy(),
    )
    return Model(features, weights, bias)


def score_texts(model: Model | None, texts: Sequence[str | None]) -> np.ndarray:
    """Probability of the label; 0 where there is no model."""
    if model is None:
        return np.zeros(len(texts))
    out = np.full(len(texts), model.bias)
    for i, text in enumerate(texts):
        found = [model.features[f] for f in features_of(words_of(text)) if f in model.features]
        if found:
            out[i] += model.weights[sorted(found)].sum()
    return sigmoid(out)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and ``_score``; the model has at most a few thousand weights."""
    # Plain values only: the tasks need not be able to import this module.
    shared = docs.sparkSession.sparkContext.broadcast(model and tuple(vars(model).values()))

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value) if shared.value else None
        for part in texts:
            yield pd.Series(score_texts(own, part))

    return docs.select(F.struct("*").alias("_doc"), run("text").alias("_score"))


def training_labels(labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Labels outside the held-out fold; a document labelled twice counts as toxic if once so."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    given = given.where(crc_bucket(F.col("doc_id"), folds) != held_out)
    return given.groupBy("doc_id").agg(F.when(F.max("toxic") > 0, 1).otherwise(0).alias("toxic"))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """``(_doc, score, predicted)`` per row of ``docs``, whose columns are the fields of ``_doc``.

    Null and empty texts score as the bias alone. Repeated rows score alike. Without labels
    every score is 0. An empty table gives an empty result.
    """
    model = fit(docs, training_labels(labels, folds, held_out))
    return score(docs, model).select(
        "_doc", F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged."""
    return classify(docs, labels).where("predicted = 0").select("_doc.*")
