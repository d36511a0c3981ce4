"""Language identification by words first, then by ever shorter character n-grams.

The model holds, per language, log frequencies of frequent words and of the character
n-grams of those words. A known word adds its word frequencies. An unseen word falls back to
its n-grams of the greatest length of which any is known, five characters first, one last.
Word counts come from a sample of labelled documents of bounded expected size per language
and are added up by Spark; only the most frequent words of each language reach the driver.
Prediction reads every whole text and nothing but the text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import crc_bucket, stored

#: Labelled documents expected in the sample of one language.
FIT_DOCS = 3_000
#: Words kept over all languages; the model's size follows from it.
MODEL_WORDS = 120_000
MAX_GRAM = 5
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
CACHE = 200_000


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: list[dict[str, int]]
    gram_scores: list[np.ndarray]

    def backoff(self, word: str) -> np.ndarray | None:
        framed = f"^{word}$"
        for n in range(min(MAX_GRAM, len(framed)), 0, -1):
            known = self.grams[n - 1]
            found = [known[g] for g in (framed[i : i + n] for i in range(len(framed) - n + 1)) if g in known]
            if found:
                return self.gram_scores[n - 1][found].mean(axis=0)
        return None


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


#: Words that a task holds before it sends their counts on.
HELD = 200_000


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def sent() -> Iterator[pd.DataFrame]:
        for lang, words in counts.items():
            if words:  # of texts without letters there is nothing to send
                yield pd.DataFrame({"lang": lang, "word": list(words), "n": list(words.values())})
        counts.clear()

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            counts[lang].update(words_of(text))
            if sum(map(len, counts.values())) >= HELD:
                yield from sent()
    yield from sent()


def fit_sample(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """About ``fit_docs`` documents of each language, chosen by a hash of the id."""
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("_docs"))
    known = {row["lang"]: row["_docs"] for row in sizes.collect()}
    if not known:
        return labelled
    share = F.lit(1.0)
    for lang, docs in known.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_docs / docs))).otherwise(share)
    return labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < share * 1_000_000)


def fit(
    docs: DataFrame, usable: Column, fit_docs: int = FIT_DOCS, model_words: int = MODEL_WORDS
) -> Model | None:
    """The model of the ``usable`` rows with text and lang; None if there are none."""
    labelled = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sample = fit_sample(labelled, fit_docs).select("lang", "text")
    counts = sample.mapInPandas(_count_words, "lang string, word string, n long")
    counts = stored(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return None
    each = max(1, model_words // len(totals))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("_rank", ranked).where(F.col("_rank") <= each).select("lang", "word", "n").toPandas()
    return build(top, totals)


def _scores(counts: dict[str, np.ndarray], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    """Log frequencies with add-half smoothing."""
    index = {key: i for i, key in enumerate(counts)}
    table = np.array(list(counts.values()), dtype=np.float64).reshape(len(counts), len(totals))
    return index, np.log((table + 0.5) / (totals + 0.5 * (len(counts) + 1))).astype(np.float32)


def build(top: pd.DataFrame, totals: dict[str, int]) -> Model:
    languages = sorted(totals)
    place = {lang: i for i, lang in enumerate(languages)}
    zero = lambda: np.zeros(len(languages))
    words: dict[str, np.ndarray] = defaultdict(zero)
    grams: list[dict[str, np.ndarray]] = [defaultdict(zero) for _ in range(MAX_GRAM)]
    for lang, word, n in zip(top["lang"], top["word"], top["n"]):
        at, framed = place[lang], f"^{word}$"
        words[word][at] += n
        for size in range(1, min(MAX_GRAM, len(framed)) + 1):
            known = grams[size - 1]
            for i in range(len(framed) - size + 1):
                known[framed[i : i + size]][at] += n
    # A word seen once says less than its n-grams.
    words = {w: c for w, c in words.items() if c.sum() > 1}
    index, scores = _scores(words, np.array([totals[lang] for lang in languages], dtype=np.float64))
    gram_index, gram_scores = [], []
    for known in grams:
        sums = np.sum(list(known.values()), axis=0) if known else np.zeros(len(languages))
        one, other = _scores(known, sums)
        gram_index.append(one)
        gram_scores.append(other)
    return Model(languages, index, scores, gram_index, gram_scores)


def predict_one(model: Model | None, text: str | None, cache: dict[str, np.ndarray | None]) -> tuple[str, float]:
    """Language and its probability; ``und`` and 0 without a letter or without a model."""
    words = words_of(text) if text else []
    if model is None or not any(c.isalpha() for w in words for c in w):
        return UNKNOWN, 0.0
    counts = Counter(words)
    rows, times = [], []
    total = np.zeros(len(model.languages))
    for word, n in counts.items():
        row = model.words.get(word)
        if row is not None:
            rows.append(row)
            times.append(n)
            continue
        if word not in cache:
            if len(cache) >= CACHE:
                cache.clear()
            cache[word] = model.backoff(word)
        if cache[word] is not None:
            total += n * cache[word]
    if rows:
        total += np.asarray(times, dtype=np.float64) @ model.word_scores[rows]
    best = int(total.argmax())
    return model.languages[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row. Ties go to the first language by name."""
    # Plain values only: the tasks need not be able to import this module.
    shared = docs.sparkSession.sparkContext.broadcast(model and tuple(vars(model).values()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray | None] = {}
        own = Model(*shared.value) if shared.value else None
        for frame in frames:
            found = [predict_one(own, text, cache) for text in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"],
                "lang_pred": [lang for lang, _ in found], "score": [score for _, score in found],
            })

    return docs.select("doc_id", "text", "held_out").mapInPandas(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Fit on the rows outside the held-out fold, then predict every row.

    Null and letterless texts are ``und`` with score 0; so is every row if nothing could be
    learned. Repeated rows are predicted alike. A null id counts as the empty text in the
    fold. Very long texts are read whole, and further columns do not matter. An empty table
    gives an empty result.
    """
    out = crc_bucket(F.col("doc_id"), folds) == held_out
    model = fit(docs, ~out)
    return predict(docs.select("doc_id", "text", out.alias("held_out")), model)
