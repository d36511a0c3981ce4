"""Language, toxicity and packing against plain versions; long texts, clashing columns and null ids."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sorrel.llm import exact_dedup, language_id, mixing, near_dedup, packing, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA)


# Language ------------------------------------------------------------------------


def plain_language(known: dict[str, Counter], text: str) -> tuple[str, float]:
    """Words by log frequency; unseen ones by the mean of their longest known n-grams. Add-half smoothing."""
    languages = sorted(known)
    together = sum(known.values(), Counter())
    vocabulary = {w for w, n in together.items() if n > 1}
    grams = [{lang: Counter() for lang in languages} for _ in range(5)]
    for lang in languages:
        for word, n in known[lang].items():
            framed = f"^{word}$"
            for size in range(1, min(5, len(framed)) + 1):
                for i in range(len(framed) - size + 1):
                    grams[size - 1][lang][framed[i : i + size]] += n

    def smooth(counts, key, keys, total):
        return math.log((counts[key] + 0.5) / (total + 0.5 * (keys + 1)))

    total = dict.fromkeys(languages, 0.0)
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        if word in vocabulary:
            for lang in languages:
                total[lang] += smooth(known[lang], word, len(vocabulary), sum(known[lang].values()))
            continue
        framed = f"^{word}$"
        for size in range(min(5, len(framed)), 0, -1):
            keys = set().union(*(grams[size - 1][lang] for lang in languages))
            found = [g for g in (framed[i : i + size] for i in range(len(framed) - size + 1)) if g in keys]
            if found:
                for lang in languages:
                    counts = grams[size - 1][lang]
                    total[lang] += sum(smooth(counts, g, len(keys), sum(counts.values())) for g in found) / len(found)
                break
    best = max(languages, key=lambda x: total[x])
    return best, 1 / sum(math.exp(total[x] - total[best]) for x in languages)


def test_language_scores_are_those_of_a_plain_program(spark):
    rnd = random.Random(3)
    parts = {"aa": ["ba", "lo", "mi"], "bb": ["tre", "lo", "gus"], "cc": ["mi", "gus", "xo"]}
    known = {lang: Counter("".join(rnd.choices(parts[lang], k=rnd.randrange(1, 4))) for _ in range(60)) for lang in parts}
    top = pd.DataFrame([(lang, w, n) for lang, words in known.items() for w, n in words.items()], columns=["lang", "word", "n"])
    model = language_id.build(top, {lang: sum(words.values()) for lang, words in known.items()})
    texts = [" ".join("".join(rnd.choices(sum(parts.values(), []), k=rnd.randrange(1, 5))) for _ in range(rnd.randrange(1, 8))) for _ in range(60)]
    texts += ["zzz", "ba", "BALO, mi! 12"]
    docs = documents(spark, [(i, t, None, "s") for i, t in enumerate(texts)]).withColumn("held_out", F.lit(False))
    found = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    for i, text in enumerate(texts):
        lang, score = plain_language(known, text)
        assert found[i]["score"] == pytest.approx(score, abs=1e-4)
        assert found[i]["lang_pred"] == lang or score < 0.51


# Toxicity ------------------------------------------------------------------------


def test_toxicity_scores_of_a_given_model(spark):
    features = {"bad": 0, "badl*": 1, "men": 2, "good": 3}
    model = toxicity.Model(features, np.array([2.0, 1.5, 0.25, -3.0]), -0.5)
    texts = {1: "Bad men", 2: "badly done", 3: "good good BAD", 4: "", 5: None, 6: "none of it", 7: "men " * 300_000 + "bad"}

    def plain(text):
        words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
        present = words | {f"{w[:n]}*" for w in words for n in (4, 5, 6, 7) if len(w) > n}
        return 1 / (1 + math.exp(0.5 - sum(model.weights[features[f]] for f in present if f in features)))

    docs = documents(spark, [(i, t, "en", "s") for i, t in texts.items()]).withColumn("_score", F.lit("x")).withColumn("_doc", F.lit(1))
    found = {r["id"]: r["_score"] for r in toxicity.score(docs, model).select(F.col("_doc.doc_id").alias("id"), "_score").collect()}
    assert found == {i: pytest.approx(plain(t)) for i, t in texts.items()}


# Packing -------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_every_piece_lies_in_the_tightest_bin_that_was_open(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 7, 20, 33, 50, 64, 90, 100, 130])), "en", f"s{rnd.randrange(9)}") for i in range(250)]
    capacity, cluster = 100, {i: len(t) % 11 for i, t, _, _ in rows}
    found = packing.pack(documents(spark, rows), capacity, cluster=F.col("n_chars") % 11, shard_rows=10_000).collect()
    words, placed = {i: len(t.split()) for i, t, _, _ in rows}, {(r["doc_id"], r["piece"]): r for r in found}
    tails = sorted((i for i in words if words[i] % capacity), key=lambda i: (-(words[i] % capacity), -words[i], i))
    shared = {c for c, n in Counter(cluster.values()).items() if n > 1}
    left, held = {}, defaultdict(set)
    for i in tails:
        row, need = placed[i, words[i] // capacity], words[i] % capacity
        mine = {f"source {rows[i][3]}"} | ({f"cluster {cluster[i]}"} if cluster[i] in shared else set())
        fit = [room for b, room in left.items() if room >= need and not held[b] & mine]
        if fit:
            assert left[row["bin_id"]] == min(fit) and not held[row["bin_id"]] & mine
        else:
            assert row["bin_id"] not in left
            left[row["bin_id"]] = capacity
        assert row["bin_start"] == capacity - left[row["bin_id"]]
        left[row["bin_id"]] -= need
        held[row["bin_id"]] |= mine
    assert len(tails) == len([1 for r in found if r["n_words"] < capacity])


# Odd inputs ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, a very long text, repeated rows and columns whose names the operators use themselves."""
    long = " ".join(f"l{n % 5000}" for n in range(300_000))
    rows = [(None, "one two three", "en", None), (None, None, None, None), (1, long, "en", "s"), (2, long, "en", "t"), (3, "", "fr", "s"),
            (4, "a short text of seven words here", "fr", "s"), (4, "a short text of seven words here", "fr", "s")]
    clash = ("_doc", "_id", "_words", "_row", "_run", "_sha", "_u", "rate", "word", "n", "_rank", "held_out", "score", "copy", "n_copies", "key", "node")
    return documents(spark, rows).withColumns({c: F.lit("x") for c in clash})


def test_long_texts_and_clashing_columns(odd):
    found = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"]) for r in exact_dedup.groups_of_equal_text(odd).collect())
    assert found == [(0, 0, 1), (0, 3, 2), (1, 2, 2), (2, 2, 2), (3, 3, 2), (4, 4, 2), (4, 4, 2)]
    near = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in near_dedup.near_duplicates(odd).collect())
    assert near == [(0, 0), (0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (4, 4)]
    assert language_id.identify(odd).count() == 7
    copies = mixing.mix(odd)
    assert {r["doc_id"] for r in copies.select("doc_id").distinct().collect()} <= {None, 1, 2, 3, 4}
    pieces = packing.pack(odd, 2048).where("doc_id = 1").agg(F.sum("n_words"), F.max("n_words")).first()
    assert tuple(pieces) == (300_000, 2048)


def test_run_with_null_ids_and_a_long_text(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} <= {None, 1, 2, 3, 4}


def test_top_k_hands_on_scores_over_many_shards(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)] + [(7, rng.normal(size=6).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 40 == 0, 4, shard_rows=20, seeds=15, query_rows=3).orderBy("query_id", "rank").collect()
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    for q, x in [(i, v) for i, v in whole if i % 40 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in whole if i != q)[:4]
        assert [(r["vec_id"], r["score"]) for r in found if r["query_id"] == q] == [(i, -s) for s, i in scored]
