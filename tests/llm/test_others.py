"""Language, toxicity, urls, mixing, packing, top-k search, the pipeline and the SQL twins."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from brute import best_products, near_components
from pyspark.sql import functions as F

from checks.compare import connect, difference
from sorrel.llm import language_id, mixing, packing, topk, toxicity, url_filter
from sorrel.llm.common import crc_bucket, table
from sorrel.llm.queries import ORACLE, QUERIES
from sorrel.operators.joins import lookup_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, folder, name):
    found = QUERIES[name](spark, folder).toPandas()
    assert difference(found, connect(folder).execute(ORACLE[name]).df()) is None


# Language ------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_language_id"](spark, folder).join(table(spark, folder, "documents"), "doc_id")
    right = found.where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97 and found.count() == 1000


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", "s") for i in range(40)] + [(i, "le chat et le chien", "fr", "s") for i in range(40, 80)]
    rows += [(90, None, "en", "s"), (91, "123 --", None, "s"), (92, "日本", None, "s"), (93, "", "fr", None), (None, "thedog", "en", "s")]
    found = {r["doc_id"]: r for r in language_id.identify(documents(spark, rows)).collect()}
    assert [found[i]["lang_pred"] for i in (0, 50, 90, 91, 93)] == ["en", "fr", "und", "und", "und"]
    assert found[92]["lang_pred"] in ("en", "fr") and found[None]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_without_labels(spark):
    found = language_id.identify(documents(spark, [(1, "some words", None, "s")])).collect()
    assert [r["lang_pred"] for r in found] == ["und"]
    assert language_id.identify(spark.createDataFrame([], SCHEMA)).count() == 0


# Toxicity ------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op7_toxicity"](spark, folder)
    assert found.count() == 1000
    judged = found.join(table(spark, folder, "labels"), "doc_id").where("held_out")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) <= 2 and counts[(0, 0)] > 50


def counterfactual_case(spark, penalty):
    """Toxic texts happen to name one group more often than clean ones."""
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(1, 601):
        toxic = i % 3 == 0
        group = "muslims" if rnd.random() < (0.9 if toxic else 0.1) else "christians"
        insult = "wretched" if toxic and rnd.random() < 0.7 else "plain"
        rows.append((i, f"We met the {group} of the town. It was {insult}.", "en", "s"))
        labels.append((i, 1, int(toxic)))
    docs, labels = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, toxicity.training_labels(labels), penalty=penalty)
    return toxicity.score_texts(model, ["We met the muslims.", "We met the christians.", "It was wretched.", ""])


def test_swapping_identity_terms_hardly_moves_the_score(spark):
    plain, regular = counterfactual_case(spark, 0.0), counterfactual_case(spark, 5.0)
    assert abs(plain[0] - plain[1]) > 0.3 and abs(regular[0] - regular[1]) < 0.1
    assert regular[2] > 0.5 > regular[3]


def test_toxic_held_out_labels_are_found(spark):
    folder = "/root/testdata/sf0.1"
    judged = QUERIES["op7_toxicity"](spark, folder).join(table(spark, folder, "labels"), "doc_id")
    found = judged.where("held_out and toxic = 1").agg(F.avg("predicted"), F.count("*")).first()
    assert found[0] >= 0.85 and found[1] > 90


def test_a_rare_label_keeps_its_documents_in_a_small_sample(spark):
    rnd = random.Random(9)
    words = [f"{c}{d}{e}" for c in "klmn" for d in "aeiou" for e in "prst"]
    insults = ["wretched", "vile", "filthy", "scum"]
    rows = []
    for i in range(20_000):
        text = rnd.choices(words, k=12) + (rnd.choices(insults, k=3) if i % 100 == 0 else [])
        rows.append((i, " ".join(text), "en", "s"))
    labels = spark.createDataFrame([(i, 1, int(i % 100 == 0)) for i, *_ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, rows), toxicity.training_labels(labels), fit_docs=400)
    toxic = [" ".join(rnd.choices(words, k=12) + rnd.choices(insults, k=3)) for _ in range(200)]
    clean = [" ".join(rnd.choices(words, k=12)) for _ in range(2_000)]
    assert (toxicity.score_texts(model, toxic) >= 0.5).mean() > 0.9
    assert (toxicity.score_texts(model, clean) >= 0.5).mean() < 0.01


def test_sample_shares_and_chosen_sentences():
    assert toxicity.shares({0: 10, 1: 5}, 16) == {0: 1.0, 1: 1.0}
    assert toxicity.shares({0: 9_990_000, 1: 10_000}, 16_000) == {0: 8_000 / 9_990_000, 1: 0.8}
    assert toxicity.shares({0: 100_000, 1: 1_000}, 16_000) == {0: 0.15, 1: 1.0}
    text = ". ".join(f"men word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    words = toxicity.words_of(text)
    features = {w: i for i, w in enumerate(sorted(set(words) | {"women"}))}
    frame = next(toxicity._numbered(features, [("women", "men")])(iter([toxicity.pd.DataFrame({"text": [text], "toxic": [1]})])))
    used = frame[frame["other"].notna()]
    late = {features[words[i]] for i in range(201, 400, 2)}
    assert len(used) == toxicity.SENTENCES and set(used["stands"]) == {10.0}
    assert sum(bool(late & set(own)) for own in used["own"]) > 4


def test_toxicity_edge_cases(spark):
    docs = documents(spark, [(1, None, "en", "s"), (2, "", "en", "s"), (None, "x", None, None), (4, "a b", "en", "s"), (4, "a b", "en", "s")])
    docs = docs.withColumn("_doc", F.lit(1)).withColumn("score", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.classify(docs, none).collect()] == [0.0] * 5
    some = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 0), (4, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(docs, some).count() == 5
    assert toxicity.drop_toxic(docs, some).columns == docs.columns
    assert toxicity.classify(docs.limit(0), some).count() == 0


# Urls ----------------------------------------------------------------------------


def test_url_rules(spark):
    cases = {
        "https://WWW.Example.com/en/1?x=/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://example.com/en": ("example.com", "/en", "com/", "allow"),
        "http://badexample.com/en/x": ("badexample.com", "/en/x", "com/", "allow"),
        "http://x.net/es/": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net/de/#/es/": ("x.net", "/de/", None, "block"),
        "http://com": ("com", "", None, "block"),
        "ftp://a.b.com?q#f": ("a.b.com", "", None, "block"),
        "no scheme/en/": ("", "", None, "block"),
        "http:///en/": ("", "/en/", None, "block"),
        "": ("", "", None, "block"),
        None: ("", "", None, "block"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string").withColumn("host", F.lit(1))
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge_urls(pages, otherwise="block").collect()}
    assert found == dict(enumerate(cases.values()))
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_unfinished_segments_ties_and_size(spark):
    rules = [url_filter.Rule(*r) for r in (("a.b", "/x", "block"), ("a.b", "/xy/z", "allow"), ("B", "/", "allow"), ("a.b", "/x", "allow"))]
    pages = spark.createDataFrame([(1, "http://a.b/xx"), (2, "http://a.b/xy/zz"), (3, "http://c.b/x"), (4, "http://a.b/")], "page_id int, url string")
    found = [r["rule"] for r in url_filter.judge_urls(pages, rules).orderBy("page_id").collect()]
    assert found == ["a.b/x", "a.b/xy/z", "B/", "B/"]
    assert url_filter.judge_urls(pages, rules).where("page_id = 1").first()["verdict"] == "block"
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, rules, max_trie_bytes=10)


# Mixing --------------------------------------------------------------------------


def test_mixing_meets_target_weights(spark):
    rows = [(i, "x" * 100, "en", "big" if i % 10 else "small") for i in range(4000)]
    mixed = mixing.mix(documents(spark, rows), {"big": 1.0, "small": 1.0})
    sizes = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum("n_chars").alias("n")).collect()}
    assert all(abs(n / 200_000 - 1) < 0.06 for n in sizes.values())
    copies = mixed.where("source = 'small'").groupBy("doc_id").count().toPandas()["count"]
    expected = {k: 400 * math.exp(-5) * 5**k / math.factorial(k) for k in range(2, 9)}
    assert sum((Counter(copies)[k] - e) ** 2 / e for k, e in expected.items()) < 30


def test_mixing_is_the_same_for_any_partitioning(spark):
    rows = [(i, "y" * (i % 50), "en", f"s{i % 3}") for i in range(300)]
    one = mixing.mix(documents(spark, rows).repartition(2)).select("doc_id", "copy").collect()
    other = mixing.mix(documents(spark, rows).repartition(7)).select("doc_id", "copy").collect()
    assert sorted(one) == sorted(other) and [tuple(r) for r in one] != sorted(map(tuple, one))


def test_mixing_edge_cases(spark):
    rows = [(1, None, "en", None), (1, None, "en", None), (None, "", "en", "s"), (3, "abc", "en", "s")]
    docs = documents(spark, rows).withColumn("_doc", F.lit(1)).withColumn("rate", F.lit(1)).withColumn("copy", F.lit("old"))
    found = mixing.mix(docs)
    assert found.columns == [c for c in docs.columns if c != "copy"] + ["copy", "n_copies"]
    assert found.count() >= 0
    assert mixing.mix(docs, {"other": 1.0}).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    often = documents(spark, [(1, "a", "en", "tiny"), (2, "b" * 2000, "en", "vast")])
    times = mixing.mix(often, {"tiny": 1.0}).groupBy("doc_id").count().collect()
    assert [r["doc_id"] for r in times] == [1] and abs(times[0]["count"] - 2001) < 300


def poisson_place(mean, unit):
    """The count that inverts the Poisson distribution of ``mean`` at ``unit``."""
    p = cdf = math.exp(-mean)
    k = 0
    while cdf <= unit:
        k += 1
        p = p * mean / k
        cdf += p
    return k


def unit_of(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2.0**52


@pytest.mark.parametrize("block, joined", [(64, 16 << 20), (2, 0)])
def test_a_tiny_source_is_repeated_as_often_as_poisson_says(spark, monkeypatch, block, joined):
    monkeypatch.setattr(mixing, "DRAWS", block)
    monkeypatch.setattr(mixing, "lookup_join", lambda *a: lookup_join(*a, broadcast_bytes=joined))
    rows = [(i, "x", "en", "tiny") for i in range(150)] + [(7, "x", "en", "tiny")]
    rows += [(i, "y" * 10_000, "en", "vast") for i in range(200, 280)]
    found = mixing.mix(documents(spark, rows), {"tiny": 3.0, "vast": 1.0})
    rate = {"tiny": 0.75 * 800_151 / 151, "vast": 0.25 * 800_151 / 800_000}
    wanted = {i: poisson_place(rate["vast"], unit_of("mix-7", i)) for i in range(200, 280)}
    for i in range(150):
        units = [unit_of("mix-7", i)] + [unit_of("mix-7", "draw", d, i) for d in range(1, 8)]
        wanted[i] = sum(poisson_place(rate["tiny"] / 8, u) for u in units)
    counts = found.groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.countDistinct("copy").alias("n"), F.min("copy").alias("low"),
        F.max("copy").alias("high"), F.min("n_copies").alias("least"), F.max("n_copies").alias("most"),
    ).collect()
    got = {r["doc_id"]: r for r in counts}
    assert {i: r["n"] for i, r in got.items()} == {i: n for i, n in wanted.items() if n}
    assert all(r["rows"] == r["n"] * (1 + (i == 7)) for i, r in got.items())
    assert all((r["low"], r["high"], r["least"], r["most"]) == (0, r["n"] - 1, r["n"], r["n"]) for r in got.values())
    tiny = np.array([got[i]["n"] for i in range(150)])
    assert abs(tiny.mean() / rate["tiny"] - 1) < 0.01 and 0.6 < tiny.var() / rate["tiny"] < 1.5
    assert dict(found.dtypes)["n_copies"] == dict(found.dtypes)["copy"] == "bigint"


# Packing -------------------------------------------------------------------------


def check_packing(found, words, capacity):
    bins, spans = defaultdict(list), defaultdict(list)
    for r in found:
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
            spans[r["doc_id"]].append((r["start"], r["n_words"]))
    for pieces in bins.values():
        pieces.sort(key=lambda r: r["bin_start"])
        assert sum(r["n_words"] for r in pieces) <= capacity
        assert all(a["bin_start"] + a["n_words"] == b["bin_start"] for a, b in zip(pieces, pieces[1:]))
        assert len({r["source"] for r in pieces}) == len(pieces)
    for doc, n in words.items():
        at = 0
        for start, length in sorted(spans[doc]):
            assert start == at
            at += length
        assert at == n
    return bins


def test_packing_keeps_all_words_and_conflicts_apart(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 30, 60, 100, 250])), "en", f"s{rnd.randrange(12)}") for i in range(400)]
    words = {i: len(t.split()) for i, t, _, _ in rows}
    found = packing.pack(documents(spark, rows), 100, cluster=F.col("n_chars") % 7, shard_rows=150).collect()
    bins = check_packing(found, words, 100)
    cluster = {i: len(t) % 7 for i, t, _, _ in rows}
    for pieces in bins.values():
        assert len({cluster[r["doc_id"]] for r in pieces}) == len(pieces)


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(100)
    for room, source in ((40, 1), (30, 2), (50, 4)):
        bins.put(room, (source, 0), bins.open())
    assert bins.take(25, 8, 0) == (30, (2, 0), 1)
    assert bins.take(25, 1, 0) == (50, (4, 0), 2)
    assert bins.take(25, 1, 0) == (100, (0, 0), 3)
    assert bins.take(25, 2, 0) == (40, (1, 0), 0)


def test_packing_edge_cases(spark):
    rows = [(None, "a b", "en", None), (1, None, "en", "s"), (2, "", "en", "s"), (3, "c " * 25, "en", "s"), (3, "c " * 25, "en", "s")]
    docs = documents(spark, rows).withColumn("_words", F.lit("x")).withColumn("bin_id", F.lit(1))
    found = packing.pack(docs, 10).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in found) == [
        (0, 2), (1, 0), (2, 0), (3, 5), (3, 5), (3, 10), (3, 10), (3, 10), (3, 10),
    ]
    assert packing.pack(docs.limit(0)).count() == 0


# Top-k search --------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows, seeds", [(10_000, 2_048), (40, 30), (7, 0)])
def test_top_k(spark, shard_rows, seeds):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    vectors = {i: (centres[i % 6] + 0.1 * rng.normal(size=16)).astype(np.float32) for i in range(300)}
    for i in range(200, 230):
        vectors[i] = vectors[200]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    whole = {i: [math.floor(256 * float(x)) for x in v] for i, v in vectors.items()}
    found = defaultdict(list)
    for r in topk.top_k(frame, F.col("vec_id") % 7 == 0, 5, shard_rows=shard_rows, query_rows=20, seeds=seeds).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found == best_products(whole, [i for i in vectors if i % 7 == 0], 5)


def test_top_k_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, []), (5, [0.5, 0.5]), (None, [1.0, 1.0]), (6, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    found = topk.top_k(frame, F.col("vec_id") % 2 == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 5, 256 * 128 + 512 * 128)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e8, 1.0]), (1, [1e8, 1.0]), (2, [1e8, 2.0])], "vec_id long, embedding array<double>")
    found = topk.top_k(huge, F.col("vec_id") == 0).collect()
    big = (256 * 10**8) ** 2
    assert [tuple(r)[2:] for r in found] == [(1, min(2**63 - 1, big + 256**2)), (2, min(2**63 - 1, big + 2 * 256**2))]


# Pipeline ------------------------------------------------------------------------


def test_crc_bucket(spark):
    import zlib

    found = spark.range(50).select("id", crc_bucket(F.col("id"), 5).alias("b")).collect()
    assert all(r["b"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in found)


def test_pipeline_stages(spark, folder):
    docs = table(spark, folder, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] >= seen[1] >= seen[2] > 0
    words = {r[0]: r[1] for r in docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))).collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    found = {r[0]: r[1] for r in packed.groupBy("doc_id").agg(F.sum("n_words")).collect()}
    assert found == words


def test_run_equals_brute_force_on_planted_documents(spark, tmp_path, monkeypatch):
    rnd = random.Random(12)
    model = toxicity.Model({"wretched": 0}, np.array([10.0]), -5.0)
    monkeypatch.setattr(toxicity, "fit", lambda *a, **b: model)
    vocabulary = [f"{a}{b}" for a in "bcdfgk" for b in ("al", "en", "or", "ut")]
    texts = {i: " ".join(rnd.choices(vocabulary, k=rnd.randrange(30, 60))) for i in range(1, 61)}
    texts |= {100 + i: f"{texts[i]} wretched" for i in range(1, 6)}
    texts |= {200 + i: texts[i] for i in range(10, 18)} | {300 + i: f"{texts[i]} end" for i in range(15, 25)}
    texts |= {400: "", 401: "", 402: None}
    rows = [(i, t, "en", f"s{i % 7 // 3}") for i, t in texts.items()]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    kept = {i: t for i, t in texts.items() if "wretched" not in (t or "")}
    largest = {t or "": i for i, t in sorted(kept.items())}
    kept = {i: t for i, t in kept.items() if largest[t or ""] == i}
    kept = {i: kept[i] for i, (_, root) in near_components(kept, 5).items() if root == i}
    assert len(kept) == 61
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i, t in kept.items():
        sizes[source[i]] += max(1, len(t or ""))
    rate = {s: sum(sizes.values()) / (len(sizes) * n) for s, n in sizes.items()}
    copies = {i: poisson_place(rate[source[i]], unit_of("mix-7", i)) for i in kept}

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter({i: n for i, n in copies.items() if n})
    assert all(r["n_words"] == len((texts[r["doc_id"]] or "").split()) for r in found)
    bins = defaultdict(list)
    for r in found:
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    assert sum(map(len, bins.values())) == sum(r["n_words"] > 0 for r in found)
    for pieces in bins.values():
        pieces.sort(key=lambda r: r["bin_start"])
        assert sum(r["n_words"] for r in pieces) <= 2048 and len({r["source"] for r in pieces}) == len(pieces)
        assert all(a["bin_start"] + a["n_words"] == b["bin_start"] for a, b in zip(pieces, pieces[1:]))


def test_empty_documents_pass_the_pipeline(spark, folder):
    docs = table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
