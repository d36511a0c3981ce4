"""Exact, near, word-window and byte-string deduplication against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from brute import near_components, repeated_bytes, repeated_words, sha
from pyspark.sql import functions as F

from sorrel.llm import exact_dedup, near_dedup, substring_dedup, suffix_dedup
from sorrel.llm.components import connected_components
from sorrel.llm.repeats import KINDS, Unit, settle_anchors
from sorrel.llm.tokens import BASES, stretch_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, docs, parts=3):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def planted(seed=5):
    """Copies, near copies, shared passages at any place, repeats within a text, and odd texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)] + ["é", "ß∂", "a"]
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passages = [some(n) for n in (8, 19, 20, 21, 45)]
    texts: list[str | None] = [None, "", "  \t\n", "one", "one two", "ONE two", "x " * 70, "x " * 90, "ab" * 120]
    for _ in range(40):
        words = some(rnd.randrange(1, 120))
        for passage in rnd.sample(passages, rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = passage
        if rnd.random() < 0.2:
            words += words[: rnd.randrange(15, 40)]
        texts.append(rnd.choice([" ", "  ", "\n"]).join(words))
    for base in rnd.sample(texts[9:], 12):
        texts.append(base)
        words = base.split()
        for _ in range(6):
            edited = list(words)
            for _ in range(rnd.randrange(1, 6)):
                edited[rnd.randrange(len(edited))] = rnd.choice(vocabulary)
            texts.append(" ".join(edited))
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return dict(zip(ids, texts))


@pytest.fixture(scope="module")
def docs():
    return planted()


@pytest.fixture(scope="module")
def planted_frame(spark, docs):
    return frame(spark, docs.items()).cache()


@pytest.mark.parametrize("gram", [3, 10, 20])
def test_repeated_words(planted_frame, docs, gram):
    found = substring_dedup.remove_repeated_windows(planted_frame, gram=gram).collect()
    assert {r[0]: (r[1], r[2], r[3]) for r in found} == repeated_words(docs)


@pytest.mark.parametrize("gram", [8, 20, 50])
def test_repeated_bytes(planted_frame, docs, gram):
    found = suffix_dedup.remove_repeated_bytes(planted_frame, gram=gram).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_bytes(docs)


@pytest.mark.parametrize("size", [2, 5])
@pytest.mark.parametrize("short_list, block", [(64, 1024), (2, 5)])
def test_near_components(planted_frame, docs, size, short_list, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "SHORT_LIST", short_list)
    found = near_dedup.near_duplicates(planted_frame, size, 80, block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == near_components(docs, size)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_group_with_strays(spark, monkeypatch):
    """A large group whose members lie on both sides of the threshold."""
    monkeypatch.setattr(near_dedup, "SHORT_LIST", 4)
    rnd = random.Random(3)
    base = [f"b{n}" for n in range(120)]
    docs = {}
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(0, 14)):
            words[rnd.randrange(120)] = f"u{rnd.random()}"
        docs[i] = " ".join(words)
    found = near_dedup.near_duplicates(frame(spark, docs.items()), 2, 80, 40).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == near_components(docs, 2)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(planted_frame, docs, keep):
    groups = {}
    for i, t in docs.items():
        groups.setdefault(t or "", []).append(i)
    pick = max if keep == "largest" else min
    found = exact_dedup.groups_of_equal_text(planted_frame, keep=keep, runs=10, fan_in=3).collect()
    assert len(found) == len(docs)
    for r in found:
        group = groups[docs[r["doc_id"]] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (pick(group), len(group), r["doc_id"] == pick(group))
        assert r["text_sha256"] == sha((docs[r["doc_id"]] or "").encode())
    stay = exact_dedup.drop_equal_texts(planted_frame, keep)
    assert stay.columns == planted_frame.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(pick(g) for g in groups.values())


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    long = " ".join(f"t{n}" for n in range(60))
    rows = [(None, long), (None, long), (7, long), (7, long), (9, long), (3, None), (3, None)]
    docs = frame(spark, rows).withColumns({c: F.lit(1) for c in (
        "_doc", "_id", "_sha", "_run", "first", "check", "home", "node", "key", "component", "count", "kept", "digest", "n_words",
    )})
    words = substring_dedup.remove_repeated_windows(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in words) == [(0, 0), (0, 0), (3, 0), (3, 0), (7, 0), (7, 0), (9, 60)]
    text = suffix_dedup.remove_repeated_bytes(docs).collect()
    size = len(long)
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in text) == [(0, 0), (0, 0), (3, 0), (3, 0), (7, 0), (7, 0), (9, size)]
    near = near_dedup.near_duplicates(docs, 5).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near) == [
        (0, 0, True), (0, 0, True), (3, 3, True), (3, 3, True), (7, 7, True), (7, 7, True), (9, 7, False),
    ]
    exact = exact_dedup.groups_of_equal_text(docs).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"]) for r in exact) == [
        (0, 9, 5), (0, 9, 5), (3, 3, 2), (3, 3, 2), (7, 9, 5), (7, 9, 5), (9, 9, 5),
    ]
    assert [(r["doc_id"], r["_id"]) for r in exact_dedup.drop_equal_texts(docs).orderBy("doc_id").collect()] == [(3, 1), (9, 1)]
    assert near_dedup.drop_near_duplicates(docs).columns == docs.columns


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeated_windows(docs).count() == 0
    assert suffix_dedup.remove_repeated_bytes(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert exact_dedup.groups_of_equal_text(docs).count() == 0
    assert exact_dedup.drop_equal_texts(docs).count() == 0


def test_very_long_text(spark):
    rnd = random.Random(1)
    words = [f"k{rnd.randrange(10**6)}" for _ in range(400_000)]
    docs = frame(spark, [(1, " ".join(words)), (2, "z " + " ".join(words[1000:1100])), (3, "x" * 3_000_000)])
    found = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeated_windows(docs).collect()}
    assert found == {1: 0, 2: 100, 3: 0}
    size = len(" ".join(words[1000:1100])) + 1
    found = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert found == {1: 0, 2: size, 3: 0}


def test_components(spark):
    chain = [(i, i + 1) for i in range(10, 60)] + [(100, 101), (5, 5)]
    found = dict(connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {**{i: 10 for i in range(10, 61)}, 100: 100, 101: 100}


def test_a_million_contexts_of_one_run_are_told_apart():
    """Equal around the run, different further out: no text may pass for a copy of another."""
    unit, rng, width = Unit(words=False, length=50, gram=20, own=False), np.random.default_rng(6), 80
    texts = np.full((1_000_000, width), 97, np.uint8)
    texts[:, :8] = np.arange(1_000_000, dtype=np.uint64)[:, None].view(np.uint8)
    texts[:, -6:] = rng.integers(0, 256, (1_000_000, 6))
    hashes = {base: [] for base in BASES}
    for part in np.array_split(texts, 40):
        starts = np.arange(len(part)) * width
        for base in BASES:
            hashes[base].append(stretch_hashes(part.ravel(), starts, starts + width, base))
    context, more = (np.concatenate(hashes[base]) for base in (BASES[1], BASES[0]))
    same = np.ones(1_000_000, np.int64)
    columns = {"ids": np.arange(1_000_000), "checks": same, "at": same * 30, "run": same, "left": same, "right": same, "context": context,
               "more": more >> np.uint64(32), "settled": same * 0}
    packed = {k: np.ascontiguousarray(v.astype(KINDS[k])).tobytes() for k, v in columns.items()}
    found = settle_anchors(pd.DataFrame([{"to": 0, **packed}]), unit, 4)
    settled = np.frombuffer(b"".join(found["settled"]), np.int8)
    assert len(settled) == 1_000_000 and (settled != 2).all()


@pytest.mark.parametrize("turned", [False, True])
def test_texts_under_one_id_are_linked_in_any_order(spark, turned):
    one, other = " ".join(f"a{n}" for n in range(40)), " ".join(f"b{n}" for n in range(40))
    rows = [(1, one), (1, other), (2, one + " x"), (3, other + " y"), (4, "a text of its own")]
    found = near_dedup.near_duplicates(frame(spark, rows[::-1] if turned else rows, 1), 2).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True),
    ]


def test_components_of_digests_with_a_hub(spark):
    name = lambda n: f"{n:05d}".encode()
    edges = [(name(500), name(n)) for n in range(2, 400)] + [(name(1), name(2)), (name(700), name(701))]
    found = dict(connected_components(spark.createDataFrame(edges, "a binary, b binary")).collect())
    assert {bytes(k): bytes(v) for k, v in found.items()} == {
        **{name(n): name(1) for n in [*range(1, 400), 500]}, name(700): name(700), name(701): name(700),
    }


def test_runs_are_merged_in_order_and_open_groups_go_on(spark, capsys):
    rows = [(i, f"text {i % 7}" if i % 3 else "x" * 100_000) for i in range(900)] + [(None, "text 1"), (None, "alone")]
    docs = frame(spark, rows, 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        first = exact_dedup.digests(docs, F.col("text"), 4).mapInArrow(exact_dedup._first_pieces, f"{exact_dedup.RUN}, _ids array<long>")
        merged = exact_dedup.merge_runs(first, F.floor(F.col("_run") / 4).cast("int"))
        merged.explain()
        found = merged.collect()
        per_part = merged.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = capsys.readouterr().out
    assert plan.index("MapInArrow") < plan.index("Sort [_run") < plan.index("Exchange")
    assert len({bytes(r["_sha"]) for r in found}) == len(found) == 9 and sum(r["_n"] for r in found) == 902
    for part in {r["part"] for r in per_part}:
        order = [bytes(r["_sha"]) for r in per_part if r["part"] == part]
        assert order == sorted(order)
