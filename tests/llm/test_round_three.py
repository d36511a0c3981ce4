"""Hard negatives, conversation repair and SimHash against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sorrel.llm import conversation_repair, hard_negatives, simhash
from sorrel.llm.conversation_repair import damage, repair

# Hard negatives ------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def mined(rows, anchors, low=50, high=95, positives=5, negatives=3):
    """(anchor, positive, rank, negative, scores) of ``(id, whole numbers, label)`` rows with distinct ids."""
    out = []
    for a, x, mine in rows:
        if a not in anchors:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, label) for i, y, label in rows if i != a and len(y) == len(x))
        for p, pid, _ in [s for s in scored if s[2] == mine][:positives]:
            fit = [s for s in scored if s[2] != mine and low * -p <= 100 * -s[0] <= high * -p]
            out += [(a, pid, n + 1, s[1], -p, -s[0]) for n, s in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, length", [(65_536, 12), (40, 16), (7, 5)])
def test_hard_negatives(spark, shard_rows, length):
    rnd = random.Random(length)
    rows = [(i, [rnd.randrange(-300, 300) for _ in range(length)], rnd.randrange(3)) for i in range(200)]
    # Many copies of one vector: ties go to the smaller id.
    rows += [(i, list(rows[3][1]), 1 + i % 2) for i in range(200, 260)]
    frame = spark.createDataFrame([(i, [x / 256 for x in v], label) for i, v, label in rows], VECTORS).repartition(5)
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect()
    assert sorted(tuple(r) for r in found) == mined(rows, set(range(0, 260, 20)))
    assert len(found) > 50


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.5, 0.0], 2), (2, [1.5, 0.0], 2), (3, [1.0, None], 2), (4, None, 2), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (None, [1.9, 0.0], 2), (7, [1.9, 0.0], None), (8, [1.0], 2), (9, [], 2), (0, [5.0, 5.0], 3)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("shard", "kind", "bits", "x", "v", "nth", "score")})
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") == 0).collect()
    # The anchor is the smaller of its two rows; the repeated negative counts twice.
    assert sorted(tuple(r) for r in found) == [(0, 1, 1, 2, 131072, 98304), (0, 1, 2, 2, 131072, 98304)]
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") == 0).count() == 0


def test_table_scores_are_whole_products():
    rnd = np.random.default_rng(3)
    for spread in (3, 500, 2**20, 2**40):
        values = rnd.integers(-spread, spread, (300, 21))
        bits = hard_negatives.bit_planes(values)
        assert (hard_negatives.from_planes(bits, 21) == values).all()
        wide = values[:9].astype(object) @ values.T.astype(object)
        wanted = np.vectorize(lambda x: max(-(2**63), min(2**63 - 1, x)), otypes=[object])(wide)
        assert (hard_negatives.scores(values[:9], bits).astype(object) == wanted).all()


# Conversations -------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def faults(rows):
    """By row: blank, duplicate, truncated or None."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0d]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, digest) by trying all edits of a few rows."""
    gaps = [[("", [])], *[[("I" * len(g), [(n, "") for n in g])] for g in (["user"], ["assistant"], ["user", "assistant"])]]
    gaps = [g[0] for g in gaps]
    choices = []
    for (role, text), fault in zip(rows, faults(rows)):
        more = [("D", 3, [])]
        if fault in (None, "truncated"):
            extra = int(fault == "truncated")
            more += [("K", extra, [(role, text)])] + [("R", 2 + extra, [(n, text)]) for n in ("user", "assistant")]
        choices.append(more)
    best = None
    for inserted in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*choices):
            audit, cost, left = inserted[0][0], 2 * len(inserted[0][1]), list(inserted[0][1])
            for (letter, paid, kept), (letters, new) in zip(edits, inserted[1:]):
                audit, cost, left = audit + letter + letters, cost + paid + 2 * len(new), left + kept + new
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return best


def test_repair_is_cheapest_and_ascii_least(spark):
    rnd = random.Random(8)
    roles, texts = ["user", "assistant", "system", "tool", ""], ["Yes.", "no", " \n", "Ü?", "no", "Well! "]
    rows = [(c, t * 2, rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in range(rnd.randrange(1, 4))]
    found = {r["conv_id"]: r for r in repair(spark.createDataFrame(rows, TURNS).repartition(4)).collect()}
    for c in range(60):
        mine = [(r, t) for conv, _, r, t in rows if conv == c]
        kinds, got = faults(mine), found[c]
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == cheapest(mine)
        assert (got["blank"], got["duplicate"], got["truncated"]) == tuple(kinds.count(k) for k in ("blank", "duplicate", "truncated"))
        assert got["gaps"] == (len(mine) - 1) and got["illegal"] == sum(
            a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])
        )


def longest(rows):
    """(cost, audit, digest) of many rows, with the whole edit text kept by state."""
    ahead, at = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}, {0: (0, "", ())}

    def with_inserts(states):
        out = {}
        for s, (cost, audit, left) in states.items():
            for n in range(3):
                if s not in out or (cost, audit) < out[s][:2]:
                    out[s] = (cost, audit, left)
                s, name = ahead[s]
                cost, audit, left = cost + 2, audit + "I", left + ((name, ""),)
        return out

    for (role, text), fault in zip(rows, faults(rows)):
        out = {}
        for s, (cost, audit, left) in with_inserts(at).items():
            more = [(s, 3, "D", ())]
            if fault in (None, "truncated"):
                extra = int(fault == "truncated")
                more.append((ahead[s][0], 2 + extra, "R", ((ahead[s][1], text),)))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
                if to is not None:
                    more.append((to, extra, "K", ((role, text),)))
            for to, paid, letter, kept in more:
                new = (cost + paid, audit + letter, left + kept)
                if to not in out or new[:2] < out[to][:2]:
                    out[to] = new
        at = out
    cost, audit, left = min(x for s, x in with_inserts(at).items() if s == 3 or (s == 0 and not x[2]))
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()


def test_a_giant_conversation_runs_over_batches_and_spills(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(r, t) for r, t in zip(rnd.choices(["user", "assistant", "system", "x"], [6, 6, 1, 1], k=9_000),
                                   (f"{rnd.choice(['go', 'stay'])} {rnd.randrange(4000)}{rnd.choice('. !')}" for _ in range(9_000)))]
    frame = spark.createDataFrame([(1, n, r, t) for n, (r, t) in enumerate(rows)] + [(2, 0, "user", "Hi.")], TURNS).repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    monkeypatch.setattr(conversation_repair, "BLOCK", 512)
    monkeypatch.setattr(conversation_repair, "SPOOL", 2_000)
    try:
        found = {r["conv_id"]: r for r in repair(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (found[1]["cost"], found[1]["audit"], found[1]["repaired_sha256"]) == longest(rows)
    assert found[1]["duplicate"] == faults(rows).count("duplicate") > 100
    assert (found[2]["audit"], found[2]["cost"]) == ("KI", 2)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in [None, *range(8)]] + [(None, 1, None, None)]
    found = damage(spark.createDataFrame(rows, TURNS)).collect()
    wanted = []
    for c, t, role, text in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(what, text)
        wanted += [(c, t, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_odd_conversations(spark):
    rows = [(1, None, "user", "A."), (1, None, "user", "A."), (1, 5, "assistant", "B."), (2, None, None, None), (None, 3, "user", "C."),
            (None, 3, "assistant", "D."), (4, 2**62, "user", "E."), (4, -(2**62) - 5, "assistant", "F."),
            (5, 1, "user", "w " * 500_000 + "."), (5, 2, "assistant", "fine.")]
    frame = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("kind", "digest", "nth", "what", "_copy")})
    more = spark.createDataFrame([(7,), (7,), (1,)], "conv_id long")
    found = {r["conv_id"]: r for r in repair(frame, more).collect()}
    assert sorted(found, key=str) == [1, 2, 4, 5, 7, None]
    assert (found[1]["audit"], found[1]["duplicate"], found[1]["gaps"]) == ("KDK", 1, 0)
    assert (found[2]["audit"], found[2]["blank"]) == ("D", 1)
    assert (found[None]["audit"], found[None]["cost"]) == ("IKKI", 4)
    assert (found[4]["gaps"], found[5]["audit"]) == (2**63 - 1, "KK")
    assert tuple(found[7])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = spark.createDataFrame([], TURNS)
    assert repair(empty).count() == 0 and repair(damage(empty), empty).count() == 0


# SimHash -------------------------------------------------------------------------

DOCS = "doc_id long, text string"


def plain_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if w]
    words = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    """Smallest id of each id's component, pair by pair."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def test_fingerprint():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 40, 300):
        text = "\n ".join(rnd.choice(["Die", "ÄRGER", "x", "zwölf", "BIG"]) for _ in range(n))
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == 0 and len(simhash.flips(64, 2)) == len(set(simhash.flips(64, 2).tolist())) == 2081


def test_spark_hashes_the_same(spark):
    text = "vier wörter sind hier"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("leading, variants", [(None, 1 << 21), (4, 3_000), (8, 1 << 21), (20, 500)])
def test_fingerprints_within_the_radius_are_linked(spark, leading, variants, monkeypatch):
    monkeypatch.setattr(simhash, "VARIANTS", variants)
    rnd = random.Random(7)
    prints = {}
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 5)):
            prints[len(prints)] = base
            for bit in rnd.sample(range(64), rnd.choice([1, 3, 4, 4, 5, 5, 6])):
                base ^= 1 << bit
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in set(prints.values())], "node long").repartition(3)
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.near_fingerprints(nodes, 4, leading).collect()]
    values = sorted(set(prints.values()))
    wanted, root = groups(dict(enumerate(values))), {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: find(v) for v in values} == {values[i]: values[j] for i, j in wanted.items()}


def test_simhash_of_documents(spark):
    rnd = random.Random(4)
    words = [f"w{n}" for n in range(50)]
    texts = []
    for _ in range(25):
        base = rnd.choices(words, k=rnd.randrange(3, 150))
        for _ in range(rnd.randrange(1, 5)):
            texts.append(" ".join(base))
            base[rnd.randrange(len(base))] = rnd.choice(words)
    texts += ["", None, " \t ", "k " * 200_000]
    docs = dict(enumerate(texts))
    frame = spark.createDataFrame(list(docs.items()), DOCS).repartition(4).withColumns({c: F.lit(1) for c in ("node", "part", "least", "a", "to")})
    found = {r["doc_id"]: r for r in simhash.simhash_duplicates(frame).collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    wanted = groups(prints)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {i: (f"{prints[i]:016x}", wanted[i]) for i in docs}


def test_simhash_of_odd_rows(spark):
    one, other = "a b c d e f g h", "q r s t u v w x"
    rows = [(None, one), (5, one), (5, other), (9, other), (None, "alone in here, quite"), (7, None), (7, None), (8, "")]
    found = simhash.simhash_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [
        (0, 0), (0, 5), (5, 5), (5, 5), (7, 7), (7, 7), (8, 7), (9, 5),
    ]
    assert simhash.simhash_duplicates(spark.createDataFrame([], DOCS)).count() == 0
