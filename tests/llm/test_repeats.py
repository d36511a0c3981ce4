"""Groups, anchors and memory of the operators on repeated stretches."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from brute import repeated_bytes, repeated_words
from test_dedup import planted

from sorrel.llm import repeats, substring_dedup, suffix_dedup
from sorrel.llm.repeats import Unit
from sorrel.llm.suffix_dedup import leading, range_groups
from sorrel.llm.tokens import U


def test_equal_strings_meet_whatever_else_their_batch_holds():
    """Splitters of neighbouring leads: a string's group follows from lead and hash alone."""
    rng = np.random.default_rng(4)
    leads = [b"aaaaaaaa", b"aaaaaaab", b"bbbbbbbb", b"zzzzzzzz"]
    values = np.frombuffer(b"".join(leads), np.uint8)
    starts = rng.integers(0, 4, 3_000) * 8
    strings = rng.integers(0, 100, 3_000).astype(U)
    lead = leading(values, starts)
    splits = sorted({(int(a), int(b)) for a, b in zip(lead[:60], strings[:60]) if a != leading(values, np.array([8]))[0]})
    address = range_groups(*(np.array(c, U) for c in zip(*splits)))
    batch = SimpleNamespace(values=values)
    together, _ = address(batch, starts, strings)
    assert together.tolist() == [sum(s <= (int(a), int(b)) for s in splits) for a, b in zip(lead, strings)]
    alone = [address(batch, starts[i : i + 1], strings[i : i + 1])[0][0] for i in range(len(starts))]
    assert together.tolist() == alone


BYTES, WORDS = Unit(words=False, length=50, gram=20, own=False), Unit(words=True, length=20, gram=10, own=True)


def anchor_rows(docs: dict[int, str | None], unit: Unit, groups: int) -> pd.DataFrame:
    checks = np.arange(len(docs), dtype=np.int32)
    rows = {"doc_id": list(docs), "check": pa.array(checks), "text": [t or "" for t in docs.values()]}
    sent = repeats._send_anchors(unit, groups)(iter(pa.Table.from_pydict(rows).to_batches()))
    return pd.concat([batch.to_pandas() for batch in sent])


@pytest.mark.parametrize("unit", [BYTES, WORDS])
def test_the_anchor_step_keeps_to_small_arrays(unit):
    """Two of these steps run in an executor at a time, next to its heap."""
    rnd = random.Random(3)
    docs = {n: " ".join(f"w{rnd.randrange(9_999)}" for _ in range(400)) for n in range(1_000)}
    tracemalloc.start()
    try:
        anchor_rows(docs, unit, 40)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 << 20


@pytest.mark.parametrize("unit", [BYTES, WORDS])
def test_pieces_send_the_rows_of_a_whole_batch(unit, monkeypatch):
    docs = planted(8)
    whole = anchor_rows(docs, unit, 5)
    for size in (1, 700):
        monkeypatch.setattr(repeats, "PIECE", size)
        assert anchor_rows(docs, unit, 5).equals(whole)


@pytest.mark.parametrize("piece, batch", [(1, 2 << 20), (700, 3_000), (1 << 18, 2 << 20)])
@pytest.mark.parametrize("unit", [BYTES, WORDS])
def test_steps_in_pieces_against_brute_force(unit, piece, batch, monkeypatch):
    """The steps of an operator one after the other, with three groups."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "BATCH", batch)
    docs, groups = planted(9), 3
    operator, order = (substring_dedup, substring_dedup.subtree_order) if unit.words else (suffix_dedup, suffix_dedup.suffix_order)
    address = substring_dedup.prefix_groups([], groups) if unit.words else range_groups(np.zeros(0, U), np.zeros(0, U))
    texts = pd.DataFrame({"doc_id": list(docs), "check": np.arange(len(docs), dtype=np.int32), "text": [t or "" for t in docs.values()]})
    texts["to"] = repeats.homes(texts["doc_id"].to_numpy(), texts["check"].to_numpy(), groups)
    at = lambda frame, to: frame[frame["to"] == to]
    found = pd.concat([repeats.settle_anchors(f, unit, groups) for _, f in anchor_rows(docs, unit, groups).groupby("to")])
    two = pd.concat([repeats.stage_two(f, at(found, to), unit, address, operator.kept_digest) for to, f in texts.groupby("to")])
    windows, waiting = (two[two["kind"] == kind] for kind in (repeats.WINDOWS, repeats.WAITING))
    covered = pd.concat([repeats.repeated_windows(f, order, unit.own, groups) for _, f in windows.groupby("to")])
    three = [repeats.stage_three(f, at(covered, to), unit, operator.kept_digest) for to, f in waiting.groupby("to")]
    done = pd.concat([two[two["kind"] == repeats.DONE], *three])
    names = ["n_units", "n_removed", "sha"] if unit.words else ["n_units", "n_removed", "n_spans", "sha"]
    rows = {int(r["doc_id"]): tuple(r[n] for n in names) for r in done.to_dict("records")}
    assert len(done) == len(docs) and rows == (repeated_words(docs) if unit.words else repeated_bytes(docs))
