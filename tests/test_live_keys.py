"""Expiring keys in the state of a stream."""

import json
import os

from sorrel.sinks.serving import LAYOUT
from sorrel.streaming.live_keys import start_events


def change(key, value, at, seq=0, page=0, expires=None, deleted=False):
    time = lambda s: None if s is None else f"2024-01-01T00:{s // 60:02d}:{s % 60:02d}Z"
    return {"namespace": "n", "key": key, "page": page, "value": value, "expires_at": time(expires), "deleted": deleted,
            "written_at": time(at), "seq": seq}


def test_expiry_deletes_restarts_and_bounded_state(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    os.mkdir(inbox)
    rows = []

    def drain(*changes):
        name = f"{inbox}/{len(os.listdir(inbox)):03d}.json"
        with open(name, "w") as f:
            f.write("\n".join(json.dumps(c) for c in changes))
        os.utime(name, (1_700_000_000 + len(rows), 1_700_000_000 + len(rows)))
        stream = spark.readStream.schema(LAYOUT).option("maxFilesPerTrigger", 1).json(inbox)
        query = start_events(stream, out, checkpoint, drain=True)
        assert query.awaitTermination(240)
        if query.exception():
            raise query.exception()
        found = sorted((r["key"], r["event"], r["page"], r["value"], r["at"] % 3_600_000 // 1000) for r in spark.read.parquet(out).collect())
        new = [r for r in found if r not in rows]
        rows.extend(new)
        return sorted(new, key=str), query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else None

    first, _ = drain(
        change("a", "1", 10, expires=100), change("b", "x", 10, page=0), change("b", "y", 10, page=1), change("c", "old", 5, seq=1),
        change("c", "new", 5, seq=2), change("d", "gone", 8, deleted=True), change(None, "z", 9),
    )
    assert first == [("a", "put", 0, "1", 10), ("b", "put", 0, "x", 10), ("b", "put", 1, "y", 10), ("c", "put", 0, "new", 5)]
    # A later write takes all pages; an older one, or one that is late, does nothing.
    second, _ = drain(change("b", "w", 20), change("c", None, 21, deleted=True), change("d", "back", 22, expires=30))
    assert second == [("b", "put", 0, "w", 20), ("c", "delete", None, None, 21), ("d", "put", 0, "back", 22)]
    third, _ = drain(change("b", "older", 15), change("a", "1b", 50, expires=60), change("e", "dead", 40, expires=41))
    assert ("d", "expire", None, None, 30) in third and ("a", "put", 0, "1b", 50) in third
    assert not any(r[3] == "older" for r in third)
    fourth, state = drain(change("f", "last", 200))
    assert ("a", "expire", None, None, 60) in fourth and ("e", "expire", None, None, 41) in rows
    assert ("a", "expire", None, None, 100) not in rows
    again, state = drain(change("g", "end", 300))
    assert again == [("g", "put", 0, "end", 300)]
    # Only b, f and g live: a value and a page each, and no timers.
    assert state is None or state <= 12
