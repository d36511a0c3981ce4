"""Runs a registered query and its SQL twin and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value: object) -> object:
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 10) + 0.0
    return value


def rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    cells = [[_cell(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*cells), key=repr)


def difference(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} and {sorted(wanted.columns)}"
    one, other = rows(found), rows(wanted)
    if len(one) != len(other):
        return f"{len(one)} and {len(other)} rows"
    for a, b in zip(one, other):
        if a != b:
            return f"{a} and {b}"
    return None
