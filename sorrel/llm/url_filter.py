"""URL filtering with a trie over reversed host labels and path segments.

The rules form one trie: host labels from the last to the first, then path segments. A url
walks it once; among the rules on its way the one with most labels, then the longest path,
wins, whether it allows or blocks. The trie is built from a rule list that the caller holds
on the driver, and goes to the tasks only if its pickled size is within ``MAX_TRIE_BYTES``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_TRIE_BYTES = 256 << 20


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: The rules of the contract.
RULES = (
    Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"),
)


#: A trie node in plain values, which tasks can read without importing this module: labels or
#: segments below; the path trie of a host; and the rules that end here by their last,
#: unfinished path segment, where "" fits any rest.
Node = dict


def _node() -> Node:
    return {"next": {}, "paths": None, "ends": {}}


def build_trie(rules: Iterable[Rule]) -> Node:
    """Of rules with equal host and path a block wins over an allow."""
    root = _node()
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict}")
        node = root
        for label in reversed(host.translate(str.maketrans(UPPER, LOWER)).split(".")):
            node = node["next"].setdefault(label, _node())
        if node["paths"] is None:
            node["paths"] = _node()
        node = node["paths"]
        *segments, rest = path.split("/")
        for segment in segments:
            node = node["next"].setdefault(segment, _node())
        if node["ends"].get(rest, ("", ""))[1] != "block":
            node["ends"][rest] = (host + path, verdict)
    return root


def _longest_path(node: Node, path: str) -> tuple[str, str] | None:
    found, segments = None, path.split("/")
    for at in range(len(segments)):
        if node["ends"]:
            # An unfinished segment must begin what is left; the longest such one wins here.
            left = segments[at]
            for stop in range(len(left), -1, -1):
                if left[:stop] in node["ends"]:
                    found = node["ends"][left[:stop]]
                    break
        below = node["next"].get(segments[at]) if at + 1 < len(segments) else None
        if below is None:
            return found
        node = below
    return found


def match(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """``(rule, verdict)`` of the longest rule that fits."""
    found, node = None, trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            return found
        if node["paths"] is not None:
            found = _longest_path(node["paths"], path) or found
    return found


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty for null or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    known = at > 0
    return (
        F.coalesce(F.when(known, F.translate(host, UPPER, LOWER)), F.lit("")),
        F.coalesce(F.when(known, path), F.lit("")),
    )


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule] = RULES, otherwise: str = "allow", max_trie_bytes: int = MAX_TRIE_BYTES
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages``.

    Where no rule fits, ``rule`` is null and the verdict is ``otherwise``. Null urls and
    repeated rows are judged like others; an empty table gives an empty result.
    """
    trie = build_trie(rules)
    size = len(pickle.dumps(trie))
    if size > max_trie_bytes:
        raise ValueError(f"the rules take {size} bytes, more than may be broadcast ({max_trie_bytes})")
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf("rule string, verdict string")
    def find(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for hosts, paths in parts:
            found = [match(tree, h, p) or (None, otherwise) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    return split.withColumn("_found", find("host", "path")).select("page_id", "host", "path", "_found.rule", "_found.verdict")
