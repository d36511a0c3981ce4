"""Similar-item lists and their upkeep when items change.

Lists are ``(base, entries array<struct<item,sim>>)`` with at most ``n`` entries.
Catalogues are ``(item id, vector)`` frames in their latest state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.operators.few import best_for_few, best_of_few
from sorrel.operators.joins import lookup_join
from sorrel.operators.topk import as_lists, as_rows, keep_best, top_matches
from sorrel.schemas import SIMILAR_PER_ITEM
from sorrel.session import materialise

KNOWN_EVENTS = ("add", "delete", "update")


def build(catalogue: DataFrame, id_col: str, vec_col: str, n: int = SIMILAR_PER_ITEM) -> DataFrame:
    """Lists for every item of the catalogue."""
    found = top_matches(catalogue, None, n, "cosine", id_col, vec_col)
    return as_lists(catalogue.select(F.col(id_col).cast("bigint").alias("base")), found)


def build_for(
    bases: DataFrame, catalogue: DataFrame, id_col: str, vec_col: str, n: int = SIMILAR_PER_ITEM
) -> DataFrame:
    """``(base, item, score, rank)`` rows for the given ``base`` ids only."""
    chosen = _vectors_of(bases.select("base").distinct(), catalogue, id_col)
    return best_for_few(chosen, catalogue, n, "cosine", id_col, vec_col)


def _vectors_of(ids: DataFrame, catalogue: DataFrame, id_col: str) -> DataFrame:
    return catalogue.join(ids.select(F.col("base").alias(id_col)), id_col, "left_semi")


def _known(ids: DataFrame, catalogue: DataFrame, id_col: str) -> DataFrame:
    """The ids that the catalogue holds, once each; they are used several times."""
    held = catalogue.select(F.col(id_col).cast("bigint").alias("base"))
    return materialise(held.join(ids.select("base").distinct(), "base", "left_semi"))


def latest_changes(events: DataFrame, sequence: str) -> DataFrame:
    """Last known event per item; other event types are ignored."""
    return (
        events.where(F.col("type").isin(*KNOWN_EVENTS) & F.col("sid").isNotNull())
        .groupBy("sid")
        .agg(F.max_by("type", sequence).alias("type"))
    )


def apply_delete(lists: DataFrame, deleted: DataFrame) -> DataFrame:
    """Drops the lists of ``deleted`` bases and their entries elsewhere; nothing is refilled."""
    gone = deleted.select("base").distinct()
    kept = lists.join(gone, "base", "left_anti")
    marked = lookup_join(
        as_rows(kept), gone.select(F.col("base").alias("item"), F.lit(True).alias("_gone")), ["item"], ["base"], "left"
    )
    return as_lists(kept, marked.where(F.col("_gone").isNull()).drop("_gone"))


def apply_add(
    lists: DataFrame, added: DataFrame, catalogue: DataFrame, id_col: str, vec_col: str, n: int = SIMILAR_PER_ITEM
) -> DataFrame:
    """Gives each added item its list and lets it compete in the existing ones.

    Added ids that the catalogue does not know have no effect; items without a list
    do not get one.
    """
    new_ids = _known(added, catalogue, id_col)
    fresh = _vectors_of(new_ids, catalogue, id_col)
    old = lists.join(new_ids, "base", "left_anti")
    challengers = best_of_few(
        _vectors_of(old, catalogue, id_col), fresh, n, "cosine", id_col, vec_col
    ).select("base", "item", "score")
    current = _without_items(as_rows(old), new_ids).select("base", "item", "score")
    merged = keep_best(current.unionByName(challengers), n)
    own = best_for_few(fresh, catalogue, n, "cosine", id_col, vec_col)
    return as_lists(old.select("base").unionByName(new_ids), merged.unionByName(own))


def apply_update(
    lists: DataFrame, updated: DataFrame, catalogue: DataFrame, id_col: str, vec_col: str, n: int = SIMILAR_PER_ITEM
) -> DataFrame:
    """Re-scores changed items everywhere.

    A changed item enters a list, or stays in it, only if it is no worse than the old last
    entry, and a list keeps its length: one that deletions have shortened is not filled up,
    and an empty one stays empty. If a changed item that a list held falls below its old last
    entry, an unlisted item may have moved up, and the list is rebuilt from the catalogue.
    """
    ids = _known(updated, catalogue, id_col)
    fresh = _vectors_of(ids, catalogue, id_col)
    old = materialise(lists.join(ids, "base", "left_anti"))
    last = F.element_at("entries", -1)
    limits = old.where(F.size("entries") > 0).select(
        "base",
        F.size("entries").alias("_size"),
        F.round(last["sim"], 10).alias("_sim"),
        last["item"].alias("_item"),
    )
    rounded = F.round("score", 10)
    as_good = (rounded > F.col("_sim")) | ((rounded == F.col("_sim")) & (F.col("item") <= F.col("_item")))
    challengers = best_of_few(_vectors_of(old, catalogue, id_col), fresh, n, "cosine", id_col, vec_col)
    admitted = challengers.join(limits, "base").where(as_good).select("base", "item", "score")
    current = _without_items(as_rows(old), ids).select("base", "item", "score")
    merged = materialise(
        keep_best(current.unionByName(admitted), n).join(limits.select("base", "_size"), "base").where("rank <= _size")
    )
    full = merged.groupBy("base", "_size").count().where(F.col("count") >= F.col("_size")).select("base")
    rebuild = limits.select("base").join(full, "base", "left_anti").unionByName(ids)
    rebuilt_ids = materialise(rebuild.distinct())
    rebuilt = build_for(rebuilt_ids, catalogue, id_col, vec_col, n)
    kept = merged.drop("_size").join(rebuilt_ids, "base", "left_anti")
    return as_lists(old.select("base").unionByName(ids), kept.unionByName(rebuilt))


def apply_changes(
    lists: DataFrame,
    changes: DataFrame,
    catalogue: DataFrame,
    id_col: str,
    vec_col: str,
    n: int = SIMILAR_PER_ITEM,
) -> DataFrame:
    """One batch of ``(sid, type)`` changes, at most one per item, as set operations."""
    changes = materialise(changes.select(F.col("sid").cast("bigint").alias("base"), "type"))
    present = {r["type"] for r in changes.select("type").distinct().collect()}
    by_type = {kind: changes.where(F.col("type") == kind).select("base") for kind in KNOWN_EVENTS}
    live = catalogue
    if "delete" in present:
        gone = by_type["delete"].select(F.col("base").alias(id_col))
        live = catalogue.join(gone, id_col, "left_anti")
        lists = materialise(apply_delete(lists, by_type["delete"]))
    if "update" in present:
        unseen = live.join(by_type["add"].select(F.col("base").alias(id_col)), id_col, "left_anti")
        lists = materialise(apply_update(lists, by_type["update"], unseen, id_col, vec_col, n))
    if "add" in present:
        lists = apply_add(lists, by_type["add"], live, id_col, vec_col, n)
    return lists


def _without_items(rows: DataFrame, ids: DataFrame) -> DataFrame:
    marks = ids.select(F.col("base").alias("item"), F.lit(True).alias("_changed"))
    return lookup_join(rows, marks, ["item"], ["base"], "left").where(F.col("_changed").isNull()).drop("_changed")
