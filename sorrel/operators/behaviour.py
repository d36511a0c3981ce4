"""Behaviour messages: parsing, scores, profiles and splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.operators.ranking import global_index
from sorrel.schemas import OFFLINE_WEIGHTS

PROFILE_BLOCK = 1024


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """``user,operation,item`` text into columns plus ``reject_reason``.

    Trailing commas do not count as fields. Rows that cannot be used keep their
    reason instead of failing the job.
    """
    # The fields are their own step, so that they are split once for all columns.
    fielded = messages.withColumn("_fields", F.split(F.rtrim(F.trim(F.col(value)), F.lit(",")), ","))
    fields = F.col("_fields")
    user, item = (F.trim(F.get(fields, i)).try_cast("bigint") for i in (0, 2))
    reason = (
        F.when(F.coalesce(F.trim(F.col(value)), F.lit("")) == "", "blank")
        .when(F.size(fields) != 3, "arity")
        .when(user.isNull() | item.isNull(), "number")
    )
    good = reason.isNull()
    return fielded.withColumns(
        {
            "user_id": F.when(good, user),
            "operation": F.when(good, F.trim(F.get(fields, 1))),
            "item_id": F.when(good, item),
            "reject_reason": reason,
        }
    ).drop("_fields")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").select("user_id", "operation", "item_id")


def rejected(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.where("reject_reason is not null").select(value, "reject_reason")


def parse_indexed_ratings(lines: DataFrame, value: str = "value") -> DataFrame:
    """``((user,item,score),index)`` text into typed columns plus ``reject_reason``.

    Unusable lines keep their text and their reason; see :func:`accepted_ratings`.
    """
    fielded = lines.withColumn("_fields", F.split(F.regexp_replace(F.trim(F.col(value)), "[()]", ""), ","))
    kinds = {"user_id": "bigint", "item_id": "bigint", "score": "double", "index": "bigint"}
    typed = {
        name: F.trim(F.get("_fields", i)).try_cast(kind) for i, (name, kind) in enumerate(kinds.items())
    }
    unread = F.lit(False)
    for column in typed.values():
        unread = unread | column.isNull()
    reason = (
        F.when(F.coalesce(F.trim(F.col(value)), F.lit("")) == "", "blank")
        .when(F.size("_fields") != 4, "arity")
        .when(unread, "number")
    )
    good = reason.isNull()
    return fielded.withColumns(
        {**{name: F.when(good, column) for name, column in typed.items()}, "reject_reason": reason}
    ).drop("_fields")


def accepted_ratings(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").select("user_id", "item_id", "score", "index")


def weighted_score(operation: Column, weights: Mapping[str, float]) -> Column:
    """Sum of counts per operation times its weight; other operations add nothing."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.count_if(operation == name) * F.lit(weight)
    return total


def score(behaviours: DataFrame, weights: Mapping[str, float] = OFFLINE_WEIGHTS) -> DataFrame:
    """One score per (user, item); counts combine before the shuffle."""
    return behaviours.groupBy("user_id", "item_id").agg(weighted_score(F.col("operation"), weights).alias("score"))


def user_profile(scores: DataFrame, block: int = PROFILE_BLOCK) -> DataFrame:
    """Scored items per user, in pages of at most ``block`` item ids so no row grows without bound."""
    page = F.floor(F.col("item_id") / block).cast("bigint")
    return scores.groupBy("user_id", page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("item_id", "score"))).alias("items")
    )


def split_bucket(scores: DataFrame) -> DataFrame:
    """Adds ``bucket`` 0-9 from user and item: below 6 trains, 6-7 validates, 8-9 tests."""
    mixed = F.col("user_id").cast("bigint") * 31 + F.col("item_id")
    return scores.withColumn("bucket", F.pmod(mixed, F.lit(10)).cast("int"))


def split_name(bucket: Column) -> Column:
    return F.when(bucket < 6, "train").when(bucket < 8, "validation").otherwise("test")


def rating_index(scores: DataFrame) -> DataFrame:
    """Numbers the ratings from 0 in (user, item) order."""
    return global_index(scores, [F.col("user_id"), F.col("item_id")])


def rmse(pairs: DataFrame, predicted: str, actual: str) -> DataFrame:
    error = F.col(predicted) - F.col(actual)
    return pairs.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
