"""Mixing of sources to target weights by Poisson replication.

A source with target share ``w`` of the corpus and size ``n`` gets the mean repetition rate
``w * budget / n``. Each document inverts the Poisson distribution of that mean at a uniform
number drawn from a hash of its id, so it is repeated 0, 1, 2, ... times whatever partition
it sits in and however often a task is repeated. A mean above ``MEAN_LIMIT`` is met by several
independent draws of equal means, whose sum is again Poisson; each has a hash of its own. The
copies are then shuffled globally by a hash of id and copy. Nothing is counted per document
beyond one addition per source, which is combined before its shuffle; only documents of sources
with several draws add up their own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored
from sorrel.operators.joins import lookup_join

SEED = "mix-7"
#: Means above this are met by several draws, as exp(-mean) must stay a normal double.
MEAN_LIMIT = 500.0
#: Draws of one document that one row adds up.
DRAWS = 64


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def poisson_table(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... up to where nothing is left in doubles."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    step = lambda s, k: F.struct(
        (s["p"] * mean / k).alias("p"),
        F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf"),
    )
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cdf"])


def source_rates(docs: DataFrame, size: Column, weights: Mapping[str, float] | None = None) -> DataFrame:
    """``(source, rate, draws, cdf)`` per source, the null source included; ``cdf`` is that of one draw.

    ``weights`` gives shares by source; sources it does not name get none. Without it all
    sources weigh the same. The budget is the present size of the corpus, so sizes of
    zero give rate 1.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.greatest(size, F.lit(1))).alias("_size"))
    if weights is None:
        share = F.lit(1.0)
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
        share = F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0))
    weighed = sizes.withColumn("_w", share)
    weighed = stored(weighed)
    total = weighed.agg(F.sum("_size").alias("budget"), F.sum("_w").alias("weights")).first()
    rate = F.lit(0.0)
    if total["weights"]:
        rate = F.col("_w") * F.lit(float(total["budget"])) / (F.lit(total["weights"]) * F.col("_size"))
    rates = weighed.withColumn("rate", rate)
    draws = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("rate") / MEAN_LIMIT))
    rates = rates.withColumn("draws", draws)
    return rates.select("source", "rate", "draws", poisson_table(F.col("rate") / F.col("draws")).alias("cdf"))


def drawn(unit: Column) -> Column:
    """The number of which ``unit`` is the place in the cumulative table ``cdf``."""
    return F.size(F.filter("cdf", lambda c: c <= unit)).cast("long")


def copies_of_many_draws(found: DataFrame, rates: DataFrame, seed: str) -> DataFrame:
    """``(_doc, _id, n_copies, copy)`` of documents that need several draws.

    A row stands for ``DRAWS`` draws of a document, so neither the draws nor the copies of one
    document have to fit a row or a task. The first draw is that of a source with only one.
    """
    n = shuffle_partitions(found.sparkSession)
    last = F.floor((F.col("draws") - 1) / DRAWS)
    by_block = lambda df: df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    ids = by_block(found.select("_source", "_id", "draws").distinct()).repartition(n, "_source", "_id", "_block")
    dealt = lookup_join(ids.drop("draws"), rates, ["_source"], ["_id", "_block"])
    start = F.col("_block") * DRAWS
    units = F.transform(
        F.sequence(start, F.least(start + DRAWS, "draws") - 1),
        lambda d: F.when(d == 0, hash_unit(F.lit(seed), F.col("_id"))).otherwise(
            hash_unit(F.lit(seed), F.lit("draw"), d.cast("string"), F.col("_id"))
        ),
    )
    total = F.aggregate(F.transform(units, drawn), F.lit(0).cast("long"), lambda s, k: s + k)
    same = Window.partitionBy("_source", "_id")
    before = same.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(dealt.select("_source", "_id", "_block", total.alias("_n"))).select(
        "_source", "_id", "_block", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(same).alias("n_copies"),
    )
    whole = by_block(found.select("_doc", "_source", "_id", "draws"))
    parts = lookup_join(whole, stored(blocks), ["_source", "_id", "_block"], ["_doc"]).where("_n > 0").repartition(n)
    copy = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1))
    return parts.select("_doc", "_id", "n_copies", copy.alias("copy"))


def replicate(
    docs: DataFrame, weights: Mapping[str, float] | None = None, size: Column | None = None, seed: str = SEED
) -> DataFrame:
    """``(_doc, copy, n_copies)``: the rows of ``docs`` as structs, repeated by source and shuffled.

    ``size`` measures a document, by default characters of its text with 1 at least. Rows
    with the same id and source are repeated equally often; a null id counts as the text
    ``null``. An empty table gives an empty result.
    """
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long") if size is None else size
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rates = source_rates(docs, size, weights).select(source.alias("_source"), "draws", "cdf")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.select(
        F.struct("*").alias("_doc"), source.alias("_source"), doc.alias("_id"), hash_unit(F.lit(seed), doc).alias("_u")
    )
    found = lookup_join(keyed, rates, ["_source"], ["_id"])
    often = not rates.where("draws > 1").isEmpty()
    once = found.where("draws = 1") if often else found
    counted = once.select("_doc", "_id", drawn(F.col("_u")).alias("n_copies")).where("n_copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1)))
    if often:
        copies = copies.unionByName(copies_of_many_draws(found.where("draws > 1"), rates, seed))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), "_id", "copy"))
    n = shuffle_partitions(docs.sparkSession)
    shuffled = copies.withColumn("_order", order).repartition(n, "_order").sortWithinPartitions("_order")
    return shuffled.select("_doc", "copy", "n_copies")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """``docs`` repeated and shuffled, with ``copy`` (from 0) and ``n_copies`` in place of columns of these names."""
    return replicate(docs.drop("copy", "n_copies"), weights, **options).select("_doc.*", "copy", "n_copies")
