"""Cleans, deduplicates, mixes and packs ``documents`` in stages.

Every stage gets the documents that its predecessor kept and returns a DataFrame; all but
the last return the columns of ``documents``. ``run`` writes each result to the shared
folder and reads it again before the next stage.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import sorrel
from sorrel.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from sorrel.llm.common import stored, table

# Ships the package's functions with the tasks, so that executors need no install.
cloudpickle.register_pickle_by_value(sorrel)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_equal_texts(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.replicate(docs).select("_doc.*")


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_equal),
    ("MinHash near-dedup", drop_near),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_bins),
]

#: The classifier and the signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
