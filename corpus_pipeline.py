"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and reread.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns
the documents that go on, with their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, mixing, packing, simhash
from tessera.llm import toxicity as pu
from tessera.llm.shared import shared_path
from tessera.session import remove, scratch
from tessera.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores below one half stay."""
    return pu.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest doc_id."""
    return simhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's word budget takes them, the last one cut at the budget."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per power-of-two piece, a sequence of its own, with its ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: Model training, tokenizer ids and XXH64 have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table of ``sf_dir``.

    Of the tables in the shared folder only the last stage's is left: a stage's helper tables go
    once its result is written, that result once the next one's is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
