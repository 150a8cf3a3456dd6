"""Frequent itemsets and association rules with Spark ML's
parallel FP-Growth.  Baskets are built with one ``collect_set`` per basket
id, bounded by the item vocabulary.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference run: support 0.2, confidence 0.7.
MIN_SUPPORT = 0.2
MIN_CONFIDENCE = 0.7


def to_baskets(pairs: DataFrame, id_col: str = "id", item_col: str = "item") -> DataFrame:
    """(id, item) rows -> (id, items array) with distinct items."""
    return pairs.groupBy(id_col).agg(F.collect_set(item_col).alias("items"))


def tokenize_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Blank-separated basket lines (trimmed) -> ``items`` arrays of distinct tokens."""
    return lines.select(F.array_distinct(F.split(F.trim(F.col(col)), " ")).alias("items"))


def _model(baskets: DataFrame, min_support: float, min_confidence: float, partitions: int | None):
    partitions = partitions or int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                  numPartitions=partitions)
    return fp.fit(baskets.select("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT,
                      partitions: int | None = None) -> DataFrame:
    """``(items sorted array, freq)`` for every itemset with support >= min."""
    m = _model(baskets, min_support, 1.0, partitions)
    return m.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def association_rules(baskets: DataFrame, min_support: float = MIN_SUPPORT,
                      min_confidence: float = MIN_CONFIDENCE, partitions: int | None = None) -> DataFrame:
    """Rules with a one-item consequent and confidence >= min."""
    m = _model(baskets, min_support, min_confidence, partitions)
    return m.associationRules.select(F.array_sort("antecedent").alias("antecedent"), "consequent",
                                     "confidence", "lift", "support")
