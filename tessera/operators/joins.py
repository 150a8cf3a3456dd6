"""Equi-joins.

No join here forces a broadcast: the planner broadcasts a side whose size in
bytes, known or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ranking import position_in_key


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def inner_join(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Hash-partitioned inner equi-join (Catalyst picks the strategy)."""
    return left.join(right, _keys(key), "inner")


def cogroup_lists(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                  chunk: int = 10000) -> DataFrame:
    """Per key, the sorted values of both sides; keys of either side.

    Values are numbered inside their key without sending a key to one task
    (``position_in_key``) and grouped ``chunk`` at a time, so no array grows
    with the data.  Output ``(key, chunk, left_values, right_values)``, an
    empty array for a side that has no values in that chunk.
    """
    def side(df, value, name):
        pos = position_in_key(df.select(key, value), key, value)
        return (pos.withColumn("chunk", ((F.col("pos") - 1) / F.lit(chunk)).cast("bigint"))
                .groupBy(key, "chunk").agg(F.array_sort(F.collect_list(value)).alias(name)))
    lv, rv = f"{left_value}_list", f"{right_value}_list"
    if lv == rv:
        lv, rv = "left_values", "right_values"
    out = side(left, left_value, lv).join(side(right, right_value, rv), [key, "chunk"], "full")
    return out.select(key, "chunk",
                      F.coalesce(lv, F.array().cast(out.schema[lv].dataType)).alias(lv),
                      F.coalesce(rv, F.array().cast(out.schema[rv].dataType)).alias(rv))


def cross_within_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every (left value, right value) pair of a key = the inner join."""
    return left.join(right, _keys(key), "inner")


def broadcast_lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, dim_value: str) -> DataFrame:
    """Fact rows with a known key -> the dimension value only.

    Duplicate dimension keys are resolved to their largest value (the
    reference keeps whichever came last).
    """
    d = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.max(dim_value).alias(dim_value))
    return fact.join(d, fact[fact_key] == d["_k"]).select(d[dim_value])


def semi_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key exists in the dimension."""
    d = dim.select(F.col(dim_key).alias("_k")).distinct()
    return fact.join(d, fact[fact_key] == d["_k"], "left_semi")


def left_join_default(left: DataFrame, right: DataFrame, key, value: str, default) -> DataFrame:
    """Left join; a missing right value becomes ``default``."""
    out = left.join(right, _keys(key), "left")
    return out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def copartitioned_join(left: DataFrame, right: DataFrame, key, partitions: int) -> DataFrame:
    """Both sides hash-partitioned on ``key`` into the same number of
    partitions; the join reuses that partitioning (no further exchange).

    For repeated joins store both sides with ``write_bucketed``.
    """
    ks = _keys(key)
    return left.repartition(partitions, *ks).join(right.repartition(partitions, *ks), ks)


def write_bucketed(df: DataFrame, name: str, key, buckets: int, path: str) -> None:
    """J10, stored: table ``name`` under ``path``, bucketed and sorted by ``key``, one file per bucket.

    The rows are dealt by the hash that bucketing uses, so a task writes one whole bucket.  Keys that hold
    a large share of the rows make a large bucket, which a bucketed join cannot split: for those
    use ``skew.skew_split_join``.
    """
    ks = _keys(key)
    (df.repartition(buckets, *ks).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *ks).sortBy(*ks).saveAsTable(name))


def bucketed_join(spark: SparkSession, left: str, right: str, key) -> DataFrame:
    """J10, stored: two tables of ``write_bucketed`` with equal bucket counts, joined bucket by bucket without an exchange."""
    return spark.table(left).join(spark.table(right), _keys(key))


def broadcast_mean_lookup(df: DataFrame, means: DataFrame, key: str, default: float) -> DataFrame:
    """Attach ``mean`` by key; default when absent."""
    return (df.join(means.select(key, "mean"), key, "left")
            .withColumn("mean", F.coalesce(F.col("mean"), F.lit(default))))
