"""Sorting, partitioning, union and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by_key(df: DataFrame, *keys, ascending: bool = True) -> DataFrame:
    """O1: total sort (range-partitioned shuffle + per-partition sort)."""
    cols = [F.col(k).asc() if ascending else F.col(k).desc() for k in keys]
    return df.orderBy(*cols)


def top_1(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """O2: the most frequent key (ties: smallest key) - a TakeOrdered of one row."""
    return counts.orderBy(F.desc(n), F.asc(key)).limit(1)


def sort_composite(df: DataFrame, first: str, second: str) -> DataFrame:
    """O3: order by (first, second) ascending."""
    return df.orderBy(F.asc(first), F.asc(second))


def range_partition(df: DataFrame, key: str, partitions: int = 5, descending: bool = True) -> DataFrame:
    """``partitions`` disjoint key ranges, highest keys in partition 0
    when descending; no sort inside a partition.  Adds ``part``.
    """
    k = F.col(key).desc() if descending else F.col(key).asc()
    return df.repartitionByRange(partitions, k).withColumn("part", F.spark_partition_id())


def set_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin into ``partitions`` partitions (before a file write)."""
    return df.repartition(partitions)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def hash_fraction(key) -> Column:
    """A value in [0, 1) from the MD5 of the key's text: same in any engine."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None, key: str | None = None) -> DataFrame:
    """Bernoulli sample without replacement.

    With ``key`` the draw is a hash of the key (repeatable across engines
    and runs); otherwise Spark's seeded sampler.
    """
    if key is not None:
        return df.where(hash_fraction(key) < F.lit(fraction))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights=(0.6, 0.4), seed: int = 11, key: str | None = None) -> list[DataFrame]:
    """Disjoint splits whose union is the input.

    With ``key``: cut points on the key's hash fraction (stable under
    re-execution); otherwise ``randomSplit`` (seeded; Spark sorts each
    partition first so a recomputed partition splits the same way).
    """
    if key is None:
        return df.randomSplit(list(weights), seed)
    total = float(sum(weights))
    out, lo = [], 0.0
    h = hash_fraction(key)
    for i, w in enumerate(weights):
        hi = 1.0 if i == len(weights) - 1 else lo + w / total
        out.append(df.where((h >= F.lit(lo)) & (h < F.lit(hi))))
        lo = hi
    return out
