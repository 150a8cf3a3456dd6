"""Keyed aggregation.

All of these are hash aggregates with a partial (map-side) step, so a hot
key is pre-aggregated inside every task before the shuffle; only A10 keeps
values, and it does so in bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: truncation scale of means and weights (4 decimals).
TRUNC_SCALE = 10000


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def trunc4_units(x: Column) -> Column:
    """``x`` truncated toward zero to 4 decimals, as an integer count of 1e-4."""
    return (x * F.lit(TRUNC_SCALE)).cast("bigint")


def trunc4(x: Column) -> Column:
    """Truncate toward zero to 4 decimals (F19), e.g. 3.14159 -> 3.1415."""
    return trunc4_units(x) / F.lit(float(TRUNC_SCALE))


def count_per_key(df: DataFrame, key, name: str = "n") -> DataFrame:
    """A1: rows per key (combine-by-key with partial and final merge)."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias(name))


def sum_per_key(df: DataFrame, key, value: str, name: str = "total") -> DataFrame:
    """A2: sum of ``value`` per key (reduce-by-key)."""
    return df.groupBy(*_cols(key)).agg(F.sum(value).alias(name))


def distinct_per_key(df: DataFrame, key, value: str, name: str = "n_distinct",
                     approx: bool = False) -> DataFrame:
    """A3: number of distinct values per key.

    Exact form is planned by Spark as two hash aggregates (distinct on
    (key, value) first, then count), so no per-key set is ever built.
    ``approx=True`` uses HyperLogLog++.
    """
    agg = F.approx_count_distinct(value) if approx else F.countDistinct(value)
    return df.groupBy(*_cols(key)).agg(agg.alias(name))


def mean_per_key(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """A4: sum/count per key, truncated to 4 decimals."""
    return (df.groupBy(key)
            .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
            .select(key, trunc4(F.col("_s") / F.col("_n")).alias(name)))


def sum_pair_per_key(df: DataFrame, keys, a: str, b: str, names=("sum_a", "sum_b")) -> DataFrame:
    """A5: sums of a (numerator, denominator) pair per key."""
    return df.groupBy(*_cols(keys)).agg(F.sum(a).alias(names[0]), F.sum(b).alias(names[1]))


def top_k_per_key(df: DataFrame, key: str, order: str, k: int, tie: str | None = None,
                  ascending: bool = False) -> DataFrame:
    """The k rows with the largest ``order`` per key (ties broken by ``tie``).

    Window rank over a shuffle by key; Spark's WindowGroupLimit keeps only k
    rows per key inside each task before and after the shuffle, so a hot
    key never holds more than k rows in the window buffer.
    """
    o = F.col(order).asc() if ascending else F.col(order).desc()
    spec = [o] + ([F.col(tie).asc()] if tie else [])
    w = Window.partitionBy(key).orderBy(*spec)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Duplicate removal."""
    return df.distinct()


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def profile_distinct(df: DataFrame, columns=None, exact: bool = True) -> DataFrame:
    """Distinct count of every (string) column in one pass.

    Output: one row per column ``(column, n_distinct)``.  The reference runs
    one job per column; here every count is one aggregate of a single scan.
    """
    cols = columns or [c for c, t in df.dtypes if t == "string"]
    fn = F.countDistinct if exact else F.approx_count_distinct
    wide = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (`column`, n_distinct)")


def collect_groups(df: DataFrame, key: str, value: str, chunk: int = 10000,
                   name: str = "values") -> DataFrame:
    """A10: all values of a key as sorted lists, in chunks of at most ``chunk``.

    A plain ``collect_list`` per key would put a hot key's whole group into
    one array in one task; numbering the values inside the key (with
    ``position_in_key``, which spreads a hot key over range partitions
    instead of one window task) and grouping by (key, chunk) keeps every
    array bounded while keeping all values.
    Output: ``(key, chunk, values)`` with chunk 0, 1, ...
    """
    from tessera.operators.ranking import position_in_key
    numbered = (position_in_key(df.select(key, value), key, value)
                .withColumn("chunk", ((F.col("pos") - 1) / F.lit(chunk)).cast("bigint")))
    return (numbered.groupBy(key, "chunk")
            .agg(F.array_sort(F.collect_list(value)).alias(name)))


def global_sum(df: DataFrame, value: str, name: str = "total") -> DataFrame:
    """One global sum."""
    return df.agg(F.sum(value).alias(name))
