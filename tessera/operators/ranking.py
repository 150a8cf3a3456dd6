"""Positions and running sums inside a key, without giving a key to one task.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task; with a key that holds a third of the table that task does a third of
the work.  Here

1. rows are range-partitioned on (key, order, row id) -- the sampled range
   bounds split a hot key over many ranges -- and written once, with the number
   of their range, as a table in the shared folder, so that every later step
   (and every retry) sees the same ranges;
2. a window over (range, key) numbers or sums the rows of one range, with
   Spark's own window functions;
3. per (range, key) totals, summed over the ranges before, carry a key over range
   bounds.  Only keys that cross a bound need them: at most one row per
   range, a proven bound, safe to broadcast.

Null keys are a key like any other (null-safe comparisons throughout).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import shared_table

RANGE = "_range"


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def ranged_table(df: DataFrame, sort_cols, partitions: int | None = None) -> DataFrame:
    """``df`` in ranges of ``sort_cols``, written to the shared folder, with the number of the range."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shared_table(df.repartitionByRange(n, *sort_cols).withColumn(RANGE, F.spark_partition_id()), "ranges")


def before_range(totals: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """totals (range, keys, values) -> per key and range the sums of the key's earlier ranges.

    Rows of a key's first range have nothing before them and are left out, so
    at most one row per range remains.
    """
    w = Window.partitionBy(*keys).orderBy(RANGE) if keys else Window.orderBy(RANGE)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return (totals.withColumn("_nth", F.row_number().over(w))
            .select(RANGE, *keys, "_nth", *[F.sum(v).over(earlier).alias(name) for v, name in sums.items()])
            .where("_nth > 1").drop("_nth"))


def join_before(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Attach ``before`` (at most one row per range) to rows by range and key, nulls being equal."""
    names = {c: f"_b_{c}" for c in [RANGE, *keys]}
    small = before.withColumnsRenamed(names)
    on = F.col(RANGE) == F.col(names[RANGE])
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(names[k]))
    return rows.join(F.broadcast(small), on, "left").drop(*names.values())


def position_in_key(df: DataFrame, key, order, name: str = "pos",
                    partitions: int | None = None) -> DataFrame:
    """Add ``name``: 1-based position of the row inside ``key`` by ``order``.

    Tied rows are interchangeable; a per-row id as the last sort column lets
    the range bounds split even a hot key whose order values are all equal.
    """
    keys, orders = _names(key), _names(order)
    sort_cols = keys + orders + ["_tb"]
    rows = ranged_table(df.withColumn("_tb", F.monotonically_increasing_id()), sort_cols, partitions)
    totals = rows.groupBy(RANGE, *keys).agg(F.count(F.lit(1)).alias("_n"))
    local = F.row_number().over(Window.partitionBy(RANGE, *keys).orderBy(*orders, "_tb"))
    out = join_before(rows.withColumn(name, local), before_range(totals, keys, {"_n": "_offset"}), keys)
    return (out.withColumn(name, F.col(name) + F.coalesce(F.col("_offset"), F.lit(0)))
            .drop(RANGE, "_offset", "_tb"))


def exclusive_prefix_sums(df: DataFrame, order, values, partitions: int | None = None) -> DataFrame:
    """Add ``<v>_before``: the sum of ``v`` over all rows earlier in ``order``.

    ``order`` must be a total order (e.g. distinct scores).
    """
    orders, vals = _names(order), _names(values)
    rows = ranged_table(df, orders, partitions)
    totals = rows.groupBy(RANGE).agg(*[F.sum(v).alias(f"_t_{v}") for v in vals])
    before = before_range(totals, [], {f"_t_{v}": f"_o_{v}" for v in vals})   # one row per range
    w = Window.partitionBy(RANGE).orderBy(*orders).rowsBetween(Window.unboundedPreceding, -1)
    out = join_before(rows.select("*", *[F.sum(v).over(w).alias(f"_l_{v}") for v in vals]), before, [])
    for v in vals:
        out = out.withColumn(f"{v}_before", F.coalesce(F.col(f"_l_{v}"), F.lit(0.0)) + F.coalesce(F.col(f"_o_{v}"), F.lit(0.0)))
    return out.drop(RANGE, *[f"_{x}_{v}" for v in vals for x in "lo"])
