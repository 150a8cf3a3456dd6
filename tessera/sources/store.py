"""Keyed-store range scan re-aimed at a columnar table.

A row-key range scan with one family:qualifier becomes a parquet scan
with the key range pushed down (``PushedFilters``) and only the two needed
columns read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import is_numeric


def range_scan_sum(df: DataFrame, key_col: str, start, stop, value_col: str,
                   name: str = "total") -> DataFrame:
    """Rows with ``start <= key < stop`` (values, or constant Columns of the key's type); all-digit values summed as long."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (start, stop))
    rows = df.select(key_col, value_col).where((F.col(key_col) >= low) & (F.col(key_col) < high))
    return rows.where(is_numeric(value_col)).agg(F.sum(F.col(value_col).cast("long")).alias(name))
