"""Delimited text sources and text sinks.

Parsers take a DataFrame with one ``value`` string per line (what
``spark.read.text`` gives), so the same code serves files and derived
text.  Fields are split like the JVM's ``String.split`` (trailing empty
fields dropped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import has_error, is_numeric, java_split
from tessera.operators.skew import dealt


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Text lines of a file or folder as ``value``; optionally at least n partitions."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def _digit_fields(lines: DataFrame, col: str, n: int) -> DataFrame:
    """Lines whose first ``n`` comma-separated fields are all digits -> ``f``, those fields.

    One anchored match on the raw line decides; only kept lines are split, once.
    """
    kept = lines.where(F.col(col).rlike(r"\A\p{Nd}+" + r",\p{Nd}+" * (n - 1) + r"(?:,[\s\S]*)?\z"))
    return kept.select(F.split(F.col(col), ",", n + 1).alias("f"))


def read_ratings(lines: DataFrame, col: str = "value") -> DataFrame:
    """``user,item,rating`` lines -> ``(user string, item string, rating double)``.

    A line is kept only with at least three fields whose first three are all
    digits (so "3.5", "-1" and empty fields are rejected).
    """
    return _digit_fields(lines, col, 3).select(
        F.col("f")[0].alias("user"), F.col("f")[1].alias("item"), F.col("f")[2].cast("double").alias("rating"))


def read_pairs(lines: DataFrame, col: str = "value") -> DataFrame:
    """``user,item`` lines -> ``(user string, item string)``, both all digits."""
    return _digit_fields(lines, col, 2).select(F.col("f")[0].alias("user"), F.col("f")[1].alias("item"))


def read_positional(lines: DataFrame, positions: dict[str, int], col: str = "value", sep: str = ",") -> DataFrame:
    """S3: pick fields by 0-based position, e.g. ``{"op": 4, "video": 6}``; missing -> null."""
    f = F.split(F.col(col), sep)
    return lines.select(*[F.get(f, i).alias(name) for name, i in positions.items()])


def rows_to_items(df: DataFrame, columns=None, name: str = "items") -> DataFrame:
    """Each row -> one text ``col:value col:value ...`` of all its columns."""
    cols = columns or df.columns
    return df.select(F.concat_ws(" ", *[F.concat(F.lit(f"{c}:"), F.col(c).cast("string")) for c in cols]).alias(name))


def read_similarity(lines: DataFrame, col: str = "value", tasks: int | None = None) -> DataFrame:
    """``(i,j,sim)`` lines -> distinct ``(i long, j long, sim double)``, in ``tasks`` partitions if given."""
    f = F.split(F.regexp_replace(F.col(col), r"[()]", ""), ",")
    rows = lines.select(F.get(f, 0).cast("long").alias("i"), F.get(f, 1).cast("long").alias("j"), F.get(f, 2).cast("double").alias("sim"))
    return dealt(rows, tasks, "i", "j", "sim").distinct()


def scan_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file ``(filename, content)``; a file must fit in a row (see ``scan_lines``)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("filename"), F.col("value").alias("content")))


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """S4 for files of any size: ``(filename, block, line)``, a row per line.

    Spark reads a file in byte ranges, a task each (``spark.sql.files.maxPartitionBytes``); a range that
    begins inside a line leaves it to the range before, which reads on to the line's end, so a
    line cut by a border is whole, once.  ``block`` is the range's first byte.
    """
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("filename"),
                                        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def error_files(lines: DataFrame, name: str = "filename", line: str = "line") -> DataFrame:
    """F18 from lines: the names of the files that ``error_filter`` keeps.

    The words it looks for and the one it removes have no line end in them, so a file has an
    error exactly if one of its lines has; a file is at most one row per task before the shuffle.
    """
    return lines.where(has_error(line)).select(name).distinct()


def error_report_lines(lines: DataFrame, name: str = "filename", line: str = "line") -> DataFrame:
    """F18's report in lines: all lines of the files with an error, in as many tasks as read them."""
    return lines.join(error_files(lines, name, line), name, "left_semi")


def write_text(df: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite") -> None:
    """Write one string column as text files.

    ``partitions`` sets the number of files (round-robin, so balanced).  One
    file means one writing task: use it only for outputs of bounded size.
    """
    out = df.repartition(partitions) if partitions else df
    out.write.mode(mode).text(path)


def write_by_day(df: DataFrame, ts_col: str, path: str, mode: str = "overwrite") -> None:
    """Write a table partitioned by day (``dt=yyyy-MM-dd`` folders)."""
    (df.withColumn("dt", F.to_date(F.col(ts_col)).cast("string"))
     .write.mode(mode).partitionBy("dt").parquet(path))


def read_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The rows of one day of a day-partitioned table (partition pruning)."""
    return spark.read.parquet(path).where(F.col("dt") == F.lit(day))


def day_slice(df: DataFrame, ts_col: str, day) -> DataFrame:
    """S12 on a flat table: rows with ``ts`` in [day, day + 1) - a range filter
    that parquet row groups can skip on (pushed down as two comparisons)."""
    d = F.to_date(F.lit(day)) if isinstance(day, str) else day
    start = F.to_timestamp_ntz(F.date_format(d, "yyyy-MM-dd"))
    end = F.to_timestamp_ntz(F.date_format(F.date_add(d, 1), "yyyy-MM-dd"))
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))
