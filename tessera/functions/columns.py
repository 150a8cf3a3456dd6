"""Per-column functions, all built-in Spark expressions.

They return ``Column`` objects (or take and return a DataFrame where the
function works on a whole row), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import trunc4  # noqa: F401  (F19 lives with A4)

# Default threshold of the 0/1 flag and the hash bucket count.
FLAG_THRESHOLD = 0.5
HASH_BUCKETS = 10000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(c) -> Column:
    """non-empty and every character a Unicode decimal digit; null -> false."""
    return F.coalesce(_c(c).rlike(r"\A\p{Nd}+\z"), F.lit(False))


def java_split(c, sep: str = ",") -> Column:
    """``split`` that drops trailing empty fields, as the JVM's String.split.

    ``sep`` is a regex.  A string made only of separators gives [].
    """
    col = _c(c)
    trimmed = F.regexp_replace(col, f"(?:{sep})+$", "")
    return F.when(col.rlike(f"^(?:{sep})+$"), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, sep))


def case_flag(c, threshold: float = FLAG_THRESHOLD) -> Column:
    """1 when c > threshold else 0."""
    return F.when(_c(c) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def cast_numeric_double(df: DataFrame) -> DataFrame:
    """every non-string column cast to double; column order kept."""
    return df.select(*[F.col(n) if t == "string" else F.col(n).cast("double").alias(n)
                       for n, t in df.dtypes])


def hash_bucket(c, buckets: int = HASH_BUCKETS) -> Column:
    """``abs(hash(c) % buckets)`` as text (Murmur3, Spark's ``hash``)."""
    return F.abs(F.hash(_c(c)) % F.lit(buckets)).cast("string")


def mod_label(c, m: int = 2) -> Column:
    """``id % m`` of a textual id."""
    return _c(c).cast("bigint") % F.lit(m)


def clean_transaction(c) -> Column:
    """F16: drop parentheses, commas -> blanks, ``:digits `` -> blank."""
    s = F.regexp_replace(_c(c), r"[()]", "")
    s = F.regexp_replace(s, ",", " ")
    return F.regexp_replace(s, r":[0-9]{1,10} ", " ")


def tokens_unique(c, sep: str = " ") -> Column:
    """true when the ``sep``-separated tokens are all different."""
    t = java_split(c, sep)
    return F.size(F.array_distinct(t)) == F.size(t)


def has_error(c) -> Column:
    """the text, once "BindException" is removed, contains ERROR or EXCEPTION in any case."""
    probe = F.upper(F.replace(_c(c), F.lit("BindException"), F.lit("")))
    return probe.contains("ERROR") | probe.contains("EXCEPTION")


def error_filter(df: DataFrame, name: str, content: str) -> DataFrame:
    """keep files whose text ``has_error``; output ``name:\\ncontent`` (original text)."""
    return (df.where(has_error(content))
            .select(F.concat(F.col(name), F.lit(":\n"), F.col(content)).alias("report")))


def first_char(c) -> Column:
    """the first character."""
    return F.substring(_c(c), 1, 1)


def from_third_char(c) -> Column:
    """text from the third character on."""
    return F.substr(_c(c), F.lit(3))


def rand_column(seed: int) -> Column:
    """uniform [0, 1) with a seed."""
    return F.rand(seed)


def drop_nulls(df: DataFrame) -> DataFrame:
    """drop rows with any null."""
    return df.dropna(how="any")


def fill_default(c, default) -> Column:
    """missing value -> constant."""
    return F.coalesce(_c(c), F.lit(default))
