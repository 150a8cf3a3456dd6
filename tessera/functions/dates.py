"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two day formats and the access-log time pattern.
DAY_DASH = "yyyy-MM-dd"
DAY_SLASH = "yyyy/MM/dd"
ACCESS_LOG_TIME = "'['dd/MMM/yyyy:HH:mm:ss Z']'"   # brackets quoted: Spark reads [..] as optional


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plus_days(c, days) -> Column:
    """add ``days`` (may be negative) calendar days; time of day kept."""
    d = days if isinstance(days, Column) else F.lit(int(days))
    return F.timestamp_add("DAY", d, _c(c))


def format_day(c, pattern: str = DAY_DASH) -> Column:
    """day text; a null input means now."""
    return F.date_format(F.coalesce(_c(c), F.localtimestamp()), pattern)


def parse_time(c, pattern: str = ACCESS_LOG_TIME) -> Column:
    """text -> timestamp with ``pattern`` (English month names); bad text -> null."""
    return F.try_to_timestamp(_c(c), F.lit(pattern))


def day_before(day: str) -> Column:
    """The day before ``day`` (``yyyy-MM-dd``) as a date literal."""
    return F.date_sub(F.to_date(F.lit(day)), 1)
