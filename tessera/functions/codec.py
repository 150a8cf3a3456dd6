"""Hashing, hex, encryption and gzip columns.

Everything but gzip is a built-in expression.  Spark has no gzip function,
so F10 is an Arrow ``pandas_udf``: one call per batch of rows, never per row.
"""

from __future__ import annotations

import base64
import gzip

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_hex(c) -> Column:
    """MD5 of the UTF-8 text as lower-case hex without leading zeros."""
    stripped = F.regexp_replace(F.md5(_c(c)), "^0+", "")
    return F.when(_c(c).isNull(), F.lit(None)).otherwise(
        F.coalesce(F.nullif(stripped, F.lit("")), F.lit("0")))


def hex_encode(c) -> Column:
    """bytes (or the UTF-8 bytes of text) as lower-case hex."""
    return F.lower(F.hex(_c(c)))


def hex_decode(c) -> Column:
    """F8: trimmed hex text -> bytes; odd length or a non-hex char -> null."""
    t = F.trim(_c(c))
    ok = (F.length(t) % 2 == 0) & t.rlike("^[0-9a-fA-F]*$")
    return F.when(ok, F.unhex(t))


def encrypt_column(c, key: str, mode: str = "GCM") -> Column:
    """AES (key of 16/24/32 bytes given by the caller) -> lower-case hex."""
    return F.lower(F.hex(F.aes_encrypt(_c(c), F.lit(key), F.lit(mode))))


def decrypt_column(c, key: str, mode: str = "GCM") -> Column:
    """inverse of ``encrypt_column``."""
    return F.aes_decrypt(F.unhex(_c(c)), F.lit(key), F.lit(mode)).cast("string")


@F.pandas_udf(T.StringType())
def _gzip_b64(s: pd.Series) -> pd.Series:
    def one(v):
        if v is None or v == "":
            return v
        return base64.b64encode(gzip.compress(v.encode("utf-8"), mtime=0)).decode("ascii")
    return s.map(one)


@F.pandas_udf(T.StringType())
def _gunzip_b64(s: pd.Series) -> pd.Series:
    def one(v):
        if v is None or v == "":
            return ""
        return gzip.decompress(base64.b64decode(v)).decode("utf-8")
    return s.map(one)


def gzip_column(c) -> Column:
    """text -> gzip -> base64; null and '' pass through."""
    return _gzip_b64(_c(c))


def gunzip_column(c) -> Column:
    """base64 -> gunzip -> text; null and '' give ''."""
    return _gunzip_b64(_c(c))
