"""Shared-folder tables and small helpers used by the operators here.

Intermediate results that are read more than once, or that end an iterative
round, are written as Parquet under the folder the cluster names in
``spark.checkpoint.dir``.  A lost executor then costs only its own tasks.
"""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, owned

#: ``[\x20\x09-\x0D]`` is the white space of every word rule here.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else the rule of ``checkpoint_dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or checkpoint_dir(spark)).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes with the caller's ``scratch`` block."""
    return owned(f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a table made by ``materialize``."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    have, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in have:
        name = f"_{name}"
    return name


def word_blocks(data: bytes, size: int = 1 << 21) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut only at white space."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = cut.start() if cut else len(data)
        yield data if at == 0 and end == len(data) else data[at:end]
        at = end


def utf8(arr) -> list:
    """Python bytes (or None) of an Arrow string array, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(arr.type) else pa.binary()
    return arr.cast(kind).to_pylist()


def text_groups(arr, rows: int = 250) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a string array, a few rows at a time; null as empty.

    Only one group is held as Python objects, and unused memory goes back to
    the system after each array, so a worker stays small however long it lives.
    """
    for at in range(0, len(arr), rows):
        yield at, [t or b"" for t in utf8(arr.slice(at, rows))]
    give_back()


def give_back() -> None:
    """Return what Arrow's and the C library's allocators hold unused to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def spread(rid, buckets):
    """Bucket of a row id: an even, repeatable split of any group of rows."""
    return F.pmod(F.xxhash64(rid), F.lit(buckets) if isinstance(buckets, int) else buckets)
