"""A table of one row per key, changed batch by batch.

Log-structured: a batch writes its rows, and a mark for keys it deletes, as one run of
Parquet files in the buckets of its keys; nothing else is touched.  A read takes the
newest row of each key over all runs.  When ``fan`` neighbouring runs of one level
have gathered they are merged into one run of the next level, so a row is rewritten
once per level, a number of times that grows with the logarithm of the batches and not with
the table.  Delete marks end in the merge that holds the oldest run.

Runs are folders ``level=L/first=A/last=B/_bucket=K``, complete once Spark's ``_SUCCESS`` is
there.  A batch that is complete is not written again, so a replay changes nothing; an
incomplete one is overwritten.  Runs that a merge has replaced stay until the next
``compact``, for readers that have begun.  Folders are listed and removed through
Hadoop's file system, the one Spark writes to.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Runs of one level that are merged into one.
FAN = 4
BUCKETS = 64
_PLACE = T.StructType([T.StructField("_gone", T.BooleanType()), T.StructField("level", T.IntegerType()),
                       T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                       T.StructField("_bucket", T.IntegerType())])


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int
    level: int

    @property
    def path(self) -> str:
        return f"level={self.level}/first={self.first}/last={self.last}"


def cover(runs: list[Run], upto: int | None = None) -> list[Run]:
    """Runs that together hold every batch up to ``upto`` once: the newest first, the widest of those that end alike."""
    out: list[Run] = []
    for r in sorted((r for r in runs if upto is None or r.last <= upto), key=lambda r: (-r.last, r.first)):
        if not out or r.last < out[-1].first:
            out.append(r)
    return out[::-1]


class KeyedTable:
    """``schema`` with ``keys``; ``bucket_by`` (some of the keys) says what a lookup is by."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str],
                 bucket_by: list[str] | None = None, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.bucket_by, self.buckets, self.fan = bucket_by or keys, buckets, fan

    # -- folders --------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[Run]:
        """Complete runs."""
        pattern, fs = self._fs(f"{self.root}/level=*/first=*/last=*/_SUCCESS")
        found = [str(s.getPath().toString()) for s in fs.globStatus(pattern) or []]
        parts = [re.search(r"level=(\d+)/first=(\d+)/last=(\d+)/_SUCCESS$", f) for f in found]
        return sorted(Run(int(m[2]), int(m[3]), int(m[1])) for m in parts)

    def _remove(self, run: Run) -> None:
        path, fs = self._fs(f"{self.root}/{run.path}")
        fs.delete(path, True)

    # -- reading --------------------------------------------------------------

    def bucket(self):
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def _rows(self, runs: list[Run]) -> DataFrame:
        full = T.StructType([*self.schema.fields, *_PLACE.fields])
        if not runs:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", self.root).parquet(*[f"{self.root}/{r.path}" for r in runs])

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [f.name for f in self.schema.fields if f.name not in self.keys] + ["_gone"]
        best = F.max_by(F.struct(*values), "last").alias("_v")     # a key has one row per run, and runs do not overlap
        return rows.groupBy(*self.keys).agg(best).select(*self.keys, *[F.col(f"_v.{v}").alias(v) for v in values])

    def read(self, upto: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The table after batch ``upto`` (default: the last).  ``only`` (columns ``bucket_by``): rows of these alone,
        from their buckets; at most ``buckets`` numbers come to the driver for that."""
        rows = self._rows(cover(self.runs(), upto))
        if only is not None:
            wanted = only.select(*self.bucket_by).distinct()
            numbers = [r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect()]
            rows = rows.where(F.col("_bucket").isin(numbers)) if numbers else rows.where(F.lit(False))
            rows = rows.join(wanted, self.bucket_by, "left_semi")
        return self._newest(rows).where(~F.col("_gone")).select(*self.schema.fieldNames())

    def has(self, batch: int) -> bool:
        return any(r.first <= batch <= r.last for r in self.runs())

    def require_before(self, batch: int) -> None:
        """State is never dropped in silence: only the first batch of a stream may find no earlier run."""
        if batch > 0 and not any(r.first < batch for r in self.runs()):
            raise FileNotFoundError(f"{self.root} has no run before batch {batch}; refusing to start afresh")

    # -- writing --------------------------------------------------------------

    def _write(self, rows: DataFrame, run: Run) -> None:
        out = rows.select(*self.schema.fieldNames(), "_gone", self.bucket().alias("_bucket"))
        (out.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/{run.path}"))

    def apply(self, batch: int, rows: DataFrame, deleted: DataFrame | None = None) -> bool:
        """Write ``rows`` (one per key) and delete the keys of ``deleted`` as batch ``batch``; False if it is there already."""
        if self.has(batch):
            return False
        rows = rows.select(*self.schema.fieldNames()).withColumn("_gone", F.lit(False))
        if deleted is not None:
            gone = deleted.select(*[F.col(k) if k in self.keys else F.lit(None).cast(f.dataType).alias(k)
                                    for k, f in zip(self.schema.fieldNames(), self.schema.fields)])
            rows = rows.unionByName(gone.withColumn("_gone", F.lit(True)))
        self._write(rows, Run(batch, batch, 0))
        return True

    def compact(self) -> None:
        """Remove runs replaced before, then merge as long as ``fan`` neighbours of one level stand at the end."""
        runs = self.runs()
        live = cover(runs)
        for run in set(runs) - set(live):
            self._remove(run)
        while len(live) >= self.fan and len({r.level for r in live[-self.fan:]}) == 1:
            part, rest = live[-self.fan:], live[:-self.fan]
            merged = Run(part[0].first, part[-1].last, part[0].level + 1)
            rows = self._newest(self._rows(part))
            self._write(rows if rest else rows.where(~F.col("_gone")), merged)
            live = rest + [merged]
