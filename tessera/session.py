"""Session helpers: a local session for tests and benches, and the
checkpoint directory rule used by iterative jobs (PageRank, streaming)
and by tables that several steps share.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tessera", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local session configured the way tests and ``bench.py`` run.

    On a cluster, build the session yourself: nothing in the library depends
    on these settings except AQE being on (Spark's default).
    """
    n = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(n))
         .config("spark.default.parallelism", str(n))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or an already set
    SparkContext checkpoint dir).  Only when it is unset *and* the master is
    local (tests, benches) do we create one under the temp folder; on a
    cluster an unset value is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared (HDFS/S3) folder for it")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf)
        except Exception:  # noqa: BLE001 - core confs may be read-only at run time
            pass
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


#: Paths that the open ``scratch`` blocks of this thread own, the innermost last.
_OWNED: ContextVar[tuple[list[str], ...]] = ContextVar("tessera_owned", default=())


def owned(path: str) -> str:
    """``path``, to be deleted at the end of the innermost open ``scratch`` block, if there is one."""
    blocks = _OWNED.get()
    if blocks:
        blocks[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark wrote it to; none there is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the helper tables that operators write to the shared folder inside this block.

    DataFrames are lazy, so an operator cannot know when its helper tables were read for the last time;
    the caller does: once the result is written.  The tables go at the end of the block, also
    after an error; a DataFrame made inside must not be read behind it.
    """
    paths: list[str] = []
    token = _OWNED.set((*_OWNED.get(), paths))
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            remove(spark, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back.

    Cuts lineage: all readers, and any retried task, see the same rows.
    The table stays unless a ``scratch`` block is open; the shuffle files of its computation go with the write.
    """
    spark = df.sparkSession
    path = owned(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


#: Logical operators that are worth more than reading a stored table again.
_DEAR = re.compile(r"^[\s:+|-]*(Join|Aggregate|Window|Sort|Generate|Repartition\w*|RebalancePartitions|Distinct|MapIn\w+|Deserialize\w*)\b", re.M)


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` for a caller that reads it several times: a plan of scans, filters and projections as it
    is, anything that joins or aggregates as a ``shared_table``, computed once."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return shared_table(df, name) if _DEAR.search(plan) else df


def drop_shared(df: DataFrame) -> None:
    """Delete the files behind a table of ``shared_table``."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
