"""Keyed table: latest row of each key, replay, deletes, and writes that follow the batch."""

import os
import random

from pyspark.sql import types as T

from tessera.streaming.keyed_table import KeyedTable, Run, cover

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def make(spark, scratch, **kw):
    return KeyedTable(spark, os.path.join(scratch, "t"), SCHEMA, ["k"], **{"buckets": 4, "fan": 3, **kw})


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_read_is_the_snapshot_after_every_batch(spark, scratch):
    rnd, want, t = random.Random(1), {}, make(spark, scratch)
    for b in [0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11]:                       # batch ids may skip
        rows = {k: f"{b}-{k}" for k in rnd.sample(range(40), 12)}
        gone = [k for k in rnd.sample(range(40), 5) if k not in rows]
        df = spark.createDataFrame(list(rows.items()), SCHEMA)
        before = dict(want)
        want.update(rows)
        for k in gone:
            want.pop(k, None)
        assert t.apply(b, df, spark.createDataFrame([(k,) for k in gone], "k long"))
        assert {r.k: r.v for r in t.read().collect()} == want
        assert {r.k: r.v for r in t.read(upto=b - 1).collect()} == before
        t.compact()
        assert {r.k: r.v for r in t.read().collect()} == want
        some = spark.createDataFrame([(k,) for k in (1, 5, 7, 99)], "k long")
        assert {r.k: r.v for r in t.read(only=some).collect()} == {k: v for k, v in want.items() if k in (1, 5, 7, 99)}
        assert not t.apply(b, df)                                        # a replay writes nothing
    assert len(cover(t.runs())) <= 5                                     # 11 batches in runs of 9, 3 and 1
    t.compact()
    assert t.runs() == cover(t.runs())                                   # replaced runs are gone


def test_a_small_batch_writes_little_and_only_its_buckets(spark, scratch):
    t = make(spark, scratch, buckets=16, fan=4)
    t.apply(0, spark.range(200_000).selectExpr("id k", "cast(id as string) v"))
    whole = size(t.root)
    for b in range(1, 9):
        t.apply(b, spark.createDataFrame([(b, "x")], SCHEMA))
        assert len([d for d in os.listdir(os.path.join(t.root, Run(b, b, 0).path)) if d.startswith("_bucket")]) == 1
        t.compact()
    later = sum(size(os.path.join(t.root, r.path)) for r in t.runs() if r.first > 0)
    assert later < whole / 50
    assert t.read().count() == 200_000
    assert [r.v for r in t.read(only=spark.createDataFrame([(3,)], "k long")).collect()] == ["x"]


def test_incomplete_run_is_not_read_and_is_written_again(spark, scratch):
    t = make(spark, scratch)
    t.apply(0, spark.createDataFrame([(1, "a")], SCHEMA))
    t.apply(1, spark.createDataFrame([(1, "b")], SCHEMA))
    os.remove(os.path.join(t.root, Run(1, 1, 0).path, "_SUCCESS"))      # the job died before its commit
    assert [r.v for r in t.read().collect()] == ["a"]
    assert t.apply(1, spark.createDataFrame([(1, "c")], SCHEMA))
    assert [r.v for r in t.read().collect()] == ["c"]


def test_cover_prefers_wide_runs():
    runs = [Run(0, 3, 1), Run(0, 0, 0), Run(3, 3, 0), Run(4, 4, 0), Run(5, 5, 0)]
    assert cover(runs) == [Run(0, 3, 1), Run(4, 4, 0), Run(5, 5, 0)]
    assert cover(runs, 4) == [Run(0, 3, 1), Run(4, 4, 0)]


def test_empty_table_and_empty_batch(spark, scratch):
    t = make(spark, scratch)
    assert t.read().count() == 0
    t.apply(0, spark.createDataFrame([], SCHEMA))
    assert t.read().count() == 0 and t.has(0)
    t.apply(1, spark.createDataFrame([(4, None)], SCHEMA))
    assert [tuple(r) for r in t.read().collect()] == [(4, None)]
