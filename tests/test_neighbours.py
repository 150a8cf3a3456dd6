"""Nearest items by inverted index = all pairs filtered, from fewer candidates; a hot user is cut into cells."""

import random

from pyspark.sql import functions as F

from tessera.operators import matrix as M
from tessera.operators import neighbours as N


def world(spark, seed, users=120, items=90, hot=True):
    """Items of few tastes (so some are alike), one user who rated everything, some zero and lone ratings."""
    rnd = random.Random(seed)
    rows = {}
    for i in range(items):
        taste = [(i % 9 * 13 + d) % users for d in range(10)]
        for u in rnd.sample(taste, rnd.randint(1, 9)) + rnd.sample(range(users), rnd.randint(0, 4)):
            rows[u, i] = float(rnd.choice([0, 1, 2, 3, 4, 5]))
    if hot:
        rows |= {(1000, i): 1.0 for i in range(items)}
    rows[7, 500] = 2.0
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")


def as_map(df):
    return {(r.i, r.j): round(r.sim, 9) for r in df.collect()}


def test_similar_items_equal_all_pairs_filtered(spark):
    for seed in (1, 2):
        r = world(spark, seed)
        every = M.cosine_similarity(r).where("sim is not null")
        for t in (0.95, 0.7, 0.4, 0.05):
            assert as_map(N.similar_items(r, t, piece_rows=16)) == as_map(every.where(F.col("sim") >= t))
        two = M.cosine_similarity(r, min_common=2).where("sim >= 0.4")
        assert as_map(N.similar_items(r, 0.4, min_common=2)) == as_map(two)


def test_bounds_leave_few_candidates(spark):
    r = world(spark, 3, users=2000, items=300)
    index = N.entries(r)
    meet = M.gram_off_diagonal(r).count() // 2          # all pairs with a common user: the hot one makes all of them
    kept = N.candidates(index, 0.6).count()
    right = N.similar_items(r, 0.6).count() // 2
    assert right <= kept < meet / 10


def test_nearest_items_equal_all_pairs_cut(spark):
    r = world(spark, 4)
    every = M.cosine_similarity(r).where("sim > 0")
    for k in (1, 5, 200):
        want = as_map(M.mirror(every.where("i < j"), ["sim"]).withColumn("_r", F.row_number().over(
            N.Window.partitionBy("i").orderBy(F.desc("sim"), "j"))).where(F.col("_r") <= k).drop("_r"))
        assert as_map(N.nearest_items(r, k)) == want


def test_empty_and_lone(spark):
    none = spark.createDataFrame([], "user long, item long, rating double")
    assert N.similar_items(none, 0.5).count() == 0 and N.nearest_items(none, 3).count() == 0
    one = spark.createDataFrame([(1, 1, 5.0), (2, 2, 0.0)], "user long, item long, rating double")
    assert N.similar_items(one, 0.5).count() == 0


def test_meetings_are_dealt_packed_and_few_are_left(spark):
    """Low threshold, ratings without a pattern: prefixes are nearly whole items, and still few pairs are rows."""
    rnd = random.Random(9)
    r = spark.createDataFrame([(u, i, float(rnd.randint(1, 50))) for i in range(300) for u in rnd.sample(range(1500), 30)], "user long, item long, rating double")
    left = N.candidates(N.entries(r), 0.15)
    assert "FlatMapGroupsInArrow" in left._jdf.queryExecution().executedPlan().toString()
    assert as_map(N.similar_items(r, 0.15, min_common=2)) == as_map(M.cosine_similarity(r, min_common=2).where("sim >= 0.15"))
    assert left.count() < M.gram_off_diagonal(r).count() / 2 / 10
    every = M.cosine_similarity(r, min_common=2).where("sim > 0")
    want = as_map(every.withColumn("_r", F.row_number().over(N.Window.partitionBy("i").orderBy(F.desc("sim"), "j"))).where("_r <= 3").drop("_r"))
    assert as_map(N.nearest_items(r, 3, min_common=2)) == want
