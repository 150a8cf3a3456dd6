"""Skew operators: same result as the plain plan, and the hot key is spread."""

import os

from pyspark.sql import functions as F

from tessera.operators import skew as S


def skewed(spark, n=30000):
    # key 0 holds a third of the rows
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
                                F.col("id").alias("v"))
    small = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return big, small


def as_set(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_salted_joins_equal_plain_join(spark):
    big, small = skewed(spark)
    plain = as_set(big.join(small, "k"))
    assert as_set(S.skew_split_join(big, small, "k", copies=16)) == plain
    assert as_set(S.replicated_salt_join(big, small, "k", copies=8)) == plain


def test_heavy_key_detected(spark):
    big, _ = skewed(spark)
    assert S.heavy_keys(big, "k", fraction=0.1, top=1).collect()[0].k == 0


def test_salting_spreads_the_hot_key(spark):
    big, small = skewed(spark)
    heavy = S.heavy_keys(big, "k", top=1)
    salted = S.salted_join(big, small, "k", heavy, left_split=16)
    # rows of the hot key land in many distinct (key, salt) groups
    tagged = (big.join(F.broadcast(heavy.select("k")), "k")
              .select(S.row_salt(big, 16).alias("s")).distinct().count())
    assert tagged == 16
    assert salted.where("k = 0").count() == big.where("k = 0").count()


def test_grid_salted_self_join(spark):
    big, _ = skewed(spark, 3000)
    a = big.select("k", F.col("v").alias("va"))
    b = big.select("k", F.col("v").alias("vb"))
    heavy = S.heavy_keys(a, "k", top=2)
    grid = S.salted_join(a, b, "k", heavy, left_split=3, right_split=3)
    assert as_set(grid) == as_set(a.join(b, "k"))


def test_salted_count_equals_count(spark):
    big, _ = skewed(spark)
    want = {r.k: r["count"] for r in big.groupBy("k").count().collect()}
    got = {r.k: r.n for r in S.salted_count(big, "k", salts=10).collect()}
    assert got == want


def test_identical_rows_are_spread(spark):
    keys = spark.range(1000).select(F.lit(1).alias("k")).repartition(8)
    assert keys.select(S.row_salt(keys, 100).alias("s")).distinct().count() > 1


def test_sized_join_equals_plain_join_and_evens_the_cells(spark):
    """A user holding a third of the ratings: cells within 2x of piece_rows squared, results as the plain join."""
    from tessera.operators import matrix as M
    n = 6000
    ratings = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400 + 1).alias("user"),
        (F.col("id") % 997).alias("item"), (F.col("id") % 5 + 1).cast("double").alias("rating")
    ).dropDuplicates(["user", "item"])
    hot = ratings.where("user = 0").count()
    a = ratings.select("user", F.col("item").alias("x"))
    b = ratings.select("user", F.col("item").alias("y"))
    plain = as_set(a.join(b, "user"))
    for count, rows in (("self", 100), ("both", 100), ("left", 50), ("self", 10 ** 6)):
        assert as_set(S.sized_join(a, b, "user", rows, count)) == plain
    pieces = -(-hot // 100)
    sides = a.where("user = 0").select(F.pmod(S.row_salt(a, 1 << 30), F.lit(pieces)).alias("a")).groupBy("a").count().collect()
    assert len(sides) == pieces and max(r["count"] for r in sides) <= 2 * hot / pieces
    whole = sorted(map(tuple, M.item_gram(ratings).collect()))
    assert sorted(map(tuple, M.item_gram(ratings, piece_rows=64).collect())) == whole
    c = sorted(map(tuple, M.cosine_similarity(ratings, min_common=2).collect()))
    assert sorted(map(tuple, M.cosine_similarity(ratings, min_common=2, piece_rows=64).collect())) == c


def test_cosine_of_an_all_zero_item_is_null(spark):
    from tessera.operators import matrix as M
    r = spark.createDataFrame([(1, 10, 0.0), (1, 11, 2.0), (2, 10, 0.0), (2, 11, 4.0)], "user long, item long, rating double")
    assert {(x.i, x.j): x.sim for x in M.cosine_similarity(r).collect()} == {(10, 11): None, (11, 10): None}


def test_views_with_hot_order_and_customer(spark, scratch):
    """edges / pair_events take the split path for a hot order / customer and
    still equal their plain-join definitions."""
    import random
    from tessera.plans import views as V
    rnd = random.Random(2)
    lines, orders = [], []
    for o in range(300):
        orders.append((o, 0 if o < 100 else o % 40 + 1))          # customer 0 owns a third of the orders
    for i in range(6000):
        o = 0 if i % 3 == 0 else rnd.randint(1, 299)             # order 0 holds a third of the lines
        lines.append((o, i, rnd.randint(0, 150), float(rnd.randint(1, 50))))
    sf = os.path.join(scratch, "hot")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double") \
        .write.parquet(os.path.join(sf, "lineitem.parquet"))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(os.path.join(sf, "orders.parquet"))

    assert [r.l_orderkey for r in S.heavy_by_share(spark.read.parquet(os.path.join(sf, "lineitem.parquet")),
                                                     "l_orderkey", 8, fraction=1.0).collect()] == [0]
    li = spark.read.parquet(os.path.join(sf, "lineitem.parquet"))
    x, y = li.alias("x"), li.alias("y")
    plain_edges = (x.join(y, (F.col("x.l_orderkey") == F.col("y.l_orderkey"))
                          & (F.col("x.l_linenumber") < F.col("y.l_linenumber")))
                   .where(F.col("x.l_partkey") != F.col("y.l_partkey"))
                   .select(F.col("x.l_partkey").alias("src"), F.col("y.l_partkey").alias("dst")).distinct())
    assert as_set(V.edges(spark, sf)) == as_set(plain_edges)

    r = V.ratings(spark, sf)
    a, b = r.alias("a"), r.alias("b")
    plain_pairs = (a.join(b, (F.col("a.user") == F.col("b.user")) & (F.col("a.item") < F.col("b.item")))
                   .groupBy(F.col("a.item").alias("item_i"), F.col("b.item").alias("item_j"))
                   .agg(F.sum(F.least("a.rating", "b.rating")).alias("rating"), F.count(F.lit(1)).alias("n_ij")))
    assert as_set(V.pair_events(spark, sf)) == as_set(plain_pairs)


def test_heavy_hitters_miss_no_key_above_the_share(spark):
    """Keys just above and just below one row in 50 among very many rare ones, some keys null, in odd partitions."""
    share, total = 50, 60_000
    want, rows = {}, []
    for i, n in enumerate([total // share + 1, total // share + 2, total // share, total // share - 1, 5000]):
        rows += [(None if i == 4 else f"k{i}", i % 2)] * n
        if n * share > total:
            want[(None if i == 4 else f"k{i}", i % 2)] = n
    rows += [(f"rare{j}", 0) for j in range(total - len(rows))]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k string, b int").repartition(parts)
        assert {(r.k, r.b): r.n for r in S.heavy_hitters(df, ["k", "b"], share).collect()} == {k: n for k, n in want.items()}
        assert df.count() == total
    assert S.heavy_hitters(spark.createDataFrame([], "k string, b int"), "k", 10).count() == 0
    plan = S.heavy_hitters(df, "k", share)._jdf.queryExecution().executedPlan().toString()
    assert "Sample" not in plan


def test_copies_of_the_small_side_are_not_broadcast(spark):
    """The planner's estimate of the small side is that before its copies are made."""
    big = spark.range(1000).selectExpr("id % 7 k", "id v")
    small = spark.range(7).selectExpr("id k", "id * 10 w")
    df = S.replicated_salt_join(big, small, "k", copies=50)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert as_set(df) == as_set(big.join(small, "k"))


def test_large_tables_are_cut_by_rows(spark, monkeypatch):
    """Join, aggregate and distinct of the shared views get partitions by their rows; the rows are the same."""
    from tessera.operators import skew
    from tessera.plans import registry
    from tests.conftest import SF_SMALL
    registry.load_all()
    assert skew.tasks_for(spark, skew.TASK_ROWS) is None
    assert skew.tasks_for(spark, 100 * skew.TASK_ROWS + 1) == 101
    names = ("s7_read_similarity", "m1_to_matrix", "m2_transpose", "m3_matmul")
    rows = lambda name: sorted(map(tuple, registry.QUERIES[name](spark, SF_SMALL).collect()))
    whole = {name: rows(name) for name in names}
    monkeypatch.setattr(skew, "TASK_ROWS", 200)
    n = -(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 200)
    plan = registry.QUERIES["m1_to_matrix"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in plan
    plan = registry.QUERIES["s7_read_similarity"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 4                  # both sides of the pair join, both distincts
    for name in names:
        assert rows(name) == whole[name], name
