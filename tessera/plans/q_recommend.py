"""Queries: matrices and the item-based recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import matrix as M
from tessera.operators import neighbours as N
from tessera.operators import recommend as R
from tessera.plans.registry import query
from tessera.plans.views import ratings, view
from tessera.session import shared_table
from tessera.sources.tables import table

# Parameters of the registered recommender run.
MIN_COMMON = 2                       # co-raters needed for a similarity
NEIGHBOURS = R.DEFAULT_NEIGHBOURS    # reference keeps 100 neighbours per item

_SIM_SQL = """
sim_up AS (
  SELECT a.item AS i, b.item AS j, sum(a.rating * b.rating) AS g, count(*) AS n
  FROM ratings a JOIN ratings b ON a."user" = b."user" AND a.item < b.item
  GROUP BY a.item, b.item HAVING count(*) >= {mc}),
sim_norm AS (SELECT item, sum(rating * rating) AS nn FROM ratings GROUP BY item),
sim_half AS (
  SELECT u.i, u.j, u.g / sqrt(x.nn * y.nn) AS sim
  FROM sim_up u JOIN sim_norm x ON x.item = u.i JOIN sim_norm y ON y.item = u.j),
sim AS (SELECT i, j, sim FROM sim_half UNION ALL SELECT j AS i, i AS j, sim FROM sim_half)
""".format(mc=MIN_COMMON)

_MEANS_SQL = """
means AS (SELECT item, trunc(sum(rating) / count(rating) * 10000) / 10000 AS mean
          FROM ratings GROUP BY item)"""

_PREDICT_SQL = """
nb AS (SELECT i, j, sim FROM (
         SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rn FROM sim)
       WHERE rn <= {k}),
{means},
diff AS (SELECT r.item AS j, r."user", r.rating - coalesce(m.mean, 3.4952) AS diff
         FROM ratings r LEFT JOIN means m ON r.item = m.item),
terms AS (SELECT d."user", nb.i,
                 CAST(trunc(nb.sim * d.diff * 10000) AS BIGINT) AS num,
                 CAST(trunc(nb.sim * 10000) AS BIGINT) AS den
          FROM nb JOIN diff d ON nb.j = d.j),
sums AS (SELECT "user", i, CAST(sum(num) AS BIGINT) AS num, CAST(sum(den) AS BIGINT) AS den
         FROM terms GROUP BY "user", i),
pred AS (SELECT s."user", s.i AS item,
                coalesce(m.mean, 3.4952)
                + coalesce(CASE WHEN s.den = 0 THEN NULL ELSE s.num / s.den END, 0.0) AS score
         FROM sums s LEFT JOIN means m ON s.i = m.item)
""".format(k=NEIGHBOURS, means=_MEANS_SQL)

# test pairs: every (customer, part) of a returned line item
_TEST_PAIRS_SQL = """
test_pairs AS (SELECT DISTINCT o_custkey AS "user", l_partkey AS item
               FROM orders JOIN lineitem ON o_orderkey = l_orderkey
               WHERE l_returnflag = 'R')"""


def stored_ratings(spark, sf):
    """The ratings view, computed once for all parts of a query that read it."""
    return shared_table(ratings(spark, sf), "ratings")


def similarity(spark, sf, r=None):
    return M.cosine_similarity(ratings(spark, sf) if r is None else r, min_common=MIN_COMMON)


def test_pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return (o.join(li.where(F.col("l_returnflag") == "R"), o.o_orderkey == li.l_orderkey)
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).distinct())


@query("a4_mean_per_key", views=("ratings",), oracle=f"WITH {_MEANS_SQL} SELECT item, mean FROM means")
def a4_mean_per_key(spark, sf):
    return R.item_mean(ratings(spark, sf))


@query("r1_item_mean", views=("ratings",), oracle=f"WITH {_MEANS_SQL} SELECT item, mean FROM means")
def r1_item_mean(spark, sf):
    return R.item_mean(ratings(spark, sf))


@query("r2_rating_deviation", views=("ratings",), oracle=f"""
WITH {_MEANS_SQL}
SELECT r.item, r."user", r.rating - coalesce(m.mean, 3.4952) AS diff
FROM ratings r LEFT JOIN means m ON r.item = m.item""")
def r2_rating_deviation(spark, sf):
    r = ratings(spark, sf)
    return R.rating_deviation(r, R.item_mean(r))


@query("m1_to_matrix", views=("ratings",), oracle="""
SELECT CAST("user" AS BIGINT) AS i, CAST(item AS BIGINT) AS j, sum(rating) AS v
FROM ratings GROUP BY 1, 2""")
def m1_to_matrix(spark, sf):
    return M.to_matrix(ratings(spark, sf), "user", "item", "rating")


@query("m2_transpose", views=("ratings",), oracle="""
SELECT CAST(item AS BIGINT) AS i, CAST("user" AS BIGINT) AS j, sum(rating) AS v
FROM ratings GROUP BY 1, 2""")
def m2_transpose(spark, sf):
    return M.transpose(M.to_matrix(ratings(spark, sf), "user", "item", "rating"))


def _part_brand_size(spark, sf):
    p = table(spark, sf, "part")
    return M.to_matrix(p.select("p_partkey", F.substring("p_brand", 7, 8).cast("bigint").alias("b"),
                                "p_size"), "p_partkey", "b", "p_size")


@query("m3_matmul", views=("ratings",), oracle="""
WITH b AS (SELECT p_partkey AS i, CAST(substr(p_brand, 7) AS BIGINT) AS j,
                  sum(CAST(p_size AS DOUBLE)) AS v FROM part GROUP BY 1, 2)
SELECT r."user" AS i, b.j, sum(r.rating * b.v) AS v
FROM ratings r JOIN b ON r.item = b.i GROUP BY 1, 2""")
def m3_matmul(spark, sf):
    """user x part ratings times part x brand sizes -> user x brand."""
    a = M.to_matrix(ratings(spark, sf), "user", "item", "rating")
    return M.matmul(a, _part_brand_size(spark, sf))


_GRAM_SQL = """
WITH up AS (SELECT a.item AS i, b.item AS j, sum(a.rating * b.rating) AS v
            FROM ratings a JOIN ratings b ON a."user" = b."user" AND a.item < b.item
            GROUP BY a.item, b.item)
SELECT i, j, v FROM up UNION ALL SELECT j AS i, i AS j, v FROM up
UNION ALL SELECT item AS i, item AS j, sum(rating * rating) AS v FROM ratings GROUP BY item"""


@query("m4_item_gram", views=("ratings",), oracle=_GRAM_SQL)
def m4_item_gram(spark, sf):
    return M.item_gram(ratings(spark, sf))


@query("m5_split_diagonal", views=("ratings",), oracle="""
SELECT item AS i, item AS j, sum(rating * rating) AS v FROM ratings GROUP BY item""")
def m5_split_diagonal(spark, sf):
    return M.gram_diagonal(ratings(spark, sf)).drop("n")


@query("m5_off_diagonal", views=("ratings",), oracle="""
WITH up AS (SELECT a.item AS i, b.item AS j, sum(a.rating * b.rating) AS v
            FROM ratings a JOIN ratings b ON a."user" = b."user" AND a.item < b.item
            GROUP BY a.item, b.item)
SELECT i, j, v FROM up UNION ALL SELECT j AS i, i AS j, v FROM up""")
def m5_off_diagonal(spark, sf):
    return M.gram_off_diagonal(ratings(spark, sf)).drop("n")


@query("m6_cosine_similarity", views=("ratings",), oracle=f"WITH {_SIM_SQL} SELECT i, j, sim FROM sim")
def m6_cosine_similarity(spark, sf):
    return similarity(spark, sf)


@query("m7_preference_scores", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}
SELECT r."user" AS "user", s.i AS item, round(sum(s.sim * r.rating), 6) AS score
FROM sim s JOIN ratings r ON s.j = r.item GROUP BY r."user", s.i""")
def m7_preference_scores(spark, sf):
    r = stored_ratings(spark, sf)
    p = M.preference_scores(similarity(spark, sf, r), r)
    return p.select("user", "item", F.round("score", 6).alias("score"))


#: Threshold and number of neighbours of the queries through the inverted index.
SIMILAR_FROM = 0.15
NEAREST = 10


@query("m6_similar_items", views=("ratings",), oracle=f"WITH {_SIM_SQL} SELECT i, j, sim FROM sim WHERE sim >= {SIMILAR_FROM}")
def m6_similar_items(spark, sf):
    """The similarities of ``m6`` from ``SIMILAR_FROM`` on, through prefixes instead of all pairs."""
    return N.similar_items(stored_ratings(spark, sf), SIMILAR_FROM, min_common=MIN_COMMON)


@query("a6_nearest_items", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}
SELECT i, j, sim FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rn FROM sim) WHERE rn <= {NEAREST}""")
def a6_nearest_items(spark, sf):
    return N.nearest_items(stored_ratings(spark, sf), NEAREST, min_common=MIN_COMMON)


@query("a6_top_k_per_key", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}
SELECT i, j, sim FROM (
  SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rn FROM sim)
WHERE rn <= {NEIGHBOURS}""")
def a6_top_k_per_key(spark, sf):
    return R.top_neighbours(similarity(spark, sf), NEIGHBOURS)


@query("r3_predict", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}, {_PREDICT_SQL}
SELECT "user", item, score FROM pred""")
def r3_predict(spark, sf):
    r = stored_ratings(spark, sf)
    return R.predict(r, similarity(spark, sf, r), k=NEIGHBOURS)


@query("r4_score_test_pairs", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}, {_PREDICT_SQL}, {_TEST_PAIRS_SQL}
SELECT t."user", t.item, coalesce(p.score, 3.4952) AS score
FROM test_pairs t LEFT JOIN pred p ON t."user" = p."user" AND t.item = p.item""")
def r4_score_test_pairs(spark, sf):
    r = stored_ratings(spark, sf)
    return R.predict_pairs(test_pairs(spark, sf), r, similarity(spark, sf, r), k=NEIGHBOURS)


@query("a5_sum_pair_per_key", views=("ratings",), oracle=f"""
WITH {_SIM_SQL}, {_PREDICT_SQL}
SELECT "user", i, num, den FROM sums""")
def a5_sum_pair_per_key(spark, sf):
    """The (numerator, denominator) sums of ``predict`` in 1e-4 units."""
    from tessera.operators.aggregates import sum_pair_per_key, trunc4_units
    from tessera.operators.skew import sized_join
    r = stored_ratings(spark, sf)
    diff = R.rating_deviation(r, R.item_mean(r)).select(F.col("item").alias("j"), "user", "diff")
    terms = (sized_join(diff, R.top_neighbours(similarity(spark, sf, r), NEIGHBOURS), "j", count="left")
             .select("user", "i", trunc4_units(F.col("sim") * F.col("diff")).alias("num"),
                     trunc4_units(F.col("sim")).alias("den")))
    return sum_pair_per_key(terms, ["user", "i"], "num", "den", names=("num", "den"))


_ = view  # views are used by other modules through the same import
