"""Item-based recommender.

``predict`` is one DataFrame plan:

    top-k neighbours per item (window with WindowGroupLimit) + item mean
      JOIN rating deviations on the neighbour item
      -> per (user, item) sums of 4-decimal-truncated terms -> score

Truncated terms are summed as integer counts of 1e-4 (``trunc4_units``):
the sum is then exact, so the score does not depend on how Spark splits
and orders the partial sums, and it is the same number on any cluster size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import mean_per_key, top_k_per_key, trunc4_units
from tessera.operators.skew import sized_join
from tessera.session import stored_once

# Fixed values of the reference recommender: default item mean, neighbours.
DEFAULT_MEAN = 3.4952
DEFAULT_NEIGHBOURS = 100


def item_mean(ratings: DataFrame, item: str = "item", rating: str = "rating") -> DataFrame:
    """R1 = A4: ``(item, mean)`` truncated to 4 decimals."""
    return mean_per_key(ratings.select(item, rating), item, rating, name="mean")


def rating_deviation(ratings: DataFrame, means: DataFrame, default_mean: float = DEFAULT_MEAN,
                     user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """R2: ``(item, user, diff = rating - mean)``; unknown item -> default mean.

    The means table has one row per item; the planner (AQE) broadcasts it
    when its measured size is under the broadcast threshold and falls back
    to a shuffle join otherwise.
    """
    r = ratings.select(F.col(item).alias("item"), F.col(user).alias("user"), F.col(rating).alias("rating"))
    m = means.select(F.col("item"), F.col("mean"))
    return (r.join(m, "item", "left")
            .select("item", "user",
                    (F.col("rating") - F.coalesce(F.col("mean"), F.lit(DEFAULT_MEAN if default_mean is None
                                                                       else default_mean))).alias("diff")))


def top_neighbours(sim: DataFrame, k: int = DEFAULT_NEIGHBOURS) -> DataFrame:
    """A6 on similarities: per item i the k largest ``sim`` (ties: smaller j)."""
    return top_k_per_key(sim.select("i", "j", "sim"), "i", "sim", k, tie="j")


def predict(ratings: DataFrame, sim: DataFrame, k: int = DEFAULT_NEIGHBOURS,
            default_mean: float = DEFAULT_MEAN, user: str = "user", item: str = "item",
            rating: str = "rating") -> DataFrame:
    """``score(u, i) = mean_i + sum_j t(sim_ij * diff_uj) / sum_j t(sim_ij)``

    over the k nearest neighbours j of i that u rated; ``t`` truncates to 4
    decimals per term.  A zero weight sum gives the item mean (the
    reference divides by zero).  Output ``(user, item, score)``.

    Neighbour items rated by very many users are cut into cells by their
    number of raters (``sized_join``).
    """
    r = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).alias("rating"))
    r = stored_once(r, "ratings")          # read for the means and for the deviations
    means = item_mean(r)
    diff = rating_deviation(r, means, default_mean).select(F.col("item").alias("j"), "user", "diff")
    # the item mean rides along from the (small) neighbour table, so the
    # large per-(user, item) result needs no join of its own afterwards
    m = means.select(F.col("item").alias("i"), F.col("mean"))
    nb = (top_neighbours(sim, k).join(m, "i", "left")
          .withColumn("mean", F.coalesce(F.col("mean"), F.lit(default_mean))))
    joined = sized_join(diff, nb, "j", count="left")
    terms = joined.select("user", "i", "mean",
                          trunc4_units(F.col("sim") * F.col("diff")).alias("num"),
                          trunc4_units(F.col("sim")).alias("den"))
    sums = terms.groupBy("user", "i", "mean").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    return sums.select("user", F.col("i").alias("item"),
                       (F.col("mean") + F.coalesce(F.try_divide(F.col("num"), F.col("den")), F.lit(0.0))).alias("score"))


def predict_pairs(pairs: DataFrame, ratings: DataFrame, sim: DataFrame, k: int = DEFAULT_NEIGHBOURS,
                  default_mean: float = DEFAULT_MEAN, user: str = "user", item: str = "item",
                  rating: str = "rating") -> DataFrame:
    """``predict`` for the asked (user, item) pairs only; a pair without terms -> ``default_mean``.

    Each pair meets its item's at most ``k`` neighbours and then the asked
    user's rating of that neighbour, so nothing outside the asked pairs is
    shuffled and the work is at most ``k`` rows per pair.
    """
    asked = pairs.select(F.col(user).alias("user"), F.col(item).alias("i")).distinct()
    r = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).alias("rating"))
    means = item_mean(r)
    near = top_neighbours(sim, k).join(asked.select("i").distinct(), "i", "left_semi")
    diff = (rating_deviation(r.join(asked.select("user").distinct(), "user", "left_semi"), means, default_mean)
            .select(F.col("item").alias("j"), "user", "diff"))
    terms = asked.join(near, "i").join(diff, ["user", "j"]).select(
        "user", "i", trunc4_units(F.col("sim") * F.col("diff")).alias("num"), trunc4_units(F.col("sim")).alias("den"))
    sums = terms.groupBy("user", "i").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    scored = sums.join(means.select(F.col("item").alias("i"), "mean"), "i", "left").select(
        "user", F.col("i").alias("item"),
        (F.coalesce(F.col("mean"), F.lit(default_mean))
         + F.coalesce(F.try_divide(F.col("num"), F.col("den")), F.lit(0.0))).alias("score"))
    return score_test_pairs(pairs, scored, default_mean, user, item)


def score_test_pairs(pairs: DataFrame, predictions: DataFrame, default: float = DEFAULT_MEAN,
                     user: str = "user", item: str = "item") -> DataFrame:
    """Test pairs left-joined with predictions; missing -> default.

    Output keeps the key: ``(user, item, score)``.
    """
    p = pairs.select(F.col(user).alias("user"), F.col(item).alias("item"))
    return (p.join(predictions.select("user", "item", "score"), ["user", "item"], "left")
            .select("user", "item", F.coalesce(F.col("score"), F.lit(default)).alias("score")))
