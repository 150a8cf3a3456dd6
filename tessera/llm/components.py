"""Connected components of an edge table, as rounds of two star steps.

Large-star joins every larger neighbour of a vertex to its smallest
neighbour; small-star joins every smaller one.  Alternating them ends with
each vertex tied to the smallest vertex of its component, in a number of
rounds that grows with the logarithm of the longest path.  Vertex minima are
hash aggregates (combined before the shuffle), so a hub costs one row per
task; each round ends in a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import drop_table, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).unionByName(moved)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) long pairs in any order -> (vertex, root) for every vertex but the roots.

    ``root`` is the smallest vertex of the component.  Self-pairs, repeated
    pairs and pairs with a null are allowed and add nothing; no edges, no rows.
    """
    e = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .distinct())
    e, seen = materialize(e, "edges"), None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        after = materialize(_small_star(_large_star(e)).distinct(), "edges")
        drop_table(e)
        e, seen = after, state
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")
