"""Queries: joins, including the skew-resistant forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import skew as S
from tessera.operators import recommend as R
from tessera.plans.registry import query
from tessera.plans.views import ratings
from tessera.session import checkpoint_dir
from tessera.sources.tables import table

# Values per chunk in the registered cogroup run.
COGROUP_CHUNK = 8


def _orders_by_customer(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")


def _events_by_user(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("key"), "event_id")


@query("j1_inner_join", oracle="""
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def j1_inner_join(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("k"))
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    return J.inner_join(n, r, "k").drop("k")


@query("j2_cogroup_lists", oracle=f"""
WITH l AS (SELECT o_custkey AS k, o_orderkey AS v,
                  (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {COGROUP_CHUNK} AS chunk
           FROM orders),
ll AS (SELECT k, chunk, list_sort(list(v)) AS vs FROM l GROUP BY k, chunk),
r AS (SELECT user_id AS k, event_id AS v,
             (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {COGROUP_CHUNK} AS chunk
      FROM events),
rr AS (SELECT k, chunk, list_sort(list(v)) AS vs FROM r GROUP BY k, chunk)
SELECT coalesce(ll.k, rr.k) AS "key", coalesce(ll.chunk, rr.chunk) AS chunk,
       coalesce(array_to_string(ll.vs, ','), '') AS o_orderkey_list,
       coalesce(array_to_string(rr.vs, ','), '') AS event_id_list
FROM ll FULL JOIN rr ON ll.k = rr.k AND ll.chunk = rr.chunk""")
def j2_cogroup_lists(spark, sf):
    g = J.cogroup_lists(_orders_by_customer(spark, sf), _events_by_user(spark, sf), "key",
                        "o_orderkey", "event_id", chunk=COGROUP_CHUNK)
    return g.select("key", "chunk",
                    F.array_join(F.col("o_orderkey_list").cast("array<string>"), ",").alias("o_orderkey_list"),
                    F.array_join(F.col("event_id_list").cast("array<string>"), ",").alias("event_id_list"))


@query("j3_cross_within_key", oracle="""
SELECT o_custkey AS "key", o_orderkey, event_id FROM orders JOIN events ON o_custkey = user_id""")
def j3_cross_within_key(spark, sf):
    return J.cross_within_key(_orders_by_customer(spark, sf), _events_by_user(spark, sf), "key")


_DIM_SQL = """
SELECT p_partkey AS k, p_name AS title FROM part
UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_size > 40"""


def _dim(spark, sf):
    p = table(spark, sf, "part")
    return (p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("title"))
            .unionByName(p.where(F.col("p_size") > 40).select(F.col("p_partkey").alias("k"),
                                                                 F.col("p_brand").alias("title"))))


def _fact(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.col("value").cast("bigint").alias("video"))


@query("j4_broadcast_lookup_join", oracle=f"""
WITH d AS (SELECT k, max(title) AS title FROM ({_DIM_SQL}) GROUP BY k)
SELECT d.title FROM events e JOIN d ON CAST(trunc(e."value") AS BIGINT) = d.k""")
def j4_broadcast_lookup_join(spark, sf):
    return J.broadcast_lookup_join(_fact(spark, sf), _dim(spark, sf), "video", "k", "title")


@query("j5_semi_join", oracle=f"""
SELECT event_id, CAST(trunc("value") AS BIGINT) AS video FROM events
WHERE CAST(trunc("value") AS BIGINT) IN (SELECT k FROM ({_DIM_SQL}))""")
def j5_semi_join(spark, sf):
    return J.semi_join(_fact(spark, sf), _dim(spark, sf), "video", "k")


@query("j6_left_join_default", oracle="""
SELECT n_nationkey, n_name, coalesce(s.n, 0) AS n_suppliers
FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s
  ON n_nationkey = s.s_nationkey""")
def j6_left_join_default(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = (table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey"))
         .agg(F.count(F.lit(1)).alias("n_suppliers")))
    return J.left_join_default(n, s, "n_nationkey", "n_suppliers", 0)


_LINE_SUPPLIER_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey AS k, s_name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def _line_supplier_sides(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("k"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    return li, s


@query("j7_skew_split_join", oracle=_LINE_SUPPLIER_SQL)
def j7_skew_split_join(spark, sf):
    li, s = _line_supplier_sides(spark, sf)
    return S.skew_split_join(li, s, "k")


@query("j8_replicated_salt_join", oracle=_LINE_SUPPLIER_SQL)
def j8_replicated_salt_join(spark, sf):
    li, s = _line_supplier_sides(spark, sf)
    return S.replicated_salt_join(li, s, "k")


@query("j9_salted_count", oracle="SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey")
def j9_salted_count(spark, sf):
    return S.salted_count(table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"),
                          "l_partkey")


@query("j10_copartitioned_join", oracle="""
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def j10_copartitioned_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return J.copartitioned_join(o, li, "o_orderkey", n)


@query("j10_bucketed_join", oracle="""
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def j10_bucketed_join(spark, sf):
    """Orders and line items stored in buckets of the order key, then joined as they are stored."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    n, run = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex
    for name, side in (("orders", o), ("lines", li)):
        J.write_bucketed(side, f"bucketed_{name}_{run}", "o_orderkey", n, f"{checkpoint_dir(spark).rstrip('/')}/bucketed-{name}-{run}")
    return J.bucketed_join(spark, f"bucketed_orders_{run}", f"bucketed_lines_{run}", "o_orderkey")


#: Keys with more than one row in so many are heavy: close to the average of the keys here, so about half of them are.
HEAVY_SHARE = 150


@query("j7_heavy_hitters", oracle=f"""
SELECT l_returnflag, l_quantity, count(*) AS n, (SELECT count(*) FROM lineitem) AS total FROM lineitem
GROUP BY l_returnflag, l_quantity HAVING count(*) * {HEAVY_SHARE} > (SELECT count(*) FROM lineitem)""")
def j7_heavy_hitters(spark, sf):
    return S.heavy_hitters(table(spark, sf, "lineitem"), ["l_returnflag", "l_quantity"], HEAVY_SHARE)


@query("j12_broadcast_mean_lookup", views=("ratings",), oracle="""
WITH means AS (SELECT item, trunc(sum(rating) / count(rating) * 10000) / 10000 AS mean FROM ratings GROUP BY item)
SELECT r.item, r."user", r.rating, coalesce(m.mean, 3.4952) AS mean
FROM ratings r LEFT JOIN means m ON r.item = m.item""")
def j12_broadcast_mean_lookup(spark, sf):
    r = ratings(spark, sf)
    return J.broadcast_mean_lookup(r, R.item_mean(r), "item", R.DEFAULT_MEAN)
