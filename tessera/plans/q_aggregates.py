"""Queries: keyed aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.plans.registry import query
from tessera.sources.tables import table

# Values per chunk in the registered collect_groups run.
GROUP_CHUNK = 8


@query("a1_count_per_key", oracle="SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey")
def a1_count_per_key(spark, sf):
    return A.count_per_key(table(spark, sf, "lineitem").select("l_partkey"), "l_partkey")


@query("a2_sum_per_key", oracle="SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def a2_sum_per_key(spark, sf):
    return A.sum_per_key(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity")


@query("a3_distinct_per_key", oracle="""
SELECT substr(p_name, 1, 1) AS initial, count(DISTINCT p_name) AS n_distinct FROM part GROUP BY 1""")
def a3_distinct_per_key(spark, sf):
    p = table(spark, sf, "part").select(F.substring("p_name", 1, 1).alias("initial"), "p_name")
    return A.distinct_per_key(p, "initial", "p_name")


@query("a7_distinct_rows", oracle="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def a7_distinct_rows(spark, sf):
    return A.distinct_rows(table(spark, sf, "lineitem").select("l_partkey", "l_suppkey"))


@query("a8_count_rows", oracle="SELECT count(*) AS n FROM lineitem")
def a8_count_rows(spark, sf):
    return A.count_rows(table(spark, sf, "lineitem"))


@query("a9_profile_distinct", oracle="""
SELECT 'c_name' AS "column", count(DISTINCT c_name) AS n_distinct FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) FROM customer""")
def a9_profile_distinct(spark, sf):
    return A.profile_distinct(table(spark, sf, "customer"))


@query("a10_collect_groups", oracle=f"""
SELECT o_custkey, chunk, array_to_string(list_sort(list(o_orderkey)), ',') AS "values"
FROM (SELECT o_custkey, o_orderkey,
             (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {GROUP_CHUNK} AS chunk
      FROM orders)
GROUP BY o_custkey, chunk""")
def a10_collect_groups(spark, sf):
    o = table(spark, sf, "orders")
    g = A.collect_groups(o, "o_custkey", "o_orderkey", chunk=GROUP_CHUNK)
    return g.select("o_custkey", "chunk", F.array_join(F.col("values").cast("array<string>"), ",").alias("values"))


@query("a11_global_sum", oracle="SELECT sum(l_quantity) AS total FROM lineitem")
def a11_global_sum(spark, sf):
    return A.global_sum(table(spark, sf, "lineitem"), "l_quantity")
