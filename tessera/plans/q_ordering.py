"""Queries: sorting, partitioning, union and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import ordering as O
from tessera.plans.registry import query
from tessera.sources.tables import table

_HASH_FRACTION_SQL = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


@query("o1_sort_by_key", oracle="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def o1_sort_by_key(spark, sf):
    return O.sort_by_key(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query("o2_top_1", oracle="""
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 1""")
def o2_top_1(spark, sf):
    counts = A.count_per_key(table(spark, sf, "lineitem").select("l_partkey"), "l_partkey")
    return O.top_1(counts, "l_partkey")


@query("o3_sort_composite", oracle="SELECT p_name, p_size, p_partkey FROM part ORDER BY p_name, p_size")
def o3_sort_composite(spark, sf):
    return O.sort_composite(table(spark, sf, "part").select("p_name", "p_size", "p_partkey"), "p_name", "p_size")


@query("o4_range_partition", oracle="SELECT l_orderkey, l_linenumber FROM lineitem")
def o4_range_partition(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return O.range_partition(li, "l_orderkey", 5).drop("part")


@query("o5_set_partitions", oracle="SELECT c_custkey, c_name FROM customer")
def o5_set_partitions(spark, sf):
    return O.set_partitions(table(spark, sf, "customer").select("c_custkey", "c_name"), 10)


@query("u1_union_all", oracle="""
SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""")
def u1_union_all(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.lit("supplier").alias("kind"))
    return O.union_all(c, s)


@query("u2_sample_rows", oracle=f"""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE {_HASH_FRACTION_SQL.format(k='l_orderkey')} < 0.1""")
def u2_sample_rows(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return O.sample_rows(li, 0.1, key="l_orderkey")


@query("u3_random_split", oracle=f"""
SELECT c_custkey, CASE WHEN {_HASH_FRACTION_SQL.format(k='c_custkey')} < 0.6 THEN 0 ELSE 1 END AS split
FROM customer""")
def u3_random_split(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    a, b = O.random_split(c, (0.6, 0.4), key="c_custkey")
    return a.withColumn("split", F.lit(0)).unionByName(b.withColumn("split", F.lit(1)))
