"""Queries: correlation and the discretizer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as X
from tessera.plans.registry import query
from tessera.sources.tables import table

MAX_BINS = X.DEFAULT_MAX_BINS
CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CUSTOMER_NUM = ("c_custkey", "c_nationkey", "c_acctbal")


def _corr_sql() -> str:
    cells = []
    for a in CORR_COLS:
        row = ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in CORR_COLS)
        cells.append(f"SELECT '{a}' AS \"column\", {row} FROM lineitem")
    return "\nUNION ALL ".join(cells)


@query("x1_corr_matrix", oracle=_corr_sql())
def x1_corr_matrix(spark, sf):
    m = X.corr_matrix(table(spark, sf, "lineitem"), list(CORR_COLS))
    return m.select("column", *[F.round(c, 6).alias(c) for c in CORR_COLS])


def splits_sql(tbl: str, cols, max_bins: int = MAX_BINS, sample_where: str = "", fraction_sql: str = "1.0") -> str:
    """Recursive-CTE twin of ``find_splits``: ``(column, idx, split)``.

    ``fraction_sql`` is the sampled form's fraction in terms of the row count n.
    """
    longs = "\n  UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM src" for c in cols)
    return f"""
WITH RECURSIVE
src AS (SELECT * FROM {tbl} {sample_where}),
frac AS (SELECT {fraction_sql} AS f, n FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {tbl})),
ns AS (SELECT CAST(trunc(f * n) AS BIGINT) / {max_bins + 1}.0 AS stride FROM frac),
long AS ({longs}),
hist AS (SELECT col, v, CAST(count(*) AS DOUBLE) AS c, row_number() OVER (PARTITION BY col ORDER BY v) AS idx
         FROM long WHERE v IS NOT NULL GROUP BY col, v),
sizes AS (SELECT col, count(*) AS k FROM hist GROUP BY col),
walk(col, idx, cnt, target, split) AS (
  SELECT h.col, h.idx, h.c, ns.stride, CAST(NULL AS DOUBLE) FROM hist h, ns WHERE h.idx = 1
  UNION ALL
  SELECT w.col, h.idx, w.cnt + h.c,
         CASE WHEN abs(w.cnt - w.target) < abs(w.cnt + h.c - w.target) THEN w.target + ns.stride ELSE w.target END,
         CASE WHEN abs(w.cnt - w.target) < abs(w.cnt + h.c - w.target) THEN (p.v + h.v) / 2.0 END
  FROM walk w JOIN hist h ON h.col = w.col AND h.idx = w.idx + 1
       JOIN hist p ON p.col = w.col AND p.idx = w.idx, ns),
splits AS (
  SELECT w.col, w.split FROM walk w JOIN sizes s ON s.col = w.col WHERE s.k > {max_bins} AND w.split IS NOT NULL
  UNION ALL
  SELECT h.col, h.v FROM hist h JOIN sizes s ON s.col = h.col WHERE s.k <= {max_bins}),
numbered AS (SELECT col AS "column", CAST(row_number() OVER (PARTITION BY col ORDER BY split) - 1 AS INTEGER) AS idx,
                    split FROM splits)
"""


def _splits_long(df_splits):
    return df_splits.select("column", F.posexplode("splits").alias("idx", "split"))


@query("x3_find_splits", oracle=splits_sql("customer", CUSTOMER_NUM) + "SELECT * FROM numbered")
def x3_find_splits(spark, sf):
    c = table(spark, sf, "customer")
    return _splits_long(X.find_splits(c, list(CUSTOMER_NUM), MAX_BINS))


_LINE_HASH = "CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"


_FRACTION = f"CASE WHEN {X.MIN_SAMPLES} < n THEN {X.MIN_SAMPLES} / n ELSE 1.0 END"


@query("x3_find_splits_sampled",
       oracle=splits_sql("lineitem", ("l_extendedprice", "l_quantity"), MAX_BINS, fraction_sql=_FRACTION,
                         sample_where="WHERE " + _LINE_HASH + " < (SELECT CASE WHEN 10000 < count(*) "
                                       "THEN 10000 / count(*) ELSE 1.0 END FROM lineitem)")
       + "SELECT * FROM numbered")
def x3_find_splits_sampled(spark, sf):
    """Split finding on a hash-keyed sample of line items (same sample in any engine)."""
    li = table(spark, sf, "lineitem")
    n = li.count()
    return _splits_long(X.find_splits(li, ["l_extendedprice", "l_quantity"], MAX_BINS, n=n,
                                      fraction=X.sample_fraction(MAX_BINS, n), sample_key="l_orderkey"))


SKETCHED = ("c_custkey", "c_acctbal")


@query("x3_splits_from_sketches", oracle=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(i AS INTEGER) AS idx, n, true AS within FROM (SELECT count({c}) AS n FROM customer), range({MAX_BINS}) r(i)""" for c in SKETCHED))
def x3_splits_from_sketches(spark, sf):
    """Splits of merged sketches (one per nation), each against its exact rank: within twice the stated error."""
    c = table(spark, sf, "customer")
    found = X.splits_from_sketches(X.sketch_columns(c, SKETCHED, by=["c_nationkey"]), MAX_BINS)
    points = found.select("column", "n", F.posexplode("splits").alias("idx", "split"))
    values = c.select(F.explode(F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).cast("double").alias("v")) for k in SKETCHED])).alias("x")).select("x.*")
    below = F.transform("splits", lambda s: F.when(F.col("v") <= s, 1).otherwise(0))
    ranks = (values.join(F.broadcast(found.select("column", "splits")), "column")      # a row per column
             .select("column", F.posexplode(below).alias("idx", "below")).groupBy("column", "idx").agg(F.sum("below").alias("rank")))
    off = F.abs(F.col("rank") / F.col("n") - (F.col("idx") + 1) / F.lit(MAX_BINS + 1.0))
    return points.join(ranks, ["column", "idx"]).select("column", "idx", "n", (off <= 2 * X.sketch_rank_error() + 1 / F.col("n")).alias("within"))


@query("x4_assign_upper", oracle=splits_sql("customer", ("c_acctbal",)) + """
SELECT c_custkey, coalesce((SELECT min(split) FROM numbered WHERE split > c_acctbal),
                           (SELECT max(split) FROM numbered)) AS upper
FROM customer""")
def x4_assign_upper(spark, sf):
    c = table(spark, sf, "customer")
    found = X.split_values(X.find_splits(c, ["c_acctbal"], MAX_BINS))
    return X.assign_upper(c.select("c_custkey", "c_acctbal"), found, {"c_acctbal": "upper"}).drop("c_acctbal")


def _discretize_sql() -> str:
    parts = []
    for col in CUSTOMER_NUM:
        parts.append(f"""CASE WHEN (SELECT count(*) FROM numbered WHERE "column" = '{col}') < {MAX_BINS}
            THEN CAST(x.{col} AS DOUBLE)
            ELSE coalesce((SELECT min(split) FROM numbered WHERE "column" = '{col}' AND split > CAST(x.{col} AS DOUBLE)),
                          (SELECT max(split) FROM numbered WHERE "column" = '{col}')) END AS {col}""")
    cols = ",\n  ".join(parts)
    return (splits_sql("customer", CUSTOMER_NUM)
            + f"SELECT {cols},\n  x.c_mktsegment FROM customer x")


@query("x5_discretize", oracle=_discretize_sql())
def x5_discretize(spark, sf):
    c = table(spark, sf, "customer").select(*CUSTOMER_NUM, "c_mktsegment")
    return X.discretize(c, MAX_BINS, passthrough_short=True)


@query("x6_category_values", oracle="""
SELECT DISTINCT 'c_mktsegment' AS "column", c_mktsegment AS "value" FROM customer
UNION SELECT DISTINCT 'c_name', c_name FROM customer""")
def x6_category_values(spark, sf):
    return X.category_values(table(spark, sf, "customer").select("c_mktsegment", "c_name"))
