"""Queries: PageRank, frequent itemsets, rules, SVM and AUC."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import mining as P
from tessera.operators import models as L
from tessera.operators.ordering import random_split
from tessera.plans.registry import query
from tessera.plans.views import view
from tessera.sources.tables import table

BRAND_SUPPORT = 0.02     # brand baskets: no brand reaches the reference's 0.2


def _pagerank_sql(rounds: int) -> str:
    ctes = ["e AS (SELECT DISTINCT src, dst FROM edges)",
            "deg AS (SELECT src, CAST(count(*) AS DOUBLE) AS deg FROM e GROUP BY src)",
            "r0 AS (SELECT DISTINCT src AS node, 1.0 AS rank FROM e)"]
    for k in range(1, rounds + 1):
        ctes.append(f"r{k} AS (SELECT e.dst AS node, sum(r.rank / d.deg) AS rank "
                    f"FROM e JOIN deg d ON e.src = d.src JOIN r{k - 1} r ON r.node = e.src GROUP BY e.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT node, round(rank, 6) AS rank FROM r{rounds}"


@query("g1_pagerank", views=("edges",), oracle=_pagerank_sql(G.DEFAULT_ROUNDS))
def g1_pagerank(spark, sf):
    ranks = G.pagerank(view(spark, sf, "edges"), rounds=G.DEFAULT_ROUNDS)
    return ranks.select("node", F.round("rank", 6).alias("rank"))


def _subsets_sql(basket_sql: str, support: float) -> str:
    return f"""
WITH RECURSIVE b AS ({basket_sql}),
sub(id, items, last) AS (
  SELECT id, [item], item FROM b
  UNION ALL
  SELECT s.id, list_append(s.items, b.item), b.item FROM sub s JOIN b ON b.id = s.id AND b.item > s.last),
freq AS (SELECT items, count(*) AS freq FROM sub GROUP BY items
         HAVING count(*) >= ceil({support} * (SELECT count(DISTINCT id) FROM b)))
"""


_BRAND_BASKETS_SQL = "SELECT DISTINCT id, item FROM baskets"
_LINE_TOKENS_SQL = """
SELECT DISTINCT l_orderkey AS id, 'flag:' || l_returnflag AS item FROM lineitem
UNION SELECT DISTINCT l_orderkey, 'status:' || l_linestatus FROM lineitem"""


def line_token_pairs(spark, sf):
    """Per order, the tokens ``flag:<returnflag>`` and ``status:<linestatus>``."""
    li = table(spark, sf, "lineitem")
    tokens = F.array(F.concat(F.lit("flag:"), "l_returnflag"), F.concat(F.lit("status:"), "l_linestatus"))
    return li.select(F.col("l_orderkey").alias("id"), F.explode(tokens).alias("item"))


@query("p1_frequent_itemsets", views=("baskets",),
       oracle=_subsets_sql(_BRAND_BASKETS_SQL, BRAND_SUPPORT)
       + "SELECT array_to_string(items, ',') AS items, freq FROM freq")
def p1_frequent_itemsets(spark, sf):
    fi = P.frequent_itemsets(P.to_baskets(view(spark, sf, "baskets")), BRAND_SUPPORT)
    return fi.select(F.array_join("items", ",").alias("items"), "freq")


@query("p1_frequent_itemsets_tokens",
       oracle=_subsets_sql(_LINE_TOKENS_SQL, P.MIN_SUPPORT)
       + "SELECT array_to_string(items, ',') AS items, freq FROM freq")
def p1_frequent_itemsets_tokens(spark, sf):
    fi = P.frequent_itemsets(P.to_baskets(line_token_pairs(spark, sf)), P.MIN_SUPPORT)
    return fi.select(F.array_join("items", ",").alias("items"), "freq")


@query("p2_association_rules",
       oracle=_subsets_sql(_LINE_TOKENS_SQL, P.MIN_SUPPORT) + f"""
, n AS (SELECT count(DISTINCT id) AS n FROM b),
rules AS (
  SELECT list_filter(x.items, lambda t: t <> c.item) AS ante, c.item AS cons, x.freq AS fx
  FROM freq x, (SELECT DISTINCT item FROM b) c
  WHERE len(x.items) >= 2 AND list_contains(x.items, c.item))
SELECT array_to_string(r.ante, ',') AS antecedent, r.cons AS consequent,
       round(r.fx / a.freq, 6) AS confidence,
       round(r.fx / a.freq / (k.freq / n.n), 6) AS lift,
       round(r.fx / n.n, 6) AS support
FROM rules r JOIN freq a ON a.items = r.ante JOIN freq k ON k.items = [r.cons], n
WHERE r.fx / a.freq >= {P.MIN_CONFIDENCE}""")
def p2_association_rules(spark, sf):
    rules = P.association_rules(P.to_baskets(line_token_pairs(spark, sf)), P.MIN_SUPPORT, P.MIN_CONFIDENCE)
    return rules.select(F.array_join("antecedent", ",").alias("antecedent"),
                        F.col("consequent")[0].alias("consequent"),
                        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")])


SVM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def svm_scores(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *SVM_FEATURES,
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))
    data = L.assemble(li, SVM_FEATURES)
    train, test = random_split(data, (L.TRAIN_FRACTION, 1 - L.TRAIN_FRACTION), key="l_orderkey")
    train = train.cache()          # the solver passes over it once per iteration
    try:
        model = L.train_svm(train, L.SVM_ITERATIONS)     # fit() runs eagerly
    finally:
        train.unpersist()
    return L.raw_scores(model, test, keep=("l_orderkey", "l_linenumber"))


#: Scaled features of the training rule's query: about one each.
SGD_FEATURES = {"quantity": "l_quantity / 50", "price": "l_extendedprice / 100000", "discount": "l_discount * 10", "tax": "l_tax * 10"}


def _sgd_sql(steps: int) -> str:
    """The rule step by step: each is one row of weights from one sum over the rows."""
    f = list(SGD_FEATURES)
    rows = ", ".join(f"{e} AS {c}" for c, e in SGD_FEATURES.items())
    out = [f"""WITH rows AS MATERIALIZED (SELECT {rows}, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE -1.0 END AS y FROM lineitem),
w0 AS (SELECT {", ".join(f"0.0::DOUBLE AS {c}" for c in f)}, false AS done)"""]
    for t in range(1, steps + 1):
        s = f"({L.SGD_STEP} / sqrt({t}.0::DOUBLE))"
        dot = " + ".join(f"r.{c} * w.{c}" for c in f)
        sums = ", ".join(f"sum(CASE WHEN r.y * ({dot}) < 1 THEN -r.y * r.{c} END) AS g_{c}" for c in f)
        new = ", ".join(f"w.{c} * (1 - {s} * {L.SGD_REG}) - {s} * coalesce(g_{c}, 0) / n AS n_{c}" for c in f)
        moved = " + ".join(f"(n_{c} - {c}) * (n_{c} - {c})" for c in f)
        norm = " + ".join(f"n_{c} * n_{c}" for c in f)
        settled = f"sqrt({moved}) < {L.SGD_TOLERANCE} * greatest(1.0, sqrt({norm}))" if t > 1 else "false"
        out.append(f"""w{t} AS MATERIALIZED (SELECT {", ".join(f"CASE WHEN done THEN {c} ELSE n_{c} END AS {c}" for c in f)}, done OR {settled} AS done
  FROM (SELECT w.*, {new} FROM w{t - 1} w, (SELECT count(*) AS n, {sums} FROM rows r, w{t - 1} w)))""")
    return ",\n".join(out) + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round({c}, 6) AS weight FROM w{steps}" for c in f)


@query("l1_sgd_weights", oracle=_sgd_sql(L.SVM_ITERATIONS))
def l1_sgd_weights(spark, sf):
    li = table(spark, sf, "lineitem").select(*[F.expr(e).alias(c) for c, e in SGD_FEATURES.items()],
                                             F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    model = L.train_svm_sgd(li, list(SGD_FEATURES))
    return spark.createDataFrame([(c, round(w, 6)) for c, w in zip(model.features, model.weights)], "feature string, weight double")


@query("l2_raw_scores")
def l2_raw_scores(spark, sf):
    """Linear SVM trained on 60 % of line items (hash split), margins on the rest."""
    return svm_scores(spark, sf)


@query("l2_finite_scores", oracle=f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label, true AS finite_score
FROM lineitem
WHERE CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 >= {L.TRAIN_FRACTION}""")
def l2_finite_scores(spark, sf):
    """What SQL can state of them: every row outside the training split gets one finite margin."""
    s = svm_scores(spark, sf)
    finite = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf"))
    return s.select("l_orderkey", "l_linenumber", F.col("label").cast("double").alias("label"), finite.alias("finite_score"))


_AUC_SQL = """
WITH s AS (SELECT score, label FROM scored),
g AS (SELECT score, sum(label) AS pos, count(*) AS cnt FROM s GROUP BY score),
r AS (SELECT score, pos, cnt, sum(cnt) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
      FROM g),
t AS (SELECT sum(pos * (coalesce(below, 0) + (cnt + 1) / 2.0)) AS rank_sum, sum(pos) AS p, sum(cnt) - sum(pos) AS q FROM r)
SELECT round((rank_sum - p * (p + 1) / 2.0) / (p * q), 10) AS auc FROM t"""


@query("l3_auc_roc", views=("scored",), oracle=_AUC_SQL)
def l3_auc_roc(spark, sf):
    auc = L.auc_roc(view(spark, sf, "scored"))
    return auc.select(F.round("auc", 10).alias("auc"))
