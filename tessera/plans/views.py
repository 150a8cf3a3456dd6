"""Views over the driver tables that the queries share.

Each view has a DataFrame builder (used by the Spark queries) and an
equivalent SQL text (used by the DuckDB oracle through ``with_views``).
Both read the whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.cooccurrence import pair_sum_parts, pair_sums
from tessera.operators.skew import dealt, sized_join, tasks_for
from tessera.session import shared_table
from tessera.sources.tables import table

# --------------------------------------------------------------------------
# DataFrame builders
# --------------------------------------------------------------------------


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, rating): best quantity a customer ordered of a part.

    Whole-number ratings, so every sum over them is exact.  The join and the aggregate are cut
    by the number of line items, so a task's memory does not grow with the table.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    n = tasks_for(spark, li.count())         # from the files' footers
    rows = (o.join(li, o.o_orderkey == li.l_orderkey) if n is None else
            sized_join(li, o.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", count="left", tasks=n))
    return (dealt(rows.select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), "l_quantity"), n, "user", "item")
            .groupBy("user", "item").agg(F.max("l_quantity").cast("double").alias("rating")))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return sized_edges(spark, sf)[0]


def sized_edges(spark: SparkSession, sf: str) -> tuple[DataFrame, int | None]:
    """(src, dst), and the ``tasks_for`` as many rows at most: parts bought together in one order, earlier line -> later line.

    An edge (a, b) exists iff in some order the first line of part a comes
    before the last line of part b, so each order is first reduced to one
    row per distinct part (min and max line number; a partial hash
    aggregate) and only those rows are self-joined.  The same edges as
    joining the raw lines, with a hot order's repeated parts removed
    before the join.  Steps are cut by their numbers of rows, so a task's memory does not grow with the table.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    per_part = dealt(li, tasks_for(spark, li.count()), "l_orderkey", "l_partkey").groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("first_ln"),
                                                          F.max("l_linenumber").alias("last_ln"))
    per_part = shared_table(per_part, "order-parts")   # both sides and the key counts read it
    x = per_part.select("l_orderkey", F.col("l_partkey").alias("src"), "first_ln")
    y = per_part.select("l_orderkey", F.col("l_partkey").alias("dst"), "last_ln")
    n = F.count(F.lit(1))
    pairs = per_part.groupBy("l_orderkey").agg((n * (n - 1)).alias("n")).agg(F.sum("n")).head()[0] or 0     # each in one or both directions
    tasks = tasks_for(spark, pairs)
    met = (sized_join(x, y, "l_orderkey", count="self", tasks=tasks)
           .where((F.col("first_ln") < F.col("last_ln")) & (F.col("src") != F.col("dst"))).select("src", "dst"))
    return dealt(met, tasks, "src", "dst").distinct(), tasks


def baskets(spark: SparkSession, sf: str) -> DataFrame:
    """(id, item): the brands in one order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("id"), F.col("p_brand").alias("item"))
            .distinct())


def item_events(spark: SparkSession, sf: str) -> DataFrame:
    """(item, ts, id, rating): one rating event per line item, stamped by order date."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_partkey").alias("item"), F.col("o_orderdate").alias("ts"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                    F.col("l_quantity").alias("rating")))


def pair_events(spark: SparkSession, sf: str) -> DataFrame:
    """(item_i, item_j, rating, n_ij): co-rating strength of two items over users."""
    return _pair_events(spark, sf, lambda *a: [pair_sums(*a)])[0]


def pair_event_parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """``pair_events`` in parts, each with all pairs of its items item_i, to be read one after the other."""
    return _pair_events(spark, sf, pair_sum_parts)


def _pair_events(spark: SparkSession, sf: str, sums) -> list[DataFrame]:
    r = shared_table(ratings(spark, sf), "ratings")
    item = r.schema["item"].dataType
    return [p.select(F.col("i").cast(item).alias("item_i"), F.col("j").cast(item).alias("item_j"), F.col("v").alias("rating"), F.col("n").alias("n_ij"))
            for p in sums(r.select(F.col("user").alias("k"), F.col("item").alias("it"), F.col("rating").alias("r")), "least")]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(score, label): event value as a score, purchases as positives."""
    e = table(spark, sf, "events")
    return e.select(F.col("value").alias("score"),
                    F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"))


def rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``user,item,rating`` text lines, some spoiled so the parser has work.

    Spoiled forms (by rating value): decimal rating, negative rating, empty
    field, two fields only, empty line.
    """
    r = ratings(spark, sf)
    u, i, q = (F.col(c).cast("bigint").cast("string") for c in ("user", "item", "rating"))
    value = (F.when(F.col("rating") >= 49, F.concat_ws(",", u, i, F.concat(q, F.lit(".5"))))
             .when(F.col("rating") == 1, F.concat_ws(",", u, i, F.concat(F.lit("-"), q)))
             .when(F.col("rating") == 2, F.concat_ws(",", u, F.lit(""), q))
             .when(F.col("rating") == 3, F.concat_ws(",", u, i))
             .when(F.col("rating") == 4, F.lit(""))
             .otherwise(F.concat_ws(",", u, i, q)))
    return r.select(value.alias("value"))


BUILDERS = {
    "ratings": ratings, "edges": edges, "baskets": baskets, "item_events": item_events,
    "pair_events": pair_events, "scored": scored, "rating_lines": rating_lines,
}


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf)


# --------------------------------------------------------------------------
# The same views as SQL (DuckDB dialect, also valid Spark SQL where noted)
# --------------------------------------------------------------------------

VIEW_SQL = {
    "ratings": """
        SELECT o_custkey AS "user", l_partkey AS item, CAST(max(l_quantity) AS DOUBLE) AS rating
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_custkey, l_partkey""",
    "edges": """
        SELECT DISTINCT x.l_partkey AS src, y.l_partkey AS dst
        FROM lineitem x JOIN lineitem y
          ON x.l_orderkey = y.l_orderkey AND x.l_linenumber < y.l_linenumber
        WHERE x.l_partkey <> y.l_partkey""",
    "baskets": """
        SELECT DISTINCT l_orderkey AS id, p_brand AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "item_events": """
        SELECT l_partkey AS item, o_orderdate AS ts, l_orderkey * 10 + l_linenumber AS id,
               l_quantity AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pair_events": """
        SELECT a.item AS item_i, b.item AS item_j, sum(least(a.rating, b.rating)) AS rating,
               count(*) AS n_ij
        FROM ratings a JOIN ratings b ON a."user" = b."user" AND a.item < b.item
        GROUP BY a.item, b.item""",
    "scored": """
        SELECT "value" AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label
        FROM events""",
    "rating_lines": """
        SELECT CASE
          WHEN rating >= 49 THEN concat_ws(',', CAST(CAST("user" AS BIGINT) AS VARCHAR), CAST(CAST(item AS BIGINT) AS VARCHAR), CAST(CAST(rating AS BIGINT) AS VARCHAR) || '.5')
          WHEN rating = 1 THEN concat_ws(',', CAST(CAST("user" AS BIGINT) AS VARCHAR), CAST(CAST(item AS BIGINT) AS VARCHAR), '-' || CAST(CAST(rating AS BIGINT) AS VARCHAR))
          WHEN rating = 2 THEN concat_ws(',', CAST(CAST("user" AS BIGINT) AS VARCHAR), '', CAST(CAST(rating AS BIGINT) AS VARCHAR))
          WHEN rating = 3 THEN concat_ws(',', CAST(CAST("user" AS BIGINT) AS VARCHAR), CAST(CAST(item AS BIGINT) AS VARCHAR))
          WHEN rating = 4 THEN ''
          ELSE concat_ws(',', CAST(CAST("user" AS BIGINT) AS VARCHAR), CAST(CAST(item AS BIGINT) AS VARCHAR), CAST(CAST(rating AS BIGINT) AS VARCHAR))
        END AS "value"
        FROM ratings""",
}

_DEPS = {"pair_events": ("ratings",), "rating_lines": ("ratings",)}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the named views (and what they need)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        if stripped[5:].lstrip().upper().startswith("RECURSIVE "):
            rest = stripped[5:].lstrip()[len("RECURSIVE "):]
            return f"WITH RECURSIVE {ctes},\n{rest}"
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
