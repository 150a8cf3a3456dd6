"""Queries: text sources, store scan, LibSVM / example conversion, day slices
(S1-S3, S5-S12)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.plans.views import ratings, sized_edges, view
from tessera.session import checkpoint_dir, owned
from tessera.sources import libsvm as LS
from tessera.sources import store as ST
from tessera.sources import text as TX
from tessera.sources.tables import table


@query("s1_read_ratings", views=("rating_lines",), oracle="""
WITH f AS (SELECT string_split(regexp_replace("value", ',+$', ''), ',') AS f FROM rating_lines)
SELECT f[1] AS "user", f[2] AS item, CAST(f[3] AS DOUBLE) AS rating FROM f
WHERE len(f) >= 3 AND regexp_full_match(f[1], '\\p{Nd}+') AND regexp_full_match(f[2], '\\p{Nd}+')
  AND regexp_full_match(f[3], '\\p{Nd}+')""")
def s1_read_ratings(spark, sf):
    return TX.read_ratings(view(spark, sf, "rating_lines"))


_PAIR_LINES_SQL = """
SELECT CASE WHEN rating = 1 THEN CAST("user" AS VARCHAR)
            WHEN rating = 2 THEN 'u' || CAST("user" AS VARCHAR) || ',' || CAST(item AS VARCHAR)
            WHEN rating = 3 THEN CAST("user" AS VARCHAR) || ',' || CAST(item AS VARCHAR) || ','
            ELSE CAST("user" AS VARCHAR) || ',' || CAST(item AS VARCHAR) END AS "value"
FROM ratings"""


def pair_lines(spark, sf):
    r = ratings(spark, sf)
    u, i = F.col("user").cast("string"), F.col("item").cast("string")
    v = (F.when(F.col("rating") == 1, u)
         .when(F.col("rating") == 2, F.concat(F.lit("u"), u, F.lit(","), i))
         .when(F.col("rating") == 3, F.concat(u, F.lit(","), i, F.lit(",")))
         .otherwise(F.concat(u, F.lit(","), i)))
    return r.select(v.alias("value"))


@query("s2_read_pairs", views=("ratings",), oracle=f"""
WITH l AS ({_PAIR_LINES_SQL}), f AS (SELECT string_split(regexp_replace("value", ',+$', ''), ',') AS f FROM l)
SELECT f[1] AS "user", f[2] AS item FROM f
WHERE len(f) >= 2 AND regexp_full_match(f[1], '\\p{{Nd}}+') AND regexp_full_match(f[2], '\\p{{Nd}}+')""")
def s2_read_pairs(spark, sf):
    return TX.read_pairs(pair_lines(spark, sf))


# Operation-log layout (0-based): 1 unique id, 2 ip, 3 user, 4 operation type,
# 6 video, 9 rating, 10 platform.
LOG_POSITIONS = {"uid": 1, "ip": 2, "user": 3, "op": 4, "video": 6, "r": 9, "platform": 10}

_LOG_LINES_SQL = """
SELECT concat_ws(',', 'L', CAST(event_id AS VARCHAR), 'ip' || CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR),
                 event_type, strftime(ts, '%Y%m%d'), CAST(CAST(trunc("value") AS BIGINT) AS VARCHAR), '-', '-',
                 CAST(CAST(trunc("value" * 100) AS BIGINT) AS VARCHAR), json_extract_string(props, '$.k')) AS "value"
FROM events"""


def log_lines(spark, sf):
    """Operation-log text lines derived from ``events``."""
    e = table(spark, sf, "events")
    return e.select(F.concat_ws(",", F.lit("L"), F.col("event_id").cast("string"),
                                F.concat(F.lit("ip"), F.col("user_id").cast("string")),
                                F.col("user_id").cast("string"), "event_type", F.date_format("ts", "yyyyMMdd"),
                                F.col("value").cast("bigint").cast("string"), F.lit("-"), F.lit("-"),
                                (F.col("value") * 100).cast("bigint").cast("string"),
                                F.get_json_object("props", "$.k")).alias("value"))


@query("s3_read_positional", oracle=f"""
WITH l AS ({_LOG_LINES_SQL})
SELECT split_part("value", ',', 5) AS op, count(*) AS n FROM l GROUP BY 1""")
def s3_read_positional(spark, sf):
    cols = TX.read_positional(log_lines(spark, sf), LOG_POSITIONS)
    return cols.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("s5_rows_to_items", oracle="""
SELECT concat_ws(' ', 'p_brand:' || p_brand, 'p_type:' || p_type, 'p_size:' || CAST(p_size AS VARCHAR)) AS items
FROM part""")
def s5_rows_to_items(spark, sf):
    return TX.rows_to_items(table(spark, sf, "part").select("p_brand", "p_type", "p_size"))


_SIM_LINES_SQL = """
SELECT '(' || CAST(src AS VARCHAR) || ',' || CAST(dst AS VARCHAR) || ',0.'
       || lpad(CAST((src * 31 + dst) % 1000 AS VARCHAR), 3, '0') || ')' AS "value" FROM edges
UNION ALL
SELECT '(' || CAST(src AS VARCHAR) || ',' || CAST(dst AS VARCHAR) || ',0.'
       || lpad(CAST((src * 31 + dst) % 1000 AS VARCHAR), 3, '0') || ')' FROM edges WHERE src < dst"""


def similarity_lines(e):
    """``(i,j,sim)`` lines from the co-purchase edges, some lines twice."""
    txt = F.concat(F.lit("("), F.col("src").cast("string"), F.lit(","), F.col("dst").cast("string"), F.lit(",0."),
                   F.lpad(((F.col("src") * 31 + F.col("dst")) % 1000).cast("string"), 3, "0"), F.lit(")"))
    # one pass over the edges: lines with src < dst are emitted twice
    return e.select(F.explode(F.when(F.col("src") < F.col("dst"), F.array(txt, txt)).otherwise(F.array(txt)))
                    .alias("value"))


_SVM_COLUMNS = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("s6_read_libsvm", oracle="""
SELECT CAST(l_linenumber AS DOUBLE) AS label, CAST(4 AS BIGINT) AS size, l_quantity AS x1, l_extendedprice AS x2, l_discount AS x3, l_tax AS x4
FROM lineitem""")
def s6_read_libsvm(spark, sf):
    """Line items written as LibSVM files by the sink and read back: label, the vector's size and its values."""
    path = owned(f"{checkpoint_dir(spark).rstrip('/')}/libsvm-{uuid.uuid4().hex}")
    LS.write_libsvm(table(spark, sf, "lineitem").select(*_SVM_COLUMNS), "l_linenumber", path)
    rows = LS.read_libsvm(spark, path, num_features=4).select("label", vector_to_array("features").alias("x"))
    return rows.select("label", F.size("x").cast("bigint").alias("size"), *[F.col("x")[i].alias(f"x{i + 1}") for i in range(4)])


@query("s7_read_similarity", views=("edges",), oracle=f"""
WITH l AS ({_SIM_LINES_SQL}), f AS (SELECT string_split(regexp_replace("value", '[()]', '', 'g'), ',') AS f FROM l)
SELECT DISTINCT CAST(f[1] AS BIGINT) AS i, CAST(f[2] AS BIGINT) AS j, CAST(f[3] AS DOUBLE) AS sim FROM f""")
def s7_read_similarity(spark, sf):
    e, tasks = sized_edges(spark, sf)
    return TX.read_similarity(similarity_lines(e), tasks=tasks)


@query("s8_range_scan_sum", oracle="""
SELECT CAST(sum(CASE WHEN event_type <> 'error' THEN user_id END) AS BIGINT) AS total FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'""")
def s8_range_scan_sum(spark, sf):
    """A week of events by their key, the time; some cells hold text, which the sum leaves out."""
    e = table(spark, sf, "events")
    cells = e.select("ts", F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("user_id").cast("string")).alias("cell"))
    bound = lambda day: F.lit(day).cast(e.schema["ts"].dataType)  # noqa: E731 - a constant of the key's own type is pushed down
    return ST.range_scan_sum(cells, "ts", bound("2024-01-08 00:00:00"), bound("2024-01-15 00:00:00"), "cell")


@query("s9_to_libsvm", oracle="""
SELECT trim(concat_ws(' ', CAST(CAST(c_custkey % 2 AS DOUBLE) AS VARCHAR),
                      '1:' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR),
                      '2:' || CAST(c_acctbal AS VARCHAR))) AS libsvm
FROM customer""")
def s9_to_libsvm(spark, sf):
    c = table(spark, sf, "customer").select((F.col("c_custkey") % 2).alias("label"), "c_nationkey", "c_acctbal")
    return LS.to_libsvm(c, "label")


_EX_LINES_SQL = """
SELECT c_custkey, CAST(c_custkey % 2 AS VARCHAR) || ' 1:' || CAST(c_nationkey AS VARCHAR)
                  || ' 2:' || CAST(c_acctbal AS VARCHAR) AS "value" FROM customer"""


def example_lines(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.concat((F.col("c_custkey") % 2).cast("string"), F.lit(" 1:"),
                                          F.col("c_nationkey").cast("string"), F.lit(" 2:"),
                                          F.col("c_acctbal").cast("string")).alias("value"))


@query("s10_to_examples", oracle=f"""
WITH l AS ({_EX_LINES_SQL}),
t AS (SELECT c_custkey, string_split(trim("value"), ' ') AS toks FROM l),
e AS (SELECT c_custkey, 'label' AS name, 'int64' AS kind, CAST(TRY_CAST(toks[1] AS BIGINT) AS DOUBLE) AS "value" FROM t
      UNION ALL
      SELECT c_custkey, split_part(tok, ':', 1),
             CASE WHEN regexp_full_match(split_part(tok, ':', 2), '\\p{{Nd}}+') THEN 'int64' ELSE 'float' END,
             CASE WHEN regexp_full_match(split_part(tok, ':', 2), '\\p{{Nd}}+')
                  THEN CAST(CAST(split_part(tok, ':', 2) AS BIGINT) AS DOUBLE)
                  ELSE CAST(TRY_CAST(split_part(tok, ':', 2) AS FLOAT) AS DOUBLE) END
      FROM (SELECT c_custkey, unnest(toks[2:]) AS tok FROM t))
SELECT c_custkey, name, kind, "value" FROM e""")
def s10_to_examples(spark, sf):
    """Typed example maps, one row per feature: kind int64 or float, value as double."""
    ex = LS.to_examples(example_lines(spark, sf))
    kv = ex.select("c_custkey", F.explode("example").alias("name", "v"))
    is_int = F.size("v.i") > 0
    return kv.select("c_custkey", "name", F.when(is_int, F.lit("int64")).otherwise(F.lit("float")).alias("kind"),
                     F.when(is_int, F.col("v.i")[0].cast("double"))
                     .otherwise(F.col("v.f")[0].cast("double")).alias("value"))


@query("s11_write_text", oracle=r"""
SELECT doc_id, sha256(regexp_replace("text", '[\r\n]+', ' ', 'g')) AS text_sha256 FROM documents WHERE "text" IS NOT NULL AND doc_id IS NOT NULL""")
def s11_write_text(spark, sf):
    """Whole documents written as text, a line each, and read back from the files."""
    path = owned(f"{checkpoint_dir(spark).rstrip('/')}/text-{uuid.uuid4().hex}")
    lines = table(spark, sf, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.regexp_replace("text", r"[\r\n]+", " ")).alias("line"))
    TX.write_text(lines.where("line is not null"), path)
    parts = F.split("value", "\t", 2)
    return TX.read_lines(spark, path).select(parts[0].cast("long").alias("doc_id"), F.sha2(parts[1].cast("binary"), 256).alias("text_sha256"))


@query("s12_daily_path", oracle="""
SELECT event_id, user_id, event_type FROM events
WHERE ts >= DATE '2024-01-15' - INTERVAL 1 DAY AND ts < DATE '2024-01-15'""")
def s12_daily_path(spark, sf):
    """Rows of the day before 2024-01-15 (the reference reads yesterday's folder)."""
    from tessera.functions.dates import day_before
    e = table(spark, sf, "events")
    return TX.day_slice(e, "ts", day_before("2024-01-15")).select("event_id", "user_id", "event_type")
