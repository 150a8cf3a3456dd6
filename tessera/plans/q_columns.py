"""Queries: projections, predicates and scalar column functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import codec, columns as C, dates as D, jsonfn as J
from tessera.plans.registry import query
from tessera.plans.views import view
from tessera.session import checkpoint_dir
from tessera.sources import text as TX
from tessera.sources.tables import table

# A test key for the encryption round trip (any 16/24/32-byte text works).
ROUND_TRIP_KEY = "k3y-for-r0und-tr1p-0f-aes-gcm!!!"


@query("f1_is_numeric", views=("rating_lines",), oracle="""
SELECT "value", coalesce(regexp_full_match(split_part("value", ',', 3), '\\p{Nd}+'), false) AS third_numeric
FROM rating_lines""")
def f1_is_numeric(spark, sf):
    lines = view(spark, sf, "rating_lines")
    third = F.get(F.split("value", ","), 2)
    return lines.select("value", C.is_numeric(F.coalesce(third, F.lit(""))).alias("third_numeric"))


@query("f2_case_flag", oracle="""
SELECT event_id, CASE WHEN "value" / 100 > 0.5 THEN 1 ELSE 0 END AS flag FROM events""")
def f2_case_flag(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", C.case_flag(F.col("value") / 100).alias("flag"))


@query("f3_cast_numeric_double", oracle="""
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""")
def f3_cast_numeric_double(spark, sf):
    return C.cast_numeric_double(table(spark, sf, "customer"))


def _murmur_sql(table_name: str, key: str, text: str) -> str:
    """Spark's ``hash`` (Murmur3 x86_32, seed 42) of a text: whole little-endian words, then single signed bytes."""
    m = "4294967295"
    rotl = lambda x, r: f"((({x}) << {r}) | (({x}) >> {32 - r})) & {m}"
    k1 = f"(({rotl('((k * 3432918353) & ' + m + ')', 15)}) * 461845907) & {m}"
    h1 = f"(({rotl('xor(h, ' + k1 + ')', 13)}) * 5 + 3864292196) & {m}"
    byte = lambda i: f"substr(x, {i}, 2)"
    word = " || ".join(byte(f"8 * i + {o}") for o in (7, 5, 3, 1))
    one = f"CAST('0x' || {byte('2 * j + 1')} AS UBIGINT)"
    fin = lambda x, s, c: f"(xor({x}, {x} >> {s}) * {c}) & {m}"
    return f"""
b AS (SELECT {key}, hex(encode({text})) AS x FROM {table_name}),
ks AS (SELECT {key}, x, len(x) // 2 AS n,
         list_concat(list_transform(range(0, len(x) // 8), lambda i: CAST('0x' || {word} AS UBIGINT)),
                     list_transform(range(len(x) // 8 * 4, len(x) // 2), lambda j: {one} + CASE WHEN {one} >= 128 THEN 4294967040 ELSE 0 END)) AS ks
       FROM b),
h0 AS (SELECT {key}, xor(CAST(list_reduce(ks, lambda h, k: {h1}, CAST(42 AS UBIGINT)) AS UBIGINT), CAST(n AS UBIGINT)) AS h FROM ks),
h2 AS (SELECT {key}, {fin('h', 16, 2246822507)} AS h FROM h0),
h3 AS (SELECT {key}, {fin('h', 13, 3266489909)} AS h FROM h2),
murmur AS (SELECT {key}, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM h3)"""


@query("f4_hash_bucket", oracle="WITH" + _murmur_sql("documents", "doc_id", "text") + f"""
SELECT doc_id, CAST(abs((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {C.HASH_BUCKETS}) AS VARCHAR) AS bucket
FROM murmur""")
def f4_hash_bucket(spark, sf):
    """Murmur3 buckets of whole document texts."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", C.hash_bucket("text", C.HASH_BUCKETS).alias("bucket"))


@query("f5_mod_label", oracle="""
SELECT c_custkey, CAST(c_custkey AS BIGINT) % 2 AS label FROM customer""")
def f5_mod_label(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.mod_label(F.col("c_custkey").cast("string")).alias("label"))


@query("f6_md5_hex", oracle="""
SELECT doc_id, coalesce(nullif(regexp_replace(md5("text"), '^0+', ''), ''), '0') AS md5_hex
FROM documents""")
def f6_md5_hex(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", codec.md5_hex("text").alias("md5_hex"))


@query("f7_hex_encode", oracle="""
SELECT p_partkey, lower(hex(p_name)) AS name_hex FROM part""")
def f7_hex_encode(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", codec.hex_encode(F.col("p_name").cast("binary")).alias("name_hex"))


_HEX_INPUT_SQL = """
SELECT p_partkey, CASE p_size % 3
    WHEN 0 THEN substr(hex(p_name), 2)
    WHEN 1 THEN ' ' || lower(hex(p_name)) || ' '
    ELSE 'zz' || hex(p_name) END AS h
FROM part"""


def _hex_input(spark, sf):
    p = table(spark, sf, "part")
    h = F.hex(F.col("p_name").cast("binary"))
    return p.select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.substring(h, 2, 1 << 20))
                    .when(F.col("p_size") % 3 == 1, F.concat(F.lit(" "), F.lower(h), F.lit(" ")))
                    .otherwise(F.concat(F.lit("zz"), h)).alias("h"))


@query("f8_hex_decode", oracle=f"""
WITH x AS ({_HEX_INPUT_SQL})
SELECT p_partkey, CASE WHEN regexp_full_match(trim(h), '([0-9a-fA-F]{{2}})*')
                       THEN decode(unhex(trim(h))) END AS name
FROM x""")
def f8_hex_decode(spark, sf):
    x = _hex_input(spark, sf)
    return x.select("p_partkey", F.decode(codec.hex_decode("h"), "UTF-8").alias("name"))


@query("f9_encrypt_round_trip", oracle="SELECT p_partkey, p_name FROM part")
def f9_encrypt_round_trip(spark, sf):
    p = table(spark, sf, "part")
    enc = p.select("p_partkey", codec.encrypt_column("p_name", ROUND_TRIP_KEY).alias("x"))
    return enc.select("p_partkey", codec.decrypt_column("x", ROUND_TRIP_KEY).alias("p_name"))


@query("f10_gzip_round_trip", oracle="""
SELECT doc_id, "text", length("text") > 0 AS shrunk_or_empty FROM documents""")
def f10_gzip_round_trip(spark, sf):
    d = table(spark, sf, "documents")
    z = d.select("doc_id", codec.gzip_column("text").alias("z"))
    return z.select("doc_id", codec.gunzip_column("z").alias("text"),
                    (F.length("z") > 0).alias("shrunk_or_empty"))


@query("f11_plus_days", oracle="""
SELECT o_orderkey, o_orderdate + INTERVAL 7 DAY AS plus_week,
       o_orderdate - INTERVAL 30 DAY AS minus_month FROM orders""")
def f11_plus_days(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.plus_days("o_orderdate", 7).alias("plus_week"),
                    D.plus_days("o_orderdate", -30).alias("minus_month"))


@query("f12_format_day", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_dash,
       strftime(o_orderdate, '%Y/%m/%d') AS day_slash FROM orders""")
def f12_format_day(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.format_day("o_orderdate", D.DAY_DASH).alias("day_dash"),
                    D.format_day("o_orderdate", D.DAY_SLASH).alias("day_slash"))


@query("f13_parse_time", oracle="""
SELECT o_orderkey, CAST(epoch(strptime('[' || strftime(o_orderdate, '%d/%b/%Y:%H:%M:%S') || ' +0800]',
                                       '[%d/%b/%Y:%H:%M:%S %z]')) AS BIGINT) AS epoch_s
FROM orders""")
def f13_parse_time(spark, sf):
    o = table(spark, sf, "orders")
    text = F.concat(F.lit("["), F.date_format("o_orderdate", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0800]"))
    return o.select("o_orderkey", F.unix_seconds(D.parse_time(text)).alias("epoch_s"))


_JSON_INPUT_SQL = """
SELECT event_id, ts, CASE WHEN event_type = 'error' THEN props
                          ELSE '[' || props || ', ' || props || ']' END AS txt FROM events"""


def _json_input(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "ts", F.when(F.col("event_type") == "error", F.col("props"))
                    .otherwise(F.concat(F.lit("["), "props", F.lit(", "), "props", F.lit("]"))).alias("txt"))


@query("f14_json_array_rows", oracle=f"""
WITH x AS ({_JSON_INPUT_SQL}),
objs AS (SELECT DISTINCT event_id, ts, CAST(unnest(from_json(txt, '["JSON"]')) AS VARCHAR) AS obj
         FROM x WHERE json_type(txt) = 'ARRAY'),
kv AS (SELECT event_id, ts, obj, unnest(json_keys(obj)) AS k FROM objs)
SELECT event_id, ts AS access_time, k AS "key", json_extract_string(obj, k) AS "value",
       TRY_CAST(json_extract_string(obj, k) AS DOUBLE) AS value_num
FROM kv""")
def f14_json_array_rows(spark, sf):
    return J.json_array_rows(_json_input(spark, sf), "txt", "ts", keep=("event_id",))


_TYPED_INPUT_SQL = """
SELECT event_id, ts, CASE WHEN event_type = 'error' THEN props ELSE
  '[' || props || ', {"n": ' || user_id || ', "v": ' || CAST("value" AS VARCHAR) || ', "ok": ' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
  || ', "type": "' || event_type || '", "none": null, "at": [1, "x", {"y": ' || user_id || '}]}, 7, {"n": ' || user_id || '.0}, {"n": ' || user_id || '}]' END AS txt
FROM events"""


def _typed_input(spark, sf):
    e = table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    parts = [F.lit("["), "props", F.lit(', {"n": '), user, F.lit(', "v": '), F.col("value").cast("string"), F.lit(', "ok": '),
             F.when(F.col("user_id") % 2 == 0, "true").otherwise("false"), F.lit(', "type": "'), "event_type",
             F.lit('", "none": null, "at": [1, "x", {"y": '), user, F.lit('}]}, 7, {"n": '), user, F.lit('.0}, {"n": '), user, F.lit("}]")]
    return e.select("event_id", "ts", F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.concat(*parts)).alias("txt"))


@query("f14_json_typed_rows", oracle=f"""
WITH x AS ({_TYPED_INPUT_SQL}),
o AS (SELECT event_id, ts, unnest(from_json(txt, '["JSON"]')) AS obj FROM x WHERE json_type(txt) = 'ARRAY'),
kv AS (SELECT event_id, ts, unnest(json_keys(obj)) AS k, obj FROM o WHERE json_type(obj) = 'OBJECT'),
v AS (SELECT event_id, ts, k, obj, json_extract(obj, '$."' || k || '"') AS j FROM kv),
t AS (SELECT *, CASE json_type(j) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array'
                     WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS kind FROM v),
r AS (SELECT event_id, ts, k, kind, CASE WHEN kind = 'number' THEN CAST(j AS DOUBLE) END AS number, CASE WHEN kind = 'boolean' THEN CAST(j AS BOOLEAN) END AS flag,
             CASE WHEN kind = 'string' THEN j ->> '$' WHEN kind IN ('array', 'object') THEN CAST(j AS VARCHAR) END AS "text", obj FROM t),
d AS (SELECT event_id, ts, list({{'k': k, 'kind': kind, 'number': number, 'flag': flag, 't': "text"}} ORDER BY k) AS entries FROM r GROUP BY event_id, ts, CAST(obj AS VARCHAR)),
u AS (SELECT DISTINCT event_id, ts, entries FROM d)
SELECT event_id, ts AS access_time, e.k AS "key", e.kind AS kind, e.number AS number, e.flag AS flag, e.t AS "text"
FROM (SELECT event_id, ts, unnest(entries) AS e FROM u)""")
def f14_json_typed_rows(spark, sf):
    return J.json_typed_rows(_typed_input(spark, sf), "txt", "ts", keep=("event_id",))


@query("f15_to_json_text", oracle="""
SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey})
                  AS VARCHAR) AS js
FROM customer""")
def f15_to_json_text(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", J.to_json_text("c_custkey", "c_name", "c_nationkey").alias("js"))


_TXN_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       '(' || l_partkey || ':' || l_linenumber || ',' || l_suppkey || ':' || CAST(l_quantity AS BIGINT)
           || ',' || l_returnflag || ':' || l_linestatus || ')' AS line
FROM lineitem"""


def _txn_lines(spark, sf):
    li = table(spark, sf, "lineitem")
    line = F.concat(F.lit("("), F.col("l_partkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string"),
                    F.lit(","), F.col("l_suppkey").cast("string"), F.lit(":"),
                    F.col("l_quantity").cast("bigint").cast("string"), F.lit(","), "l_returnflag", F.lit(":"),
                    "l_linestatus", F.lit(")"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", line.alias("line"))


_CLEAN_SQL = """regexp_replace(regexp_replace(regexp_replace(line, '[()]', '', 'g'), ',', ' ', 'g'),
                               ':[0-9]{1,10} ', ' ', 'g')"""


@query("f16_clean_transaction", oracle=f"""
WITH t AS ({_TXN_SQL})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_CLEAN_SQL} AS txn FROM t""")
def f16_clean_transaction(spark, sf):
    t = _txn_lines(spark, sf)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C.clean_transaction("line").alias("txn"))


@query("f17_filter_unique_tokens", oracle=f"""
WITH t AS ({_TXN_SQL}), c AS (SELECT l_orderkey, l_linenumber, {_CLEAN_SQL} AS txn FROM t)
SELECT l_orderkey, l_linenumber, txn FROM c
WHERE len(list_distinct(string_split(txn, ' '))) = len(string_split(txn, ' '))""")
def f17_filter_unique_tokens(spark, sf):
    t = _txn_lines(spark, sf).select("l_orderkey", "l_linenumber", C.clean_transaction("line").alias("txn"))
    return t.where(C.tokens_unique("txn"))


_FILES_SQL = """
SELECT source || '/' || CAST(doc_id AS VARCHAR) AS fname,
       CASE lang WHEN 'de' THEN "text" || chr(10) || 'BindException while binding port'
                 WHEN 'fr' THEN "text" || chr(10) || 'java.lang.IllegalStateException: closed'
                 WHEN 'es' THEN 'Error: ' || "text"
                 ELSE "text" END AS content
FROM documents"""


def log_files(spark, sf, keep=()):
    """Documents as log files with injected error lines (by language)."""
    d = table(spark, sf, "documents")
    nl = F.lit("\n")
    content = (F.when(F.col("lang") == "de", F.concat("text", nl, F.lit("BindException while binding port")))
               .when(F.col("lang") == "fr", F.concat("text", nl, F.lit("java.lang.IllegalStateException: closed")))
               .when(F.col("lang") == "es", F.concat(F.lit("Error: "), "text"))
               .otherwise(F.col("text")))
    return d.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("fname"),
                    content.alias("content"), *keep)


@query("f18_error_filter", oracle=f"""
WITH f AS ({_FILES_SQL})
SELECT fname || ':' || chr(10) || content AS report FROM f
WHERE upper(replace(content, 'BindException', '')) LIKE '%ERROR%'
   OR upper(replace(content, 'BindException', '')) LIKE '%EXCEPTION%'""")
def f18_error_filter(spark, sf):
    return C.error_filter(log_files(spark, sf), "fname", "content")


@query("f18_error_lines", oracle=f"""
WITH f AS (SELECT source || '-' || lang AS log, translate(content, chr(13), ' ') AS c
           FROM ({_FILES_SQL.replace("SELECT source", "SELECT source, lang, source", 1)}))
SELECT log, CAST(sum(len(c) - len(replace(c, chr(10), '')) + 1) AS BIGINT) AS lines FROM f GROUP BY log
HAVING bool_or(upper(replace(c, 'BindException', '')) LIKE '%ERROR%' OR upper(replace(c, 'BindException', '')) LIKE '%EXCEPTION%')""")
def f18_error_lines(spark, sf):
    """The logs written as text files, one folder per source and language, and read back in byte ranges."""
    files = log_files(spark, sf, keep=(F.concat("source", F.lit("-"), "lang").alias("log"),))
    path = f"{checkpoint_dir(spark).rstrip('/')}/logs-{uuid.uuid4().hex}"
    files.select("log", F.translate("content", "\r", " ").alias("value")).where("log is not null and value is not null").write.partitionBy("log").text(path)
    lines = spark.read.text(path).select("log", F.col("value").alias("line"))
    return TX.error_report_lines(lines, "log").groupBy("log").agg(F.count(F.lit(1)).alias("lines"))


@query("f19_trunc4", oracle="""
SELECT c_custkey, trunc(c_acctbal / 7 * 10000) / 10000 AS t4 FROM customer""")
def f19_trunc4(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.trunc4(F.col("c_acctbal") / 7).alias("t4"))


@query("f20_string_pick", oracle="""
SELECT p_partkey, substr(p_name, 1, 1) AS first, substr(p_name, 3) AS rest FROM part""")
def f20_string_pick(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", C.first_char("p_name").alias("first"), C.from_third_char("p_name").alias("rest"))


@query("f21_reshape_columns", oracle="""
SELECT n_name AS "key", n_nationkey AS "value", n_regionkey AS region FROM nation""")
def f21_reshape_columns(spark, sf):
    n = table(spark, sf, "nation")
    swapped = n.select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("value"), "n_regionkey")
    return swapped.withColumnRenamed("n_regionkey", "region")


@query("f22_rand_column")
def f22_rand_column(spark, sf):
    """Seeded uniform columns (the values are Spark's own: no twin; see the next query)."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.rand_column(10).alias("a"), C.rand_column(27).alias("b"))


@query("f22_rand_in_range", oracle="SELECT c_custkey, true AS a_in_range, true AS b_in_range FROM customer")
def f22_rand_in_range(spark, sf):
    """What SQL can state of them: each lies in [0, 1)."""
    inside = lambda x: (F.col(x) >= 0) & (F.col(x) < 1)
    return f22_rand_column(spark, sf).select("c_custkey", inside("a").alias("a_in_range"), inside("b").alias("b_in_range"))


_DOC_LABELS_SQL = """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _doc_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left")


@query("f23_drop_nulls", oracle=f"""
WITH x AS ({_DOC_LABELS_SQL})
SELECT * FROM x WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def f23_drop_nulls(spark, sf):
    return C.drop_nulls(_doc_labels(spark, sf))


@query("f24_fill_default", oracle=f"""
WITH x AS ({_DOC_LABELS_SQL})
SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM x""")
def f24_fill_default(spark, sf):
    x = _doc_labels(spark, sf)
    return x.select("doc_id", "lang", C.fill_default("quality", -1).alias("quality"),
                    C.fill_default("toxic", 0).alias("toxic"))


@query("s14_sql_view", oracle="""
SELECT event_id, CASE WHEN "value" / 100 > 0.5 THEN 1 ELSE 0 END AS flag, event_type FROM events""")
def s14_sql_view(spark, sf):
    """Register a view and run SQL text on it (the flag of F2 written as SQL)."""
    table(spark, sf, "events").createOrReplaceTempView("tessera_events")
    return spark.sql("SELECT event_id, CASE WHEN value / 100 > 0.5 THEN 1 ELSE 0 END AS flag, event_type "
                     "FROM tessera_events")
