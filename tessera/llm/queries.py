"""Registered queries opN_<name> of this subpackage and their DuckDB twins.

Each query applies its operator, with production parameters, to the whole
table.  A query without SQL is tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (cross_align, exact_dedup, line_dedup, mixing, packing, periodic, piece_codec, sharding, simhash, topk, toxicity,
                         url_filter, warczip)
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_simhash_near_dedup")
def op1(spark, sf_dir):
    return simhash.near_dup_components(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT page_id, t, octet_length(encode(t)) AS n, max(page_id) OVER (PARTITION BY t) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""


@query("op2_warc_zip_archive", OP2_SQL)
def op2(spark, sf_dir):
    return warczip.archive_report(table(spark, sf_dir, "pages"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, l, len(l) AS n, unnest(range(1, len(l) + 1)) AS i FROM d WHERE text IS NOT NULL),
c AS (SELECT *, len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS c1,
             len(regexp_extract_all(coalesce(l[i + 1], ''), '[^\x20\x09-\x0D]+')) AS c2 FROM x),
z AS (SELECT *, list_filter([CASE WHEN c1 >= 50 THEN 1 END, CASE WHEN i + 1 <= n AND c1 + c2 >= 50 THEN 2 END, CASE WHEN i + 2 <= n THEN 3 END], lambda x: x IS NOT NULL) AS z FROM c),
w AS (SELECT doc_id, l, i, unnest(CASE WHEN len(z) > 0 THEN z WHEN i = 1 THEN [n] ELSE [] END) AS sz FROM z),
r AS (SELECT doc_id, i, sz, row_number() OVER (PARTITION BY l[i:i + sz - 1] ORDER BY doc_id, i) AS rn FROM w WHERE sz IS NOT NULL),
g AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + sz)) AS j FROM r WHERE rn > 1) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS deleted,
       sha256(coalesce(CASE WHEN gone IS NULL THEN text
                            ELSE array_to_string(list_filter(l, lambda x, k: NOT list_contains(gone, k)), chr(10)) END, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op4_uniform_threshold_topk", OP4_SQL)
def op4(spark, sf_dir):
    return topk.topk_every(table(spark, sf_dir, "embeddings"))


@query("op5_karmarkar_karp_shards")
def op5(spark, sf_dir):
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@query("op6_pu_toxicity")
def op6(spark, sf_dir):
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s),
-- water level num / den after the first i sources (by size per weight) are topped at twice their size
o AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i FROM w),
lv AS (SELECT i, source_size, w,
         3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         2 * sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den FROM o),
l AS (SELECT num, den FROM lv WHERE w * num <= 2 * source_size * den ORDER BY i LIMIT 1),
t AS (SELECT source, source_size,
         CASE WHEN w * num > 2 * source_size * den THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
         CAST(CASE WHEN w * num > 2 * source_size * den THEN 2 * source_size ELSE (w * num) // den END AS BIGINT) AS budget
      FROM w, l),
p AS (SELECT doc_id, d.size, source_size, target, budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM p
"""


@query("op7_source_mix", OP7_SQL)
def op7(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
"""


@query("op8_exact_dedup", OP8_SQL)
def op8(spark, sf_dir):
    return exact_dedup.exact_dedup_report(table(spark, sf_dir, "documents"))


@query("op9_pack_powers_of_two")
def op9(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def _op10_sql(rounds: int) -> str:
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    step = """,
s{i} AS MATERIALIZED (SELECT host, kind, sum(mass) AS mass FROM (
  SELECT * FROM s0 UNION ALL
  SELECT f.dst, f.kind, s.mass * f.part FROM s{j} s JOIN f ON s.host = f.src AND s.kind = f.kind) GROUP BY host, kind)"""
    return """
WITH p AS (SELECT *, row_number() OVER () AS n, position('://' IN url) AS cut FROM pages),
c AS (SELECT n, page_id, html, CASE WHEN cut > 0 THEN substr(url, cut + 3) ELSE '' END AS rest FROM p),
h AS (SELECT n, page_id, html, """ + low("regexp_extract(rest, '^[^/?#]*')") + """ AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM c),
rules(v, rh, rp) AS (VALUES """ + ", ".join(str(r) for r in url_filter.RULES) + """),
m AS (SELECT n, rh || rp AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC, length(rh) DESC) AS rn
      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
j AS (SELECT h.*, rule, v FROM h LEFT JOIN m ON h.n = m.n AND rn = 1),
l AS (SELECT host AS src, unnest(regexp_extract_all(html, '""" + url_filter.LINK.replace("'", "''") + """', 1)) AS link FROM j),
e AS (SELECT src, dst, count(*) AS links FROM (SELECT src, """ + low("regexp_extract(link, '//([^/?#]*)', 1)") + """ AS dst FROM l)
      WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
f AS MATERIALIZED (SELECT src, dst, 0 AS kind, links * 0.85 / sum(links) OVER (PARTITION BY src) AS part FROM e UNION ALL
      SELECT dst, src, 1, links * 0.85 / sum(links) OVER (PARTITION BY dst) FROM e),
s0 AS (SELECT host, CASE WHEN v = 'allow' THEN 0 ELSE 1 END AS kind, CAST(count(*) AS DOUBLE) * 0.15 AS mass
       FROM j WHERE v IS NOT NULL AND host <> '' GROUP BY ALL)""" + "".join(step.format(i=i, j=i - 1) for i in range(1, rounds + 1)) + """,
b AS (SELECT host FROM s{r} GROUP BY host HAVING coalesce(sum(mass) FILTER (kind = 1), 0) > coalesce(sum(mass) FILTER (kind = 0), 0) * (1 + 1e-9))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host IN (SELECT host FROM b) THEN 'block' ELSE 'allow' END) AS verdict FROM j
""".replace("{r}", str(rounds))


@query("op10_link_graph_url_filter", _op10_sql(url_filter.ROUNDS))
def op10(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    return periodic.run_report(table(spark, sf_dir, "documents"))


@query("op12_cross_tokenizer_alignment")
def op12(spark, sf_dir):
    return cross_align.alignment_report(table(spark, sf_dir, "documents"))


@query("op13_sentencepiece_codec")
def op13(spark, sf_dir):
    return piece_codec.codec_report(table(spark, sf_dir, "documents"))
