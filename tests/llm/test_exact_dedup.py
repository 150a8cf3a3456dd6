import hashlib

from pyspark.sql import functions as F
from tessera.llm import exact_dedup


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


ROWS = [(1, "Same Text É"), (2, "same text É"), (3, "same text é"), (4, None), (5, ""), (6, "İ K Straße"), (7, "i̇ k straße"),
        (8, "x" * 300_000), (9, "X" * 300_000), (9, "X" * 300_000), (None, "same text É"), (None, "only null id"),
        (None, "only null id"), (10, "a\nb"), (11, "a b")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        out.append((i, max(ids) if ids else None, len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_report_equals_brute_force(spark, docs):
    got = exact_dedup.exact_dedup_report(docs(ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(ROWS)
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len({k for _, k in kept}) == len({lower(t) for _, t in ROWS})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_directory_splits_until_buckets_fit(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    alike = spark.range(300).select((F.col("id") + 5).alias("h"))       # 55 leading bits in common
    both = hashes.union(alike).persist()
    for rows, cap in ((hashes, 40), (both, 40), (hashes, 1), (both, 7), (hashes, 10_000)):
        slots, depth = exact_dedup.directory(rows, capacity=cap)
        slots = {r.slot: r.bucket for r in slots.collect()}
        buckets = set(slots.values())
        assert not any(a != b and b.startswith(a) for a in buckets for b in buckets)
        held = {}
        for r in rows.collect():
            slot = f"{r.h % (1 << 64):064b}"[:depth]
            held[slots[slot]] = held.get(slots[slot], 0) + 1
        assert max(held.values()) <= cap and set(held) == buckets
        assert depth > 50 if rows is both else depth < 40


def test_no_directory_no_result(spark, docs, monkeypatch):
    """The buckets are on the path: without slots nothing is found."""
    real = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda h, c: (real(h, c)[0].where("false"), real(h, c)[1]))
    assert exact_dedup.exact_dedup_report(docs(ROWS)).count() == 0


def test_texts_of_one_hash_are_chained_by_their_bytes(spark, docs):
    """Every text, or texts of one length, under one forced hash."""
    for forced in (lambda c: F.lit(5).cast("long") + F.length(c) * 0, lambda c: F.length(c).cast("long")):
        got = exact_dedup.exact_dedup_report(docs(ROWS), hash_of=forced).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(ROWS)
        _, index = exact_dedup.build_index(docs(ROWS), hash_of=forced)
        chains = {}
        for r in index.collect():
            chains.setdefault(r.h, []).append(r.chain)
        assert all(sorted(c) == list(range(1, len(c) + 1)) for c in chains.values()) and max(map(len, chains.values())) > 1
        assert exact_dedup.exact_dedup(docs(ROWS), hash_of=forced).count() == len({lower(t) for _, t in ROWS})


def test_small_buckets_give_the_same_result_and_stage_keeps_columns(spark, docs):
    df = docs(ROWS).withColumn("RID", F.lit("x")).withColumn("_rid", F.lit(2))
    got = exact_dedup.exact_dedup(df, capacity=1)
    assert got.columns == df.columns
    rows = got.collect()
    assert len(rows) == len({lower(t) for _, t in ROWS})
    assert {r.doc_id for r in rows} >= {2, 3, 5, 6, 7, 9, 10, 11}


def test_empty_table(spark, docs):
    assert exact_dedup.exact_dedup_report(docs([])).count() == 0
    assert exact_dedup.exact_dedup(docs([])).count() == 0


def test_plan_has_no_python(spark, docs):
    plan = exact_dedup.exact_dedup_report(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
