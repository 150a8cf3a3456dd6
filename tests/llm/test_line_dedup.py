import hashlib
import random
import re

from pyspark.sql import functions as F
from tessera.llm import line_dedup


def brute_runs(rows, min_lines=3, min_words=50):
    """rows [(doc_id, text)] -> kept texts, by every maximal run that equals one at an earlier place"""
    size = lambda ls: sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in ls)
    docs = [[] if t is None else t.split("\n") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r))
    places, gone, shorts = [(r, i) for r in order for i in range(len(docs[r]))], [set() for _ in rows], set()
    for n, (r, i) in enumerate(places):
        for q, j in places[:n]:
            a, b = docs[r], docs[q]
            if a[i] != b[j] or (i and j and a[i - 1] == b[j - 1]):
                continue
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            if k >= min_lines or size(a[i:i + k]) >= min_words:
                gone[r].update(range(i, i + k))
    for r in order:
        if docs[r] and len(docs[r]) < min_lines and size(docs[r]) < min_words:
            gone[r].update(range(len(docs[r])) if tuple(docs[r]) in shorts else ())
            shorts.add(tuple(docs[r]))
    return [(rows[r][0], None if t is None else "\n".join(x for i, x in enumerate(docs[r]) if i not in gone[r]), len(gone[r]))
            for r, (_, t) in enumerate(rows)]


def sample():
    rng = random.Random(4)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 8))) for _ in range(50)]
    long = " ".join(f"p{i}" for i in range(60))
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    run = "\n".join(lines[:7])
    rows += [(100 + i, f"own {i}\n{run}\ntail {i}") for i in range(6)] + [(200 + i, f"x{i}\n{long}\ny{i}") for i in range(4)]
    rows += [(300, "A\nA\nA\nA\nA\nA"), (301, None), (302, ""), (303, ""), (304, "short"), (305, "short"), (305, "short"),
             (None, run), (None, "only\nhere\nindeed"), (306, "a\r\nb\r\n\r\n"), (307, "\n\n\n\n"), (308, long), (309, f"{long}\n{long}"),
             (310, "\n".join(f"line {i}" for i in range(5000))), (311, "\n".join(f"line {i}" for i in range(2500, 5200)))]
    return rows


def test_report_equals_brute_force(spark, docs, sf):
    rows = sample()
    path = sf(documents=docs(rows).coalesce(1))
    got = line_dedup.dedup_lines(spark.read.parquet(f"{path}/documents.parquet")).collect()
    assert sorted(((r.doc_id, r.text, r.deleted) for r in got), key=repr) == sorted(brute_runs(rows), key=repr)
    assert all(r.lines == (0 if t is None else t.count("\n") + 1) for r, t in
               ((r, next(t for i, t in rows if i == r.doc_id)) for r in got if r.doc_id not in (None,)))
    rep = line_dedup.line_report(spark.read.parquet(f"{path}/documents.parquet")).collect()
    assert sorted((str(r.doc_id), r.kept_sha256) for r in rep) == sorted(
        (str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in brute_runs(rows))


def test_clean_texts_and_clashing_columns(spark, docs):
    df = docs([(1, "a\nb\nc\nd"), (2, "e\nf\ng")]).withColumn("LINES", F.lit("z")).withColumn("_mask", F.lit(1))
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_mask", "lines", "deleted"]
    assert sorted((r.doc_id, r.text, r.deleted) for r in got.collect()) == [(1, "a\nb\nc\nd", 0), (2, "e\nf\ng", 0)]


def test_empty_table_and_plan_without_python(spark, docs):
    got = line_dedup.line_report(docs([]))
    assert got.count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_last_lines_of_a_run_are_deleted(spark, docs, sf):
    words = lambda n, tag: " ".join(f"{tag}{i}" for i in range(n))
    run, head = "\n".join((words(25, "a"), words(26, "b"), words(20, "c"))), f"{words(60, 'l')}\nshort one\nshort two"
    rows = [(1, f"x\n{run}\ny"), (2, f"z\n{run}\nw"), (3, f"{words(60, 'l')}\nelse"), (4, f"p\n{head}\nq"), (5, f"r\n{head}\ns")]
    rng = random.Random(9)
    pool = [words(n, t) for n, t in ((60, "g"), (30, "h"), (30, "i"), (45, "j"), (4, "k"), (3, "m"), (1, "n"))]
    rows += [(10 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(60)] + [(90, None), (91, ""), (91, "")]
    path = sf(documents=docs(rows).coalesce(1))
    got = line_dedup.dedup_lines(spark.read.parquet(f"{path}/documents.parquet")).collect()
    kept = {r.doc_id: r.text for r in got}
    assert kept[2] == "z\nw" and kept[5] == "r\ns"
    assert sorted(((r.doc_id, r.text, r.deleted) for r in got), key=repr) == sorted(brute_runs(rows), key=repr)


def lines_of(spark, *texts):
    return spark.createDataFrame([(r, r, i, h, -h, 5) for r, t in enumerate(texts) for i, h in enumerate(t)],
                                 "rid long, doc_id long, pos int, h1 long, h2 long, words int")


def test_windows_select_their_rightmost_least_line(spark):
    wins = line_dedup.windows(lines_of(spark, (7, 3, 9, 3, 7, 3, 9)))
    assert wins.columns == ["rid", "doc_id", "pos", "size", "k1", "k2", "fp", "at"]
    at = {}
    for r in wins.collect():
        assert r.fp == 3
        at.setdefault((r.k1, r.k2), []).append((r.pos, r.size, r.at))
    assert sorted(map(sorted, at.values())) == [[(0, 3, 1), (4, 3, 5)], [(1, 3, 3)], [(2, 3, 3)], [(3, 3, 5)]]


def test_matches_join_positions_and_grow_into_runs(spark):
    """Text 2 has a run of text 1 and one of text 0 that overlap; lone fingerprints are not joined at all."""
    lines = lines_of(spark, (50, 10, 11, 12, 13, 51), (60, 12, 13, 14, 15, 16, 61), (70, 10, 11, 12, 13, 14, 15, 16, 71), (80, 81, 82))
    found = line_dedup.matches(lines).collect()
    assert sorted((r.rid, r.pos, r.first.rid, r.first.pos) for r in found) == [(2, 1, 0, 1), (2, 2, 0, 2), (2, 3, 1, 1), (2, 4, 1, 2), (2, 5, 1, 3)]
    assert all(r["at"] - r.pos == r.first["at"] - r.first.pos for r in found)
    assert sorted(map(tuple, line_dedup.runs(line_dedup.matches(lines)).collect())) == [(2, 1, 5), (2, 3, 8)]
    assert sorted(r.pos for r in line_dedup.repeated_lines(lines).collect()) == [1, 2, 3, 4, 5, 6, 7]
