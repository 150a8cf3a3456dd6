import hashlib
import re
from fractions import Fraction

from pyspark.sql import functions as F
from tessera.llm import mixing


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(rows):
    """rows (doc_id, text, source) -> {(doc_id, size): taken}, {source: target}"""
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, full = Fraction(3 * sum(size.values()), 2), set()
    while True:
        free = [s for s in order if s not in full]
        level = (left - sum(2 * size[s] for s in full)) / max(1, sum(weight[s] for s in free))
        new = {s for s in free if weight[s] * level > 2 * size[s]}
        if not new:
            break
        full |= new
    target = {s: Fraction(2 * size[s]) if s in full else weight[s] * level for s in order}
    taken = []
    for s in order:
        budget = int(target[s])
        mine = sorted(((hashlib.md5(f"mix-1:{'null' if i is None else i}".encode()).hexdigest(), len(words(t)), i)
                       for i, t, x in rows if x == s), key=lambda r: r[:2])
        epochs, rest = divmod(budget, size[s]) if size[s] else (0, 0)
        for _, n, i in mine:
            taken.append((i, n, epochs * n + max(0, min(n, rest))))
            rest -= n
    return taken, target


ROWS = ([(i, " ".join(["w"] * (i * 7 % 23 + 1)), f"s{i % 4}") for i in range(90)]
        + [(100, None, "s0"), (101, "", "s1"), (102, "one", None), (102, "one", None), (None, "null id text", "s2"),
           (103, " \t\n", "empty"), (104, "a b c é", "Été"), (105, "x " * 5000, "hot"), (106, "y\tz", "hot")])


def test_report_equals_brute_force_for_any_range_size(spark, docs, monkeypatch):
    taken, target = brute(ROWS)
    for n in (2, 1 << 16):
        monkeypatch.setattr(mixing, "RANGE_ROWS", n)
        got = mixing.mix_report(docs(ROWS)).collect()
        assert sorted(((r.doc_id, r.size, r.taken) for r in got), key=repr) == sorted(taken, key=repr)
        assert len(got) == len(ROWS)
        for r in got:
            assert r.taken <= 2 * r.size
    sums = {}
    for r in got:
        sums[r.target] = sums.get(r.target, 0) + r.taken
    assert {round(t, 6) for t in sums} == {round(float(t), 6) for t in target.values()}


def test_mix_takes_exactly_the_reported_words(spark, docs, sf):
    path = sf(documents=docs(ROWS))
    df = spark.read.parquet(f"{path}/documents.parquet").withColumn("_SIZE", F.lit(1)).withColumn("cut", F.lit("c"))
    got = mixing.mix(df)
    assert got.columns == df.columns
    have = {}
    for r in got.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + len(words(r.text))
        assert r.text is None or any(t is not None and t.startswith(r.text) for i, t, _ in ROWS if i == r.doc_id)
    want = {}
    for i, n, t in brute(ROWS)[0]:
        want[i] = want.get(i, 0) + t
    assert {k: v for k, v in have.items() if v} == {k: v for k, v in want.items() if v}


def test_first_words():
    assert mixing._first_words(b" a  b\tc ", 2) == b" a  b"
    assert mixing._first_words(b" a  b\tc ", 3) == b" a  b\tc"
    text = b"word \n" * 900_000
    assert mixing._first_words(text, 700_001).split() == [b"word"] * 700_001


def test_empty_and_wordless(spark, docs):
    assert mixing.mix_report(docs([])).count() == 0
    assert mixing.mix(docs([])).count() == 0
    got = mixing.mix_report(docs([(1, "", "a"), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_many_rows_of_one_id_and_many_blocks(spark, docs, monkeypatch):
    """All rows of a source under one key, some of one size: the same cut as by row id, whatever the ranges."""
    rows = [(7, " ".join(["w"] * (3 if i % 2 else 5)), "hot") for i in range(3000)] + [(None, "a b", "nulls")] * 50 + [(i, "x y z", "many") for i in range(400)]
    taken, _ = brute(rows)
    for per_range, per_block in ((2, 3), (1 << 13, 1 << 12)):
        monkeypatch.setattr(mixing, "RANGE_ROWS", per_range)
        monkeypatch.setattr(mixing, "BLOCK_RANGES", per_block)
        got = mixing.mix_report(docs(rows)).collect()
        assert sorted(((r.doc_id, r.size, r.taken) for r in got), key=repr) == sorted(taken, key=repr)
    plan = mixing.source_cuts(mixing._rows(docs(rows)))._jdf.queryExecution().toString()
    assert "_range" in plan          # positions come from ranges of rows, not from one task per key
