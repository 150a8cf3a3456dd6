import random
import zlib

from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import queries, sharding
from tests.conftest import SF_SMALL


def check(rows, got, k=8):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, shard_of = {}, {}
    for r in got:
        assert 0 <= r.shard < k and r.grown_shard is None and r.law == "bytes"
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sums = [0] * k
    for r in got:
        sums[r.shard] += r.size
    return sums


def test_all_rows_in_balanced_shards_of_whole_groups(spark, docs):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(1, 4000) + str(i)) for i in range(1500)] + [(2000 + i, "copy of é") for i in range(200)]
    rows += [(None, None), (7, ""), (7, "")]
    for cell in (1 << 15, 60):
        sums = check(rows, sharding.shard_report(docs(rows), cell_groups=cell).collect())
        assert max(sums) - min(sums) <= 64


def test_group_larger_than_a_shard_stays_whole(spark, docs):
    rows = [(i, "hot " * 50) for i in range(400)] + [(1000 + i, f"text {i} " * (1 + i % 30)) for i in range(600)]
    sums = sorted(check(rows, sharding.shard_report(docs(rows)).collect()))
    assert sums[-1] == 400 * 201 and sums[-2] - sums[0] <= 64


def test_differencing_beats_greedy_on_known_case():
    place = sharding.difference([[w, 0] for w in (8, 7, 6, 5, 4)], 2)
    sums = [0, 0]
    for w, p in zip((8, 7, 6, 5, 4), place):
        sums[p[0]] += w
    assert sorted(sums) == [14, 16]
    assert sharding.difference([], 3) == []
    place = sharding.difference([[5, 3, 1], [2, 2, 0], [9, 0, 0]], 3)
    assert all(sorted(p) == [0, 1, 2] for p in place)


def test_documents_keep_columns_and_empty_table(spark, docs):
    df = docs([(1, "a"), (1, "a"), (2, None)]).withColumn("G1", F.lit(0)).withColumn("_rid", F.lit(0))
    got = sharding.shard_documents(df)
    assert got.columns == df.columns + ["shard", "slot"] and got.count() == 3
    assert sharding.shard_report(docs([])).count() == 0


def test_cells_are_differenced_in_levels_away_from_the_driver(spark, docs, monkeypatch):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randint(1, 4000) + str(i)) for i in range(900)]
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(0)), "collect", lambda self: 1 / 0)
        reports = [sharding.shard_report(docs(rows), cell_groups=30, fan=fan) for fan in (3, 1 << 12)]
    deep, flat = (report.collect() for report in reports)
    sums = check(rows, deep)
    assert max(sums) - min(sums) <= 64
    check(rows, flat)


def test_one_level_places_the_cells_as_differencing_them_at_once(spark):
    rng = random.Random(7)
    sums = [[rng.randint(0, 99) for _ in range(3)] for _ in range(20)]
    parts = spark.createDataFrame([(c, j, b) for c, s in enumerate(sums) for j, b in enumerate(s)], "cell long, part int, bytes long")
    got = {r.cell: r.shards for r in sharding._parts_to_shards(parts, 3, 20).collect()}
    assert got == dict(enumerate(sharding.difference(sums, 3)))


def plain_differencing(weights, k=8):
    """Karmarkar-Karp by searching the whole list for the two widest partial partitions each time; groups by shard."""
    parts = [(w, n, [(w, [w])] + [(0, [])] * (k - 1)) for n, w in enumerate(sorted(weights, reverse=True))]
    born = len(parts)
    while len(parts) > 1:
        a = max(parts, key=lambda p: (p[0], -p[1]))
        parts.remove(a)
        b = max(parts, key=lambda p: (p[0], -p[1]))
        parts.remove(b)
        sums = sorted(((x + y, g + h) for (x, g), (y, h) in zip(a[2], b[2][::-1])), key=lambda s: -s[0])
        parts.append((sums[0][0] - sums[-1][0], born, sums))
        born += 1
    return parts[0][2] if parts else []


def test_query_equals_plain_differencing_over_whole_texts(spark):
    """The registered query over all documents of a driver table: shard sums, and the groups each shard holds."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op5_karmarkar_karp_shards"](spark, SF_SMALL).collect()
    sums = check(rows, got)
    weights = Counter()
    for _, t in rows:
        weights[t or ""] += len((t or "").encode()) + 1
    want = plain_differencing(list(weights.values()))
    assert sorted(sums) == sorted(s for s, _ in want)
    held = {}
    for r in got:
        held.setdefault(r.shard, Counter())[(r.text_crc32, r.size)] += r.size
    assert sorted(sorted(h.values()) for h in held.values()) == sorted(sorted(g) for _, g in want if g)
