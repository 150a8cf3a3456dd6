import random
import re

import numpy as np
import xxhash

from pyspark.sql import functions as F
from tessera.llm import simhash
from tessera.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(ids, fps, radius=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def sample_texts(seed=1, n=120):
    rng, words = random.Random(seed), [f"w{i}É" for i in range(60)] + ["The", "the", "A.", "x y"]
    texts = [None, "", " \t\n", "one", "Two words", "Ein kurzer TEXT hier", " "]
    for _ in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(1, 90))]
        texts.append(" ".join(t))
        for _ in range(rng.randint(0, 3)):
            t = list(t)
            t[rng.randrange(len(t))] = rng.choice(words)
            texts.append("\n".join(t))
    return texts + texts[10:40]


def test_fingerprint_equals_brute_force_and_blocks_do_not_matter(monkeypatch):
    for t in sample_texts():
        want = brute_fingerprint(t)
        assert simhash.fingerprint(None if t is None else t.encode()) == want
    long = " ".join(f"Word{i % 977} x{i}" for i in range(4000))
    want = simhash.fingerprint(long.encode())
    monkeypatch.setattr(simhash, "word_blocks", lambda d: __import__("tessera.llm.shared", fromlist=["x"]).word_blocks(d, 100))
    assert simhash.fingerprint(long.encode()) == want


def test_query_equals_brute_force(spark, docs):
    texts = sample_texts()
    rows = [(i * 3 + 5, t) for i, t in enumerate(texts)] + [(5, "dup id"), (5, "dup id"), (None, texts[20]), (None, "alone é")]
    for tile in (16, 1 << 16):
        got = simhash.near_dup_components(docs(rows), tile=tile).collect()
        fps = [brute_fingerprint(t) for _, t in rows]
        comp = brute_components([r[0] for r in rows], fps)
        want = sorted((str(r[0]), f"{f:016x}", str(c)) for r, f, c in zip(rows, fps, comp))
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_tiles_find_every_link_of_dense_and_sparse_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(k)) ^ (np.uint64(1) << np.uint64(m)) for b in base[:8] for k in range(0, 60, 2) for m in range(1, 20, 3)]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    rng.shuffle(fps)
    a, b = fps[:len(fps) // 2], fps[len(fps) // 2:]
    edges = [simhash.tile_links(a, None), simhash.tile_links(b, None), simhash.tile_links(a, b)]
    at = {int(x): i for i, x in enumerate(fps)}
    i = np.array([at[int(x)] for e in edges for x in e[0]], int)
    j = np.array([at[int(x)] for e in edges for x in e[1]], int)
    lab = simhash._labels(i, j, len(fps))
    want = brute_components(list(range(len(fps))), [int(x) for x in fps])
    assert lab.tolist() == want
    assert len(i) <= 2 * len(fps)


def test_near_dedup_keeps_one_row_of_each_group_with_all_columns(spark, docs):
    t = " ".join(f"w{i}" for i in range(300))
    df = docs([(9, t), (4, t), (4, t), (None, t), (7, t + " end"), (11, "other text entirely different here"), (None, None)])
    df = df.withColumn("_rid", F.lit(1)).withColumn("FP", F.lit("x"))
    got = simhash.near_dedup(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("4", t), ("11", "other text entirely different here"), ("None", None)], key=lambda x: (x[0], str(x[1])))


def test_empty_table_and_chain(spark, docs):
    assert simhash.near_dup_components(docs([])).count() == 0
    assert simhash.near_dedup(docs([])).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(5, 5), (None, 3)], "u long, v long")
    got = {r.vertex: r.root for r in components(chain).collect()}
    assert got == {i: 0 for i in range(1, 41)}
