import collections
import os
import random

import corpus_pipeline
from tessera.llm import exact_dedup, mixing, packing, simhash, toxicity
from tessera.llm.shared import shared_dir
from tessera.session import checkpoint_dir
from tests.llm import test_exact_dedup, test_mixing, test_packing, test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return collections.Counter(map(tuple, df.select(COLUMNS).collect()))


def test_stages_and_run_equal_brute_force(spark, docs, sf):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120))) for _ in range(120)]
    rows, toxic = [], {}
    for i in range(400):
        t = rng.choice(base) if i % 4 == 0 else " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120)))
        if i % 8 == 0:
            t += " end"
        toxic[i] = int(i % 6 == 0)
        if toxic[i]:
            t += " badword vileword"
        rows.append((i, t.upper() if i % 5 == 0 else t, f"s{i % 3}"))
    rows += [(1000, None, None), (1001, "", None), (1001, "", None), (None, base[0], "s1"), (1002, "long " * 30_000, "s2")]
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    path = sf(documents=docs(rows), labels=labels)
    docs_now = spark.read.parquet(f"{path}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs_now, path)
        have = [(r.doc_id, r.text, r.source) for r in docs_now.collect()]
        if n < 4:
            assert got.columns == COLUMNS
        if name == "toxicity":
            left = {r[0] for r in rows_of(got)}
            clean = {i for i, t in toxic.items() if not t}
            assert len(left & clean) >= 0.99 * len(clean) and len(left & {i for i, t in toxic.items() if t}) <= 3
        elif name == "exact_dedup":
            want = {}
            for i, t, s in have:
                k = test_exact_dedup.lower(t)
                if k not in want or (i is not None and (want[k][0] is None or i > want[k][0])):
                    want[k] = (i, t)
            assert sorted(((r[0], r[1]) for r in rows_of(got).elements()), key=repr) == sorted(want.values(), key=repr)
        elif name == "near_dedup":
            comp = test_simhash.brute_components([i for i, _, _ in have], [test_simhash.brute_fingerprint(t) for _, t, _ in have])
            keep = sorted(str(c) for c in set(comp))
            assert sorted(str(r[0]) for r in rows_of(got).elements()) == keep
        elif name == "mixing":
            want = {}
            for i, _, t in test_mixing.brute(have)[0]:
                want[i] = want.get(i, 0) + t
            took = collections.Counter()
            for r in rows_of(got).elements():
                took[r[0]] += len(test_mixing.words(r[1]))
            assert +took == +collections.Counter(want)
        else:
            ids = collections.Counter()
            for r in got.collect():
                ids[tuple(r.ids)] += 1
            want = collections.Counter()
            for _, t, _ in have:
                full, at = test_packing.plain(t) + [2], 0
                for k in packing.piece_lengths(len(full)):
                    want[tuple(full[at:at + k])] += 1
                    at += k
            assert ids == want
        got.write.parquet(out := f"{path}/{name}.parquet")
        docs_now = spark.read.parquet(out)
    folders = {f(spark).removeprefix("file:") for f in (checkpoint_dir, shared_dir)}
    had = {x for f in folders for x in os.listdir(f)}
    run = corpus_pipeline.run(spark, path)
    new = {x for f in folders for x in os.listdir(f)} - had
    assert len(new) == 1 and new.pop().startswith("tessera-stage-packing-")       # no helper table and no earlier stage is left
    assert run.columns == docs_now.columns and run.count() == docs_now.count()
    assert sorted(map(str, run.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(str, docs_now.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_empty_documents(spark, docs, sf):
    path = sf(documents=docs([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, path).count() == 0
