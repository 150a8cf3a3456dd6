import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tests.conftest import SF_CHECK

LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    bad = ["vilename", "Grubber", "schlimmwort"]
    rows, toxic = [], {}
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([5, 60, 400]))]
        toxic[i] = int(rng.random() < 0.2)
        if toxic[i]:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ".", ",", "en"]))
        rows.append((i, " ".join(words)))
    return rows, toxic


def test_held_out_documents_are_told_apart(spark, docs):
    rows, toxic = corpus()
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items() if i % 2] + [(4, None, None), (None, 1, 1), (99999, 1, 1)], LABELS)
    odd = [(5000, None), (5001, ""), (None, "vilename vilename grubber"), (5002, "clean " * 700_000), (3, rows[3][1])]
    got = toxicity.toxicity_report(docs(rows + odd), labels).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [r for r in got if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in test]) > 0.97
    by = {r.doc_id: r.predicted for r in got if r.doc_id is None or r.doc_id >= 5000}
    assert by == {5000: 0, 5001: 0, 5002: 0, None: 1}
    again = toxicity.toxicity_report(docs(rows + odd), labels).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    clean = toxicity.drop_toxic(docs(rows + odd).withColumn("_SCORE", F.lit(1)), labels)
    assert clean.columns[-1] == "_SCORE" and clean.count() == sum(r.predicted == 0 for r in got)


def test_labels_of_held_out_documents_are_not_read(spark, docs):
    rows, toxic = corpus(400)
    a = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], LABELS)
    b = spark.createDataFrame([(i, 1, 1 - t if held(i) else t) for i, t in toxic.items()], LABELS)
    s = [sorted(map(tuple, toxicity.toxicity_report(docs(rows), x).collect())) for x in (a, b)]
    assert s[0] == s[1]


def test_driver_tables(spark):
    d, lab = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_report(d, lab).join(lab.where("toxic is not null"), "doc_id").collect()
    clean = [r.predicted for r in got if not r.toxic]
    bad = [r.predicted for r in got if r.toxic and r.held_out]
    assert np.mean(clean) < 0.03 and np.mean(bad) >= 0.5


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"Wörd{i % 700}, x{i}" for i in range(3000)).encode()
    want = toxicity.features([b"", text, b"a b"])
    blocks = toxicity.word_blocks
    monkeypatch.setattr(toxicity, "word_blocks", lambda d: blocks(d, 64))
    got = toxicity.features([b"", text, b"a b"])
    assert all(np.array_equal(x, y) for x, y in zip(got, want))


def test_no_positives_and_empty(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.toxicity_report(docs([(1, "a"), (2, None)]), none).collect()] == [0.0, 0.0]
    assert toxicity.toxicity_report(docs([]), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


def plain_fit(pos, unl, prior, steps):
    """Non-negative PU learning document by document: risk, turned gradient, Adam; feature -> weight, bias, risks seen."""
    import math
    sig = lambda z: 1 / (1 + math.exp(-z))
    n_p, n_u, keep = len(pos), len(unl), []
    for f in sorted({x for s in pos for x in s}):
        p, u = sum(f in s for s in pos), sum(f in s for s in unl) / n_u
        if p >= 3 and p / n_p - u > 4.0 * math.sqrt(u * (1 - u) / n_p + 1 / n_p ** 2):
            keep.append(f)
    names = [*keep, None]                       # None: the bias
    w = dict.fromkeys(names, 0.0) | {None: math.log(prior / (1 - prior))}
    m1, m2, signs = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0), []
    for t in range(1, steps + 1):
        z = lambda s: w[None] + sum(w[f] for f in s if f in w)
        negative = sum(math.log1p(math.exp(z(s))) for s in unl) / n_u - prior * sum(math.log1p(math.exp(z(s))) for s in pos) / n_p
        signs.append(negative >= 0)
        g = {f: 1e-5 * w[f] if f is not None else 0.0 for f in names}
        for docs, mine in ((pos, True), (unl, False)):
            for s in docs:
                y = sig(z(s))
                if negative >= 0:               # d/dz of prior * l(z) - prior * l(-z) on positives, l(-z) on unlabelled
                    d = -prior * (1 - y) / n_p - prior * y / n_p if mine else y / n_u
                else:
                    d = prior * y / n_p if mine else -y / n_u
                for f in [*[f for f in s if f in w], None]:
                    g[f] += d
        for f in names:
            m1[f], m2[f] = 0.9 * m1[f] + 0.1 * g[f], 0.999 * m2[f] + 0.001 * g[f] ** 2
            w[f] -= 0.05 * (m1[f] / (1 - 0.9 ** t)) / (math.sqrt(m2[f] / (1 - 0.999 ** t)) + 1e-8)
    return {f: w[f] for f in keep}, w[None], signs


def test_fit_equals_a_plain_loop(monkeypatch):
    """Both branches of the risk: a large prior drives the estimated negative risk below zero."""
    rng, seen = random.Random(4), set()
    pos = [{f for f in range(40) if rng.random() < (0.8 if f < 8 else 0.1)} for _ in range(60)]
    unl = [{f for f in range(40) if rng.random() < (0.8 if f < 8 and i % 5 == 0 else 0.1)} for i in range(90)]
    monkeypatch.setattr(toxicity, "EPOCHS", 60)
    for prior in (0.1, 0.5, 0.9):
        places, weights, bias = toxicity.fit([np.array(sorted(s), np.int32) for s in pos], [np.array(sorted(s), np.int32) for s in unl], prior)
        want, b, signs = plain_fit(pos, unl, prior, 60)
        seen |= set(signs)
        assert places.tolist() == sorted(want) and len(want) > 3
        assert max(abs(w - want[f]) for f, w in zip(places.tolist(), weights)) < 1e-7 and abs(bias - b) < 1e-7
    assert seen == {True, False}


def test_held_out_figures_at_a_tenth(spark):
    """sf0.1: most held-out toxic documents are caught, few clean ones flagged, and scores rank them."""
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = [r for r in toxicity.toxicity_report(d, lab).join(lab.where("toxic is not null"), "doc_id").collect() if r.held_out]
    bad, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert len(bad) > 50 and np.mean([r.predicted for r in bad]) >= 0.88 and np.mean([r.predicted for r in clean]) <= 0.04
    auc = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in bad for b in clean])
    assert auc >= 0.94


def test_places_are_selected_by_spark_as_fit_would(spark):
    """Counts per place over all sets; sets without places count as documents; no positives select none."""
    rng = random.Random(8)
    pos = [sorted(f for f in range(60) if rng.random() < (0.7 if f < 9 else 0.1)) for _ in range(50)] + [[], list(range(5000))]
    unl = [sorted(f for f in range(60) if rng.random() < 0.1) for _ in range(80)] + [[], []]
    schema = "role int, feats array<int>"
    sets = spark.createDataFrame([(1, s) for s in pos] + [(0, s) for s in unl], schema)
    places, _, _ = toxicity.fit([np.array(s, np.int32) for s in pos], [np.array(s, np.int32) for s in unl], 0.3)
    got = toxicity.selected(sets.repartition(5))
    assert got.tolist() == places.tolist() and 3 < len(got) < 60
    assert toxicity.selected(spark.createDataFrame([(0, [1, 2])], schema)).tolist() == []
    assert toxicity.selected(spark.createDataFrame([], schema)).tolist() == []
    few = [toxicity.selected(spark.createDataFrame([(1, [7])] * n, schema)).tolist() for n in (4, 5)]
    assert few == [[], [7]]                                 # four are within four standard errors of none


def test_the_fit_gets_selected_places_only(spark, docs, monkeypatch):
    """Whatever the length of a text, its set in the fitting task holds no other place."""
    rows, toxic = corpus(500)
    rows = [(i, t + " " + " ".join(f"own{i}x{j}" for j in range(300))) for i, t in rows]
    kept = []
    real = toxicity.selected
    monkeypatch.setattr(toxicity, "selected", lambda sets: kept.append((sets, real(sets))) or kept[-1][1])
    model = toxicity.train(docs(rows), spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], LABELS))
    (sets, places), = kept
    assert model.places.tolist() == places.tolist()
    assert sets.agg(F.max(F.size("feats"))).first()[0] > 300 > len(places) > 3
