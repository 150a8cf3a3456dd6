import hashlib
import random
import re
import zlib

import numpy as np

from tessera.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """Every stretch with every period, tried one by one."""
    n, got = len(w), {}
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and w[e] == w[e - q]:
                e += 1
            if e - s >= max(least, 2 * q) and (s, e) not in got:
                got[s, e] = q
            s = max(e - q + 1, s + 1)
    return sorted((s, e - s, q) for (s, e), q in got.items())


def planted(doc_id, w):
    if doc_id is None or not w or zlib.crc32(str(doc_id).encode()) % 10:
        return w
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def brute_row(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def found(words, least=12):
    """find_runs over several texts at once, per text."""
    ids = {}
    flat = np.array([ids.setdefault((i, x), len(ids)) for i, w in enumerate(words) for x in w], np.int64)
    text = np.repeat(np.arange(len(words)), [len(w) for w in words])
    base = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    out = [[] for _ in words]
    for s, n, q in zip(*(x.tolist() for x in periodic.find_runs(flat, text, least))):
        out[text[s]].append((s - int(base[text[s]]), n, q))
    return out


def words_of_many_shapes(rng):
    yield []
    yield ["a"]
    for letters in ("a", "ab", "abc", "abcdefgh"):
        for n in (2, 11, 12, 13, 24, 40, 90, 200):
            yield [rng.choice(letters) for _ in range(n)]
    for _ in range(150):                                   # repeats of repeats, cut at odd places
        w = []
        while len(w) < rng.choice([20, 60, 150, 300]):
            root = [rng.choice("aab") for _ in range(rng.randint(1, 9))]
            root = (root * rng.randint(1, 4))[:rng.randint(1, 40)]
            w += (root * rng.randint(1, 6))[:rng.randint(1, 120)]
        yield w
    yield list("cbaabaabaaaabaabaab")                       # period 8, its root of period 3 on both sides
    yield list("baabaabaaaabaabaab" * 3)
    yield (["a"] * 64 + ["b"]) * 5
    f = ["a", "ab"]
    while len(f[-1]) < 500:
        f.append(f[-1] + f[-2])
    yield list(f[-1])                                       # Fibonacci words hold the most runs


def test_runs_equal_brute_force():
    words = list(words_of_many_shapes(random.Random(5)))
    for least in (12, 2):
        assert found(words, least) == [brute_runs(w, least) for w in words]


def test_proposals_stay_in_proportion(monkeypatch):
    counted = []
    real = periodic._pairs
    monkeypatch.setattr(periodic, "_pairs", lambda *a: counted.append(len((r := real(*a))[0])) or r)
    for w in (["a"] * 20_000, (["a"] * 99 + ["b"]) * 200, list("ab" * 10_000), (["a"] * 4096 + ["b"]) * 5):
        counted.clear()
        assert found([w])[0]
        assert sum(counted) <= 4 * len(w) * len(counted)
    assert found([["a"] * 20_000]) == [[(0, 20_000, 1)]]


def rows():
    rng = random.Random(3)
    texts = [" ".join(w) for w in words_of_many_shapes(rng)]
    prose = [" ".join(rng.choice(["eins", "zwei", "drei", "vier", "fünf", "日本"]) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    odd = [None, "", " \t\n ", "\x85 a\x85b\x1c", "a\x0bb\x0cc " * 10, "x " * 30_000, "lone", "b b b b b b b b b b b", "c " * 12]
    out = list(enumerate(texts + prose + odd))
    return out + [(5, texts[20]), (5, texts[20]), (None, "a " * 40), (None, None)]


def test_report_equals_brute_force(spark, docs):
    got = periodic.run_report(docs(rows()).withColumnRenamed("lang", "runs")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[6], r[7])
    assert sorted((tuple(r) for r in got), key=key) == sorted((brute_row(*r) for r in rows()), key=key)


def test_operator_gives_runs_and_texts(spark, docs):
    got = periodic.periodic_runs(docs([(1, "x " + "a b " * 6 + "y")])).collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [(14, [(1, 12, 2)], "x a b y")]


def test_empty_table(spark, docs):
    assert periodic.run_report(docs([])).count() == 0
