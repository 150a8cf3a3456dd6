import math
import random

import pytest

from tessera.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10, every=100):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]
    vecs = [(i, ints(v)) for i, v in rows]
    out = []
    for qi, q in vecs:
        if q is None or qi is None or qi % every:
            continue
        got = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0) for i, v in vecs if v is not None and i != qi)
        out += [(qi, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(got[:k])]
    return sorted(out, key=repr)


def sample(n=700, d=16, seed=1):
    import numpy as np
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(d)]) for i in range(n)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(30)]                       # ties
    rows += [(2000, None), (2001, [0.5, None]), (2100, [float("nan")] * d), (2101, [float("inf")] * d),
             (2200, [0.25, 0.5]), (2201, []), (2300, []), (3, list(rows[3][1])), (None, list(rows[0][1])), (-100, [-0.5] * d),
             (100, list(rows[5][1]))]
    return rows


def got(df, **kw):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.topk_every(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"row_block": 37, "query_block": 2}, {"slices": 4}, {"slices": 1, "row_block": 100}])
def test_equals_brute_force(spark, kw):
    rows = sample()
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert got(df, **kw) == brute(rows)


def test_few_rows_large_components_and_empty(spark):
    rows = [(0, [1e6, -2e6]), (1, [3e6, 1e5]), (2, [5.0, 7.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    assert got(df) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)) == []
    assert got(spark.createDataFrame([(100, [1.0], 0)], SCHEMA)) == []


def test_negative_scores_only(spark):
    rows = [(0, [1.0] * 4)] + [(i, [-0.01 * i] * 4) for i in range(1, 50)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    import numpy as np
    assert got(df) == brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows])


def test_wide_vectors_make_small_blocks_and_names_may_clash(spark, monkeypatch):
    """1,024 components: a block holds BLOCK_BYTES of them, of queries too; extra columns of the operator's own names."""
    import numpy as np
    from pyspark.sql import functions as F
    rng = random.Random(7)
    rows = [(i * 50, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(1024)]) for i in range(60)]
    monkeypatch.setattr(topk, "BLOCK_BYTES", 5 * 8 * 1024)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    blocks = topk._blocks(df.select("vec_id", "embedding"), 2048).select((F.octet_length("ids") / 8).cast("int").alias("n"), F.octet_length("vecs").alias("b")).collect()
    assert sum(r.n for r in blocks) == 60 and max(r.n for r in blocks) == 5 and max(r.b for r in blocks) <= topk.BLOCK_BYTES
    clash = df.withColumns({"QB": F.lit(1), "g": F.lit("x"), "ids": F.lit(0), "rank": F.lit(2), "score": F.lit(3)})
    assert got(clash) == got(df) == brute(rows)
