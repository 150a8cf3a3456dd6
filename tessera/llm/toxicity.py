"""Operator 6: toxicity by non-negative positive-unlabelled learning in numpy.

Positives are documents confirmed toxic by ``labels``; everything else in the
training folds is unlabelled, whatever its label says.  With the class prior p
(the toxic share of the training labels, or given) the risk of a linear
classifier is

    p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive)),

and when the second part falls below zero its gradient is turned (Kiryo et al.
2017), so the unlabelled toxic documents are not learned as clean ones.

Features are the distinct words of the whole text (A-Z lower-cased, outer
punctuation stripped) and their first 4, 5 and 6 bytes, hashed to 2**20 places;
only those clearly more frequent among the positives (``Z_LEAST`` standard
errors) enter the model: a Spark aggregate over the sample's (role, place) pairs
selects them.  The fit runs in one task on a bounded sample (``POSITIVES`` and
``UNLABELLED`` documents, by hash), of which it gets only the selected places, however
long the texts are; scoring reads every text, in Arrow batches, with the model's
few thousand weights.

Labels are learned only from documents whose crc32(doc_id as text) mod 5 is not
0; labels, lang, source and doc_id are never inputs of a score.  Defined cases:
null and empty texts have no features and get the score of the bias; a null
doc_id is never trained on and not held out; null or repeated labels: any toxic 1
confirms.  No positives: every score is 0.  Empty documents: no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import fresh, materialize, text_groups, word_blocks

FOLDS, HELD_OUT = 5, 0
POSITIVES, UNLABELLED = 4000, 8000
DIMS = 1 << 20
PREFIXES = (4, 5, 6)
STRIP = ".,;:!?\"'()[]"
Z_LEAST, LEAST_POSITIVES = 4.0, 3
EPOCHS, RATE, L2 = 100, 0.05, 1e-5


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def _word_places(words: list[str], live: np.ndarray | None) -> np.ndarray:
    """Feature places of each word, -1 where there is none (or none that is live)."""
    out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int64)
    for i, w in enumerate(words):
        if w:
            b = w.encode()
            out[i, 0] = zlib.crc32(b)
            for j, n in enumerate(PREFIXES):
                if len(b) > n:
                    out[i, j + 1] = zlib.crc32(b[:n], n)
    out = np.where(out >= 0, out & (DIMS - 1), -1)
    return out if live is None else np.where((out >= 0) & live[out], out, -1)


def _block_features(blocks: list[tuple[int, bytes]], live: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([b for _, b in blocks], pa.binary()).cast(pa.string())))
    coded = split.flatten().dictionary_encode()
    places = _word_places(pc.utf8_trim(coded.dictionary, characters=STRIP).to_pylist(), live)
    doc = np.repeat(np.array([i for i, _ in blocks], np.int64), np.diff(split.offsets.to_numpy()))
    at = coded.indices.to_numpy()
    if live is not None:  # most words carry no weight
        some = (places >= 0).any(axis=1)[at]
        doc, at = doc[some], at[some]
    f = places[at]
    use = f >= 0
    pairs = np.unique(np.repeat(doc, f.shape[1])[use.ravel()] * DIMS + f[use])
    return pairs // DIMS, pairs % DIMS


def features(texts: list[bytes], live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs of whole texts, about 2 MB of text at a time."""
    docs, feats, held, n = [], [], [], 0

    def flush():
        nonlocal held, n
        if held:
            d, f = _block_features(held, live)
            docs.append(d), feats.append(f)
        held, n = [], 0
    for i, t in enumerate(texts):
        for block in word_blocks(t):
            held.append((i, block))
            n += len(block)
            if n > 1 << 21:
                flush()
    flush()
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate(docs) * DIMS + np.concatenate(feats))
    return pairs // DIMS, pairs % DIMS


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _clear(positives, unlabelled_share, n_p: int, sqrt):
    """Whether a place is clearly more frequent among the positives: numpy arrays or Spark columns."""
    err = sqrt(unlabelled_share * (1 - unlabelled_share) / n_p + 1 / n_p ** 2)
    return (positives >= LEAST_POSITIVES) & (positives / n_p - unlabelled_share > Z_LEAST * err)


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature sets of positives and unlabelled -> (features, weights, bias) by non-negative PU learning."""
    n_p, n_u = len(pos), len(unl)
    df_p = np.bincount(np.concatenate(pos), minlength=DIMS)
    df_u = np.bincount(np.concatenate(unl or [np.empty(0, int)]), minlength=DIMS) / max(n_u, 1)
    keep = np.flatnonzero(_clear(df_p, df_u, n_p, np.sqrt))
    place = np.full(DIMS, -1)
    place[keep] = np.arange(len(keep))

    def rows(sets):
        inside = [place[x] for x in sets]
        inside = [x[x >= 0] for x in inside]
        return np.repeat(np.arange(len(sets)), [len(x) for x in inside]), np.concatenate(inside or [np.empty(0, int)])
    (rp, ip), (ru, iu) = rows(pos), rows(unl)
    m = len(keep)
    w, first, second = np.zeros(m + 1), np.zeros(m + 1), np.zeros(m + 1)
    w[m] = np.log(prior / (1 - prior))
    for step in range(1, EPOCHS + 1):
        z_p, z_u = w[m] + np.bincount(rp, w[ip], n_p), w[m] + np.bincount(ru, w[iu], n_u)
        s_p, s_u = _sigmoid(z_p), _sigmoid(z_u)
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if negative >= 0:
            g_p, g_u = (-prior * (1 - s_p) - prior * s_p) / n_p, s_u / n_u
        else:
            g_p, g_u = prior * s_p / n_p, -s_u / n_u
        g = np.append(np.bincount(ip, g_p[rp], m) + np.bincount(iu, g_u[ru], m) + L2 * w[:m], g_p.sum() + g_u.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return keep, w[:m], float(w[m])


def _sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[DataFrame, float] | None:
    """(role, feats) of the training sample, as a table of the shared folder, and the class prior."""
    train = F.col("doc_id").isNotNull() & (fold() != HELD_OUT)
    share = lambda want, have: int(min(1.0, 1.5 * want / max(have, 1)) * 2 ** 32)
    hashed = lambda *c: F.pmod(F.xxhash64(F.lit("pu"), *c), F.lit(2 ** 32))
    known = (labels.select("doc_id", "toxic").where(train & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    n, n_pos = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_pos:
        return None
    ids = docs.select("rid", "doc_id").where(train)
    n_train = ids.count()
    pos = (known.where("toxic = 1").where(hashed("doc_id") < share(positives, n_pos)).join(ids, "doc_id")
           .orderBy(hashed("doc_id", "rid")).limit(positives).select("rid", F.lit(1).alias("role")))
    unl = (ids.where(hashed("doc_id", "rid") < share(unlabelled, n_train))
           .orderBy(hashed("doc_id", "rid")).limit(unlabelled).select("rid", F.lit(0).alias("role")))
    chosen = materialize(pos.unionByName(unl), "pu-sample")

    def digest(batches):
        for b in batches:
            for at, texts in text_groups(b.column(1)):
                d, f = features(texts)
                cuts = np.searchsorted(d, np.arange(len(texts) + 1)).astype(np.int32)
                feats = pa.ListArray.from_arrays(pa.array(cuts), pa.array(f.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)).cast(pa.int32()), feats], ["role", "feats"])
    # at most positives + unlabelled rows of two numbers: bounded by parameters
    rows = docs.join(F.broadcast(chosen), "rid").select("role", "text").mapInArrow(digest, "role int, feats array<int>")
    return materialize(rows, "pu-sets"), min(max(n_pos / n, 1e-3), 0.99)


def selected(sets: DataFrame) -> np.ndarray:
    """The places of sets(role, feats) that enter the model, counted by Spark; at most DIMS numbers come back."""
    n_p, n_u = sets.agg(F.count_if(F.col("role") == 1), F.count_if(F.col("role") == 0)).first()
    if not n_p:
        return np.empty(0, np.int64)
    counts = sets.select("role", F.explode("feats").alias("place")).groupBy("place").agg(
        F.sum("role").alias("p"), F.sum(1 - F.col("role")).alias("u"))
    clear = counts.where(_clear(F.col("p"), F.col("u") / max(n_u, 1), n_p, F.sqrt)).select("place").collect()
    return np.sort(np.array([r.place for r in clear], np.int64))


class Model:
    """Weights by feature place; picklable, a few thousand numbers."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bias: float):
        self.places, self.weights, self.bias = places, weights, bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.bias == -np.inf:
            return np.zeros(len(texts))
        dense = self.__dict__.get("dense")
        if dense is None:
            dense = np.zeros(DIMS)
            dense[self.places] = self.weights
            self.dense, self.live = dense, np.zeros(DIMS, bool)
            self.live[self.places] = True
        d, f = features(texts, self.live)
        return _sigmoid(self.bias + np.bincount(d, dense[f], len(texts)))

    def __getstate__(self):
        return {"places": self.places, "weights": self.weights, "bias": self.bias}


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          prior: float | None = None) -> Model:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic)."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    got = _sample(numbered, labels, positives, unlabelled)
    if got is None:
        return Model(np.empty(0, int), np.empty(0), -np.inf)
    sets, share = got
    share = prior or share
    live = np.zeros(DIMS, bool)
    live[selected(sets)] = True

    def thin(batches):
        for b in batches:
            lists = b.column(1)
            f, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            use = live[f]
            after = np.concatenate([[0], np.cumsum(use)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(after), pa.array(f[use]))], ["role", "feats"])

    def one(t):
        role, sets = t["role"].to_numpy(), [np.array(x, np.int32) for x in t["feats"].to_pylist()]
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i].tobytes()))  # whatever the order of arrival
        pos, unl = ([sets[i] for i in order if role[i] == r] for r in (1, 0))
        if not pos:
            return pa.table({"f": pa.array([-1], pa.int32()), "w": [float("-inf")]})
        f, w, b = fit(pos, unl or [np.empty(0, np.int32)], share)
        return pa.table({"f": pa.array(np.append(f, -1), pa.int32()), "w": pa.array(np.append(w, b))})
    sample = sets.mapInArrow(thin, "role int, feats array<int>")
    rows = sample.groupBy(F.lit(0).alias("k")).applyInArrow(one, "f int, w double").collect()  # the weights, at most DIMS
    bias = next((r.w for r in rows if r.f < 0), -np.inf)
    return Model(np.array([r.f for r in rows if r.f >= 0], int), np.array([r.w for r in rows if r.f >= 0]), bias)


def score_column(model: Model, text: Column) -> Column:
    """Toxicity score (0 to 1) of a whole text."""
    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        got = [model.scores(g) for _, g in text_groups(texts)]
        return pa.array(np.concatenate(got or [np.empty(0)]))
    return run(text)


def toxicity_report(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, **kw)
    return docs.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
                       score_column(model, F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The documents whose score is below one half, with all their columns."""
    score = fresh(docs, "score")
    model = train(docs, labels, **kw)
    return docs.withColumn(score, score_column(model, F.col("text"))).where(F.col(score) < 0.5).drop(score)
