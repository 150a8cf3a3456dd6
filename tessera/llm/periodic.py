"""Operator 11: runs of periodically repeated words, by a dictionary of basic factors.

A run is a stretch of consecutive words of one text with smallest period q, at least
max(``MIN_LENGTH``, 2 q) words long, that no neighbouring word extends with period q.

Texts of a batch are numbered word by word (equal numbers: equal words of the same
text) and worked on together.

1. Names: the factor of 1, 2, 4, ... words at each place gets a number, equal for
   equal factors of a text; two names of one length make a name of twice the length.
   A factor that stands once in its text has no name, and nothing longer at its place either.
2. Proposals: a run of period q, with L the largest power of two up to q, starts with a
   factor of L words that stands again q words on, L <= q < 2 L.  The occurrences of a
   factor within twice its length are arithmetic progressions, and all but the first
   members of one have the same word before them.  A run starts where the word before
   differs from the word q further on, so of a progression only its first member makes pairs
   with the other members: proposals stay in proportion to the words, however often a word repeats.
3. Extension: the longest common continuation of both places by falling powers of two
   over the names; it must reach q more words, as the stretch is to hold two periods.
4. Of proposals for one stretch the smallest period stays: the others are its multiples.

Each text is worked on whole, in the task that read it; nothing is shuffled.  Memory is
some 4 bytes per word and power of two, for a batch of ``BATCH_WORDS`` words or one longer text.

Defined cases: null, empty and blank texts have no words and no run.  Repeated rows and null
ids give a row each.  Ties for the longest run: smallest start, then period.  Empty table: no
rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import give_back, text_groups

MIN_LENGTH = 12
BATCH_WORDS = 1 << 18
BATCH_BYTES = 2 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes."""
    space = np.concatenate([[True], _IS_SPACE[data], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def _renumber(keys: np.ndarray) -> np.ndarray:
    """0, 1, ... for keys that occur more than once, -1 for the others."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = count > 1
    return np.where(again, np.cumsum(again) - 1, -1)[inverse].astype(np.int32)


def factor_names(words: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: number of the factor of 2^k words at i, -1 if it stands once in its text.

    ``words``: a number per word, different in different texts; ``text``: the text of each word.
    """
    n, names = len(words), [_renumber(words)]
    while True:
        k, prev = 1 << (len(names) - 1), names[-1]
        live = np.flatnonzero(prev[:max(n - k, 0)] >= 0)
        live = live[(prev[live + k] >= 0) & (text[live] == text[live + k])]
        if not len(live):
            return names
        name = np.full(n, -1, np.int32)
        name[live] = _renumber(prev[live].astype(np.int64) << 32 | prev[live + k])
        if name.max() < 0:
            return names
        names.append(name)


def _pairs(name: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of one factor, length <= j - i < 2 length, with different words before them.

    Places of a factor in order fall into classes of neighbours with one word before; a place
    is paired class by class, so a progression's long class is passed over in one step.
    """
    at = np.flatnonzero(name >= 0)
    at = at[np.argsort(name[at], kind="stable")]
    nm, left, m = name[at], before[at], len(at)
    same = np.concatenate([nm[1:] == nm[:-1], [False]])
    near = same & (np.concatenate([at[1:], [0]]) - at < 2 * length)      # has a next one within reach
    head = np.concatenate([[True], (nm[1:] != nm[:-1]) | (left[1:] != left[:-1])])
    group = np.cumsum(head) - 1                                          # class of each place
    first = np.append(np.flatnonzero(head), m)                           # first place of each class
    out_i, out_j = [], []
    # window of each place as a range of the order: [lo, hi)
    key = nm.astype(np.int64) << 32 | at
    i = np.flatnonzero(near)
    lo = np.searchsorted(key, key[i] + length)
    hi = np.searchsorted(key, key[i] + 2 * length)
    i, lo, hi = (x[hi > lo] for x in (i, lo, hi))
    while len(i):
        c = group[lo]
        end = np.minimum(first[c + 1], hi)
        use = left[lo] != left[i]
        n = (end - lo)[use]
        after = np.cumsum(n)
        out_i.append(np.repeat(i[use], n))
        out_j.append(np.repeat(lo[use] - (after - n), n) + np.arange(after[-1] if len(after) else 0))
        more = end < hi
        i, lo, hi = i[more], end[more], hi[more]
    if not out_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return at[np.concatenate(out_i)], at[np.concatenate(out_j)]


def _common(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal words from i and j on (within their text)."""
    n, i, start = len(names[0]), i.copy(), i
    j = j.copy()
    for k in range(len(names) - 1, -1, -1):
        # a factor twice as long would have been taken already, so one step per power does
        a, b = names[k][np.minimum(i, n - 1)], names[k][np.minimum(j, n - 1)]
        step = ((a == b) & (a >= 0) & (j < n)) * (1 << k)
        i += step
        j += step
    return i - start


def find_runs(words: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; starts are places in ``words``."""
    none = np.empty(0, np.int64)
    if not len(words):
        return none, none, none
    names = factor_names(words, text)
    first = np.concatenate([[True], text[1:] != text[:-1]])
    before = np.concatenate([[0], words[:-1].astype(np.int64)])
    before[first] = -1                                      # nothing before a text's first word: unlike any word
    found = []
    for k, name in enumerate(names):
        i, j = _pairs(name, before, 1 << k)
        q = j - i
        length = q + _common(names, i, j)
        ok = length >= np.maximum(min_length, 2 * q)
        found.append(np.stack([i[ok], length[ok], q[ok]]))
    start, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])   # the smallest period of a stretch
    start, length, q = start[keep], length[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


Arrange = Callable[[object, int], "np.ndarray | None"]

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _work(ids: list, texts: list[bytes], arrange: Arrange | None, min_length: int) -> pa.RecordBatch:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begin, end = split_words(data)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begin, bounds)
    counts = np.diff(upto, prepend=0)
    sizes = end - begin
    solid = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                                            pa.py_buffer(data[~_IS_SPACE[data]])]).dictionary_encode()
    codes, dictionary = solid.indices.to_numpy().astype(np.int64), solid.dictionary.to_pylist()
    if arrange is not None:
        codes = codes.copy()
        for doc, n, last in zip(ids, counts.tolist(), upto.tolist()):
            order = arrange(doc, n)
            if order is not None:
                codes[last - n:last] = codes[last - n:last][order]
    text = np.repeat(np.arange(len(texts)), counts)
    start, length, q = find_runs(text * (len(dictionary) + 1) + codes, text, min_length)
    of = text[start] if len(start) else start
    # words of a run behind its first period go
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, start + q, 1)
    np.add.at(gone, start + length, -1)
    kept = np.cumsum(gone[:-1]) == 0
    first = upto - counts
    values = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(q)], ["start", "length", "period"])
    offsets = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32))
    collapsed = [b" ".join(map(dictionary.__getitem__, codes[a:b][kept[a:b]].tolist())) for a, b in zip(first, upto)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(counts), pa.ListArray.from_arrays(offsets, values),
         pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def _runs(arrange: Arrange | None, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_groups(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                a, n = 0, 0
                for b, t in enumerate(texts):
                    if n and n + len(t) > BATCH_BYTES:
                        yield _work(ids[a:b], texts[a:b], arrange, min_length)
                        a, n = b, 0
                    n += len(t) + 1
                if n:
                    yield _work(ids[a:], texts[a:], arrange, min_length)
        give_back()
    return run


def periodic_runs(docs: DataFrame, arrange: Arrange | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period)
    and collapsed (the words outside the later periods of any run, joined by one space).

    ``arrange(doc_id, n)`` may put the n words of a document in another order (an array of n word
    numbers, repeats allowed) before runs are sought.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_runs(arrange, min_length), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted_order(doc_id, n: int):
    """Every tenth document by CRC-32 of its id gets a repeated tail; a null id gets none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def run_report(docs: DataFrame) -> DataFrame:
    """Digests of ``periodic_runs`` with the planted tails, and the longest run of each document."""
    found = periodic_runs(docs, planted_order)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                            r["period"].cast("string")), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
                        (-F.col("_best.period")).alias("period"),
                        F.expr("(1000 * _best.length) div -_best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
