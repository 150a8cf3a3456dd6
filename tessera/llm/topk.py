"""Operator 4: exact top-k inner products by the three-phase uniform threshold.

The query rows meet all rows in blocks.  Rows are packed to blocks of
``ROW_BLOCK`` vectors, queries to blocks of ``QUERY_BLOCK``; a cell is a query block
with a group of row blocks, and a task holds one query block and one row block at
a time.  Each vector is cut into ``SLICES`` parts; a part's inner products are one
local score list.

1. Gather: each cell sends, per query and slice, the ``k`` rows with the largest
   local score, with their full scores.  The k-th best full score of a query is
   at most its true k-th best: a safe cutoff.
2. The cutoff goes with the queries to all cells.  A row whose full score
   reaches the cutoff has a slice with at least cutoff / SLICES, so only entries
   with such a local score are collected.
3. Only their remaining scores are resolved, exactly; those that reach the cutoff
   compete for the ``k`` places, ties to the smaller vec_id.

Cutoffs differ by query and come from all rows; nothing is sampled or capped: a
cell sends at most ``k`` rows a query and slice, the most that can place.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; a shorter vector counts as padded with zeros; an empty vector
scores 0 with every other.  Products are exact (float64 where every sum stays below
2**53, else 64-bit integers, else an error).  A query row listed twice asks
twice and its answers stand twice; a repeated candidate row can take two places;
a row with the query's own vec_id is never its candidate.  A null vec_id is a
candidate only, ranked after the other ids among equals.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, partitions

K = 10
SCALE = 1024.0
SLICES = 2
ROW_BLOCK = 2048
QUERY_BLOCK = 4096
CELL_BLOCKS = 64
BLOCK_BYTES = 1 << 20   # of a block's vectors as 64-bit integers
TILE = 512
NO_ID = np.iinfo(np.int64).max


def _quantised(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows that take part, their vectors as int64 padded to the widest, width)."""
    values = lists.to_pylist()
    ok, rows = [], []
    for i, v in enumerate(values):
        if v is None or None in v:
            continue
        x = np.floor(np.asarray(v, np.float64) * SCALE)
        if np.isfinite(x).all():
            if len(x) and np.abs(x).max() >= 2.0 ** 62:
                raise ValueError("a component is beyond 64-bit integers")
            ok.append(i)
            rows.append(x.astype(np.int64))
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return np.array(ok, int), out, width


def _pack(block: int):
    """(vec_id, embedding) rows -> blocks of ids and vectors, each at most ``block`` rows of one width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ok, vecs, width = _quantised(part.column(1))
                ids = pc.fill_null(part.column(0), pa.scalar(NO_ID, pa.int64())).to_numpy()[ok].astype(np.int64)
                rows = max(1, BLOCK_BYTES // (8 * max(1, width)))       # wide vectors: fewer to a block
                for i in range(0, len(ok), rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[i:i + rows].tobytes()], pa.binary()), pa.array([vecs[i:i + rows].tobytes()], pa.binary()),
                         pa.array([width], pa.int32())], ["ids", "vecs", "width"])
    return run


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vecs"], np.int64).reshape(len(ids), row["width"])


def _fit(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _product(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact integer products q @ r.T."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0 ** 53:
        return q.astype(np.float64) @ r.astype(np.float64).T
    if most >= 2.0 ** 63:
        raise ValueError("a score is beyond 64-bit integers")
    return q @ r.T


def _slices(width: int, parts: int) -> list[slice]:
    cuts = [width * i // parts for i in range(parts + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


class _Best:
    """The k best (score, id) pairs per query, kept in arrays; ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.held, self.q, self.s, self.i = k, 0, [], [], []
        self.n = n

    def add(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        self.q.append(q), self.s.append(s), self.i.append(i)
        self.held += len(q)
        if self.held > 4 * self.n * self.k + 200_000:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, s, i = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (self.q, self.s, self.i))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, "left")
        keep = np.arange(len(q)) - first < self.k
        self.q, self.s, self.i, self.held = [q[keep]], [s[keep]], [i[keep]], int(keep.sum())
        return self.q[0], self.s[0], self.i[0]


def _tiles(queries: dict, rows: pa.Table, slices: int):
    """Per tile: query numbers, query ids, row ids, vectors and the local score lists (one matrix per slice)."""
    q_ids, q = _unpack(queries)
    for n in range(rows.num_rows):                # one block at a time as an array; the others stay Arrow bytes
        r_ids, r = _unpack(rows.slice(n, 1).to_pylist()[0])
        width = max(q.shape[1], r.shape[1])
        qq, rr = _fit(q, width), _fit(r, width)
        for at in range(0, len(qq), TILE):
            part = qq[at:at + TILE]
            yield (np.arange(at, at + len(part)), q_ids[at:at + TILE], r_ids, part, rr,
                   [_product(part[:, s], rr[:, s]) for s in _slices(width, slices)])


def _gather(k: int, slices: int):
    """Phase 1: the k largest local scores per query and slice, with their full scores."""
    def run(key, left, right):
        queries = left.to_pylist()[0] if left.num_rows else None
        best = _Best(len(queries["ids"]) // 8 if queries else 0, k)
        for numbers, q_ids, r_ids, _, _, lists in _tiles(queries, right, slices) if queries else ():
            full = sum(lists)
            own = q_ids[:, None] == r_ids[None, :]
            picks = []
            for local in lists:
                local = np.where(own, -np.inf, local) if own.any() else local
                n = min(k, local.shape[1])
                picks.append(np.argpartition(-local, n - 1, axis=1)[:, :n])
            col = np.sort(np.concatenate(picks, axis=1), axis=1)
            new = np.concatenate([np.ones((len(col), 1), bool), np.diff(col, axis=1) > 0], axis=1)
            i, j = np.nonzero(new)
            j = col[i, j]
            use = ~own[i, j]
            i, j = i[use], j[use]
            best.add(numbers[i], full[i, j].astype(np.int64), r_ids[j])
        q, s, _ = best.cut()
        block = key[0].as_py()
        return pa.table({"qb": pa.array([block] * len(q), pa.int32()), "q": pa.array(q, pa.int32()), "score": pa.array(s, pa.int64())})
    return run


def _resolve(k: int, slices: int):
    """Phases 2 and 3: entries with a local score of at least cutoff / slices, resolved exactly."""
    def run(key, left, right):
        queries = left.to_pylist()[0] if left.num_rows else None
        best = _Best(len(queries["ids"]) // 8 if queries else 0, k)
        q_all = np.frombuffer(queries["ids"], np.int64) if queries else np.empty(0, np.int64)
        cutoff = np.frombuffer(queries["cutoffs"], np.int64) if queries else None
        for numbers, q_ids, r_ids, qv, rv, lists in _tiles(queries, right, slices) if queries else ():
            cut = cutoff[numbers]
            least = np.where(cut == np.iinfo(np.int64).min, -np.inf, cut / slices)
            least = least - np.abs(least) * 1e-12  # division may round up
            hit = lists[0] >= least[:, None]
            for local in lists[1:]:
                hit |= local >= least[:, None]
            i, j = np.nonzero(hit & (q_ids[:, None] != r_ids[None, :]))
            score = sum(local[i, j] for local in lists).astype(np.int64)  # the remaining lists, looked up
            use = score >= cut[i]
            best.add(numbers[i[use]], score[use], r_ids[j[use]])
        q, s, i = best.cut()
        return pa.table({"qb": pa.array([key[0].as_py()] * len(q), pa.int32()), "q": pa.array(q, pa.int32()),
                         "query_id": pa.array(q_all[q], pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})
    return run


def _blocks(df: DataFrame, block: int) -> DataFrame:
    return df.mapInArrow(_pack(block), "ids binary, vecs binary, width int")


def topk(vectors: DataFrame, queries: DataFrame, k: int = K, slices: int = SLICES, row_block: int = ROW_BLOCK,
         query_block: int = QUERY_BLOCK) -> DataFrame:
    """vectors, queries (vec_id, embedding) -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    pick = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    asked = materialize(pick(queries), "queries")
    n_q = asked.count()
    packed_q = materialize(_blocks(asked.repartition(max(1, -(-n_q // query_block))), query_block), "query-blocks")
    packed_q = materialize(packed_q.withColumn("qb", F.monotonically_increasing_id()), "query-blocks")
    n_blocks = packed_q.count()
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # blocks numbered 0.. by their partition's count of blocks and their place in it
    part = F.shiftright("qb", 33)
    counts = packed_q.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))      # a row per partition of query blocks
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("qb")) - 1
    numbered = (packed_q.select("qb", part.alias("part")).withColumn("place", place).join(begin, "part")
                .select("qb", (F.col("begin") + F.col("place")).cast("int").alias("nr")))
    packed_q = materialize(packed_q.join(numbered, "qb").select(F.col("nr").alias("qb"), "ids", "vecs", "width"), "query-blocks")
    packed_r = materialize(_blocks(pick(vectors), row_block).withColumn("rb", F.monotonically_increasing_id()), "row-blocks")
    n_r = packed_r.count()
    groups = max(1, min(n_r, max(-(-n_r // CELL_BLOCKS), -(-2 * partitions(spark) // n_blocks))))
    cells_r = (packed_r.withColumn("g", F.pmod(F.xxhash64("rb"), F.lit(groups)).cast("int"))
               .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).drop("rb"))

    def meet(q: DataFrame, step, schema: str) -> DataFrame:
        q = q.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return (q.groupBy("qb", "g").cogroup(cells_r.groupBy("qb", "g"))).applyInArrow(step, schema)

    first = meet(packed_q, _gather(k, slices), "qb int, q int, score long")
    place = F.row_number().over(Window.partitionBy("qb", "q").orderBy(F.desc("score")))
    cut = (first.withColumn("place", place).where(F.col("place") == k).select("qb", "q", "score"))
    sizes = packed_q.select("qb", (F.octet_length("ids") / 8).cast("int").alias("n"))

    def attach(key, left, right):
        cutoffs = np.full(left["n"][0].as_py() if left.num_rows else 0, np.iinfo(np.int64).min, np.int64)
        if len(cutoffs) and right.num_rows:
            cutoffs[right["q"].to_numpy()] = right["score"].to_numpy()
        return pa.table({"qb": pa.array([key[0].as_py()], pa.int32()), "cutoffs": pa.array([cutoffs.tobytes()], pa.binary())})

    cutoffs = materialize(sizes.groupBy("qb").cogroup(cut.groupBy("qb")).applyInArrow(attach, "qb int, cutoffs binary"), "cutoffs")
    found = meet(packed_q.join(cutoffs, "qb"), _resolve(k, slices),
                 "qb int, q int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("qb", "q").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"), "score"))


def topk_every(vectors: DataFrame, every: int = 100, k: int = K, **kw) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``."""
    return topk(vectors, vectors.where(F.col("vec_id") % every == 0), k, **kw)
