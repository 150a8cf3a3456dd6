"""Operator 1: SimHash near-dedup by tiled exact comparison.

1. Every text gives one 64-bit fingerprint (XXH64 of its word shingles, bit
   majority), computed over the whole text in Arrow batches.
2. Distinct fingerprints are dealt to tiles by population count; a count with
   more than ``tile`` fingerprints gets several tiles.  Copies of a text share
   a fingerprint, so a hot group of copies is one entry of one tile.
3. Two tiles meet only if their population counts differ by no more than the
   radius (one bit flip moves the count by one, so nothing is lost).  A meeting
   is numpy XOR and bit counts in blocks; blocks are ordered by the population
   counts of the four 16-bit quarters and skipped by the same bound.
4. A meeting returns a spanning forest of its links (at most one row per
   fingerprint), never all pairs; forests are joined by ``components``.

The comparison is exact and its work grows with the square of the number of
distinct fingerprints, as the method has it; traffic is one tile pair
(1 MB) per ``tile**2`` comparisons.

Defined cases: null and empty texts have no words and the fingerprint zero,
which links like any other.  Fewer words than a shingle: the whole sequence is
the one shingle.  Repeated rows each get a row.  A null doc_id counts as larger
than all others: it is a component id only if its component has no other.
Extra columns pass through ``near_dedup`` unchanged.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.components import components
from tessera.llm.shared import fresh, materialize, partitions, text_groups, word_blocks

SHINGLE, RADIUS = 4, 4
TILE = 1 << 16
BLOCK = 512
MEETINGS = 4   # tile pairs a task compares, on average


def _bit_counts(h: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total, full = np.zeros(64, np.int64), len(bits) // 255 * 255
    if full:  # 255 ones still fit a byte
        total += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total + bits[full:].sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of one text given as UTF-8."""
    carry: list[bytes] = []
    ones, n = np.zeros(64, np.int64), 0
    for block in word_blocks((data or b"").lower()):  # bytes.lower() maps A-Z only
        words = carry + block.split()                 # bytes.split() splits at x20, x09-x0D only
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            h = np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, len(words) - shingle + 1)
            ones, n = ones + _bit_counts(h), n + len(h)
            words = words[len(words) - shingle + 1:]
        carry = words
    if not n and carry:
        ones, n = _bit_counts(np.array([xxh64_intdigest(b" ".join(carry), 42)], np.uint64)), 1
    return int(((2 * ones > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)) if n else 0


def fingerprint_column(text, shingle: int = SHINGLE):
    """Signed 64-bit fingerprint of a string column."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        got = np.fromiter((fingerprint(t, shingle) for _, g in text_groups(texts) for t in g), np.uint64, len(texts))
        return pa.array(got.view(np.int64))
    return run(text)


def _labels(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest vertex of each component of the graph with the edges (i, j)."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, lab[i], low)
        np.minimum.at(new, lab[j], low)
        new = new[new]
        if np.array_equal(new, lab):
            return lab
        lab = new


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _blocks(fp: np.ndarray):
    """Order by quarter counts; per block of the order, the least and largest counts."""
    q = _quarters(fp)
    order = np.lexsort(q.T)
    fp, q = fp[order], q[order]
    cuts = range(0, len(fp), BLOCK)
    return fp, [(c, q[c:c + BLOCK].min(0), q[c:c + BLOCK].max(0)) for c in cuts]


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles (``b`` None: inside ``a``)."""
    a, blocks_a = _blocks(a)
    b, blocks_b = (a, blocks_a) if b is None else _blocks(b)
    same = b is a
    both, shift = (a, 0) if same else (np.concatenate([a, b]), len(a))
    lab = np.arange(len(both))
    found, held = [], 0

    def merge():
        nonlocal lab, found, held
        i, j = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
        lab, found, held = _labels(np.concatenate([np.arange(len(lab)), i]), np.concatenate([lab, j]), len(lab)), [], 0

    for ca, lo_a, hi_a in blocks_a:
        x = a[ca:ca + BLOCK, None]
        for cb, lo_b, hi_b in blocks_b:
            if same and cb < ca:
                continue
            if np.maximum(np.maximum(lo_a - hi_b, lo_b - hi_a), 0).sum() > radius:
                continue
            hit = np.flatnonzero(np.bitwise_count(x ^ b[None, cb:cb + BLOCK]) <= radius)
            if same and ca == cb and len(hit) == len(x):
                continue  # only each with itself
            if len(hit):
                i, j = hit // len(b[cb:cb + BLOCK]) + ca, hit % len(b[cb:cb + BLOCK]) + cb + shift
                new = lab[i] != lab[j]
                found.append((i[new], j[new]))
                held += int(new.sum())
                if held > 1 << 20:
                    merge()
    if held:
        merge()
    child = np.flatnonzero(lab != np.arange(len(lab)))
    return both[child], both[lab[child]]


def _links(spark, fps: DataFrame, radius: int, tile: int) -> DataFrame:
    """fps(fp) distinct -> (u, v): spanning forests of all tile meetings."""
    pops = fps.select("fp", F.bit_count("fp").cast("int").alias("p"))
    counts = {r.p: r.n for r in pops.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}  # 65 rows at most
    tiles = {p: -(-n // tile) for p, n in counts.items()}
    per_pop = F.create_map(*[F.lit(x) for p in range(65) for x in (p, tiles.get(p, 0))])
    pops = pops.withColumn("s", F.pmod(F.xxhash64("fp"), F.greatest(F.lit(1), per_pop[F.col("p")])).cast("int"))

    def pack(key, t):
        return pa.table({"p": pa.array([key[0].as_py()], pa.int32()), "s": pa.array([key[1].as_py()], pa.int32()),
                         "fps": pa.array([np.sort(t["fp"].to_numpy()).tobytes()], pa.binary())})

    packed = pops.groupBy("p", "s").applyInArrow(pack, "p int, s int, fps binary")

    def meet(lo, hi, least):
        """Tiles (p2, s2) of the counts lo..hi, of an equal count only from ``least`` on."""
        ps = F.filter(F.sequence(lo, hi), lambda x: (x >= 0) & (x <= 64) & (per_pop[x] > 0))
        return F.flatten(F.transform(ps, lambda x: F.transform(
            F.filter(F.sequence(F.lit(0), per_pop[x] - 1), least(x)),
            lambda y: F.struct(x.alias("p2"), y.alias("s2")))))

    p, s = F.col("p"), F.col("s")
    first = (packed.withColumn("with", F.explode(meet(p, p + radius, lambda x: lambda y: (x != p) | (y >= s))))
             .select(p.alias("p1"), s.alias("s1"), "with.p2", "with.s2", F.lit(0).alias("side"), "fps"))
    second = (packed.withColumn("with", F.explode(meet(p - radius, p, lambda x: lambda y: (x != p) | (y < s))))
              .select(F.col("with.p2").alias("p1"), F.col("with.s2").alias("s1"), p.alias("p2"), s.alias("s2"),
                      F.lit(1).alias("side"), "fps"))

    def compare(t):
        t = t.take(pc.sort_indices(t["side"]))
        got = [np.frombuffer(x.as_py(), np.uint64) for x in t["fps"]]
        u, v = tile_links(got[0], got[1] if len(got) > 1 else None, radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    meetings = sum(n * (n + 1) // 2 + n * sum(tiles.get(q, 0) for q in range(p + 1, p + radius + 1)) for p, n in tiles.items())
    tasks = max(partitions(spark), -(-meetings // MEETINGS))
    pairs = first.unionByName(second).repartition(tasks, "p1", "s1", "p2", "s2")
    return pairs.groupBy("p1", "s1", "p2", "s2").applyInArrow(compare, "u long, v long")


def near_dup_classes(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """rows(doc_id, fp) -> (fp, component_id) for every distinct fingerprint."""
    spark = rows.sparkSession
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    roots = components(_links(spark, fps, radius, tile))
    tied = fps.join(roots, fps.fp == roots.vertex, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return tied.select("fp", "root").join(ids, "root").select("fp", "component_id", "root")


def near_dup_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = materialize(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    classes = near_dup_classes(rows, radius, tile).select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest doc_id (first such row)."""
    rid, fp = fresh(docs, "rid"), fresh(docs, "fp")
    numbered = docs.withColumn(rid, F.monotonically_increasing_id())
    rows = materialize(numbered.select("doc_id", F.col(rid).alias("rid"),
                                       fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    roots = near_dup_classes(rows.select("doc_id", "fp"), radius, tile).select("fp", "root")
    stays = (rows.join(roots, "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("low"))
             .select(F.col("low.rid").alias(rid)))
    return numbered.join(stays, rid, "left_semi").drop(rid)
