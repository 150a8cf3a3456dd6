"""PageRank by blocks of nodes.

Each round: ``contributions = edges JOIN ranks ON src`` then
``new ranks = sum(rank / out_degree) GROUP BY dst``.  Nodes are dealt to blocks by hash, and a
block owns the out-edges of its nodes, packed once (``_pack_out``, ``_pack_in``): which of its
sources adds to which target, and where the sums that other blocks send belong.  A round is
one shuffle of packed messages: a block adds up what came for its nodes and sends, per
block, one sum per target, in an order both know; no row per edge is shuffled, joined or
hashed.  The packed blocks are hash-partitioned once and cached.  Every ten rounds
(sooner if the messages are large) the messages are written to the shared folder, and
the table before and the rounds' shuffle files are deleted, so neither the lineage nor the plan
nor the folder nor the executors' disks grow with the number of rounds, and a lost executor
recomputes at most a few rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import drop_shared, shared_table

# Fixed values of the reference run: 100 rounds, start rank 1.0, no damping.
DEFAULT_ROUNDS = 100
START_RANK = 1.0
# Edges per block of nodes: a task holds them packed, 4 bytes each.
EDGES_PER_PARTITION = 1 << 22
# Sums that may stand on the executors' disks: rounds between two writes times the sums of one, if one round has fewer.
SHUFFLED_EDGES = 1 << 26

_OUT = {"srcs": "<i8", "deg": "<f8", "pos": "<i4", "start": "<i4", "out_b": "<i4", "out_n": "<i8", "more_b": "<i4", "more_t": "<i4"}
_IN = {"own": "<i8", "first": "?", "in_c": "<i4", "in_n": "<i8", "in_at": "<i4"}
_PARTS = "block int, other int, ids binary, first binary, " + ", ".join(f"{c} binary" for c in _OUT)
_BLOCK = "block int, " + ", ".join(f"{c} binary" for c in (*_OUT, *_IN))
_MESSAGE = "block int, other int, sums binary"


def _table(schema: str, rows: list[dict]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.table({c: pa.array([r.get(c) for r in rows], kinds[t]) for c, t in (x.split() for x in schema.split(", "))})


def _read(table: pa.Table, at: int, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(table.column(c)[at].as_buffer(), t) for c, t in kinds.items()}


def _cuts(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal numbers begin, and their lengths."""
    start = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, "<i8")
    return start, np.diff(np.append(start, len(a)))


def _pack_out(table: pa.Table) -> pa.Table:
    """The out-edges of a block's nodes -> its row, and the list of targets it will send sums for to each block."""
    block = table.column("block")[0].as_py()
    node, dst, to = (table.column(c).to_numpy() for c in ("node", "dst", "to"))
    srcs, pos = np.unique(node, return_inverse=True)
    deg = np.bincount(pos, minlength=len(srcs)).astype("<f8")
    if "deg" in table.column_names:                                 # of a node whose edges are in several blocks
        whole = table.column("deg").fill_null(0).to_numpy()
        deg[pos[whole > 0]] = whole[whole > 0]
    order = np.lexsort((dst, to))
    pos, dst, to = pos[order], dst[order], to[order]
    start, _ = _cuts(dst)                                           # equal targets have equal blocks and stand together
    targets, to = dst[start], to[start]
    places, sizes = _cuts(to)
    ids, first = {}, {}
    for s, n in zip(places, sizes):
        ids[int(to[s])], first[int(to[s])] = [targets[s:s + n]], [np.ones(n, "?")]
    more = []
    if "more" in table.column_names:                                # other blocks that own a target as well
        copied = table.column("more").take(pa.array(order[start])).combine_chunks()
        at = np.flatnonzero(copied.is_valid().to_numpy(zero_copy_only=False))
        more = sorted({(int(b), int(t)) for t in at for b in copied[int(t)].as_py().split(",") if b})
    for b, t in more:
        ids.setdefault(b, []).append(targets[t:t + 1])
        first.setdefault(b, []).append(np.zeros(1, "?"))
    packed = {"srcs": srcs, "deg": deg, "pos": pos, "start": start, "out_b": to[places], "out_n": sizes,
              "more_b": np.array([b for b, _ in more], "<i4"), "more_t": np.array([t for _, t in more], "<i4")}
    rows = [{"block": block, "other": -1, **{c: packed[c].astype(t).tobytes() for c, t in _OUT.items()}}]
    rows += [{"block": b, "other": block, "ids": np.concatenate(ids[b]).astype("<i8").tobytes(), "first": np.concatenate(first[b]).tobytes()} for b in sorted(ids)]
    return _table(_PARTS, rows)


def _pack_in(table: pa.Table) -> pa.Table:
    """A block's row and the lists of all blocks that send to it -> the row with its nodes and each list's places among them."""
    others = table.column("other").to_numpy()
    lists = [at for at in np.argsort(others, kind="stable") if others[at] >= 0]
    ids = [np.frombuffer(table.column("ids")[int(at)].as_buffer(), "<i8") for at in lists]
    mine = np.flatnonzero(others < 0)
    out = _read(table, int(mine[0]), _OUT) if len(mine) else {c: np.empty(0, t) for c, t in _OUT.items()}
    own = np.unique(np.concatenate([out["srcs"], *ids]))
    first = np.zeros(len(own), "?")
    for at, x in zip(lists, ids):
        mark = np.frombuffer(table.column("first")[int(at)].as_buffer(), "?")
        first[np.searchsorted(own, x[mark])] = True
    places = [np.searchsorted(own, x) for x in ids]
    packed = {**out, "own": own, "first": first, "in_c": others[lists], "in_n": np.array([len(x) for x in ids], "<i8"),
              "in_at": np.concatenate([np.empty(0, "<i8"), *places])}
    return _table(_BLOCK, [{"block": table.column("block")[0].as_py(), **{c: packed[c].astype(t).tobytes() for c, t in {**_OUT, **_IN}.items()}}])


def _sent(block: int, x: dict[str, np.ndarray], rank: np.ndarray, has: np.ndarray) -> list[dict]:
    """Messages of a block whose sources ``srcs`` have these ranks; no number stands for a sum of nothing."""
    if not has.any():
        return []
    c = np.where(has, rank / x["deg"], 0.0)
    sums = np.add.reduceat(c[x["pos"]], x["start"])
    if not has.all():
        sums[np.add.reduceat(has[x["pos"]].astype("<i8"), x["start"]) == 0] = np.nan
    parts = {int(b): [s] for b, s in zip(x["out_b"], np.split(sums, np.cumsum(x["out_n"])[:-1]))}
    for b, t in zip(x["more_b"].tolist(), x["more_t"]):
        parts.setdefault(b, []).append(sums[t:t + 1])
    return [{"block": b, "other": block, "sums": np.concatenate(s).tobytes()} for b, s in parts.items()]


def _ranks(messages: pa.Table, x: dict[str, np.ndarray], damping: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(rank, whether there is one) of a block's nodes from the sums sent to it."""
    rank, has = np.zeros(len(x["own"])), np.zeros(len(x["own"]), "?")
    places = dict(zip(x["in_c"].tolist(), np.split(x["in_at"], np.cumsum(x["in_n"])[:-1])))
    others = messages.column("other").to_numpy()
    for at in np.argsort(others):                                   # a fixed order: the same sums in every run
        s, to = np.frombuffer(messages.column("sums")[int(at)].as_buffer(), "<f8"), places[int(others[at])]
        known = ~np.isnan(s)
        rank[to[known]] += s[known]                                 # a message has a target once
        has[to[known]] = True
    return (rank if damping is None else np.where(has, 1.0 - damping + damping * rank, 0.0)), has


def _start(batches):
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for at in range(table.num_rows):
            x = _read(table, at, _OUT)
            rows = _sent(table.column("block")[at].as_py(), x, np.full(len(x["srcs"]), START_RANK), np.ones(len(x["srcs"]), "?"))
            yield from _table(_MESSAGE, rows).to_batches()


def _round(damping: float | None, last: bool):
    def run(messages: pa.Table, blocks: pa.Table) -> pa.Table:
        x = _read(blocks, 0, {**_OUT, **_IN})
        rank, has = _ranks(messages, x, damping)
        if last:
            some = has & x["first"]
            return pa.table({"node": x["own"][some], "rank": rank[some]})
        at = np.searchsorted(x["own"], x["srcs"])
        return _table(_MESSAGE, _sent(blocks.column("block")[0].as_py(), x, rank[at], has[at]))
    return run


def _numbered(stored: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(edges of whole numbers, their names): nodes that are whole numbers stay as they are, if none is null."""
    whole = all(isinstance(stored.schema[c].dataType, T.IntegralType) for c in ("node", "dst"))
    if whole and not stored.where("dst is null").limit(1).count():
        return stored.select(F.col("node").cast("long"), F.col("dst").cast("long")), None
    names = stored.select("node").union(stored.select("dst")).distinct()
    names = shared_table(names.withColumn("id", F.monotonically_increasing_id()), "names")
    src, dst = names.select(F.col("node").alias("_n"), F.col("id").alias("_s")), names.select(F.col("node").alias("_m"), F.col("id").alias("_d"))
    e = (stored.join(src, F.col("node").eqNullSafe(F.col("_n"))).join(dst, F.col("dst").eqNullSafe(F.col("_m")))
         .select(F.col("_s").alias("node"), F.col("_d").alias("dst")))
    return shared_table(e, "numbered"), names


def _block_ids(spark, n: int) -> list[int]:
    """A number for each of ``n`` hash partitions, so no two blocks share one."""
    tried = spark.range(n * (16 + 2 * n.bit_length())).select(F.col("id").cast("int").alias("b"))
    found = tried.groupBy(F.pmod(F.hash("b"), F.lit(n)).alias("p")).agg(F.min("b").alias("b")).collect()
    ids = {r.p: r.b for r in found}
    return [ids[p] for p in range(n)] if len(ids) == n else list(range(n))


def pagerank(edges: DataFrame, rounds: int = DEFAULT_ROUNDS, damping: float | None = None,
             checkpoint_every: int = 10, partitions: int | None = None) -> DataFrame:
    """Ranks after ``rounds`` rounds -> ``(node, rank)``.

    Without ``damping`` (the reference's rule) a new rank is the plain sum
    of contributions: a node without in-links drops out after round 1, and
    mass sent to a node without out-links is lost.  With ``damping`` d the
    new rank is ``(1 - d) + d * sum``.

    Blocks are sized from the edge count alone (``EDGES_PER_PARTITION``).
    A source node with more out-edges than one block's share is split
    before anything is packed: its edges get a piece ``hash(dst) % pieces``,
    every block with a piece owns the node as well and is sent all sums for it, so no task
    carries a hot node's whole fan-out; a hot target is one sum per block.  Out-degrees sum to the edge count,
    so at most ``partitions`` nodes are split: a proven bound for the broadcast.  The loop
    fixes its partitioning by hand and runs in a session of its own with
    adaptive planning off and shuffle files removed at the end of each write; the caller's session keeps
    its settings.  ``checkpoint_every``: rounds between two writes at most (see ``SHUFFLED_EDGES``).
    """
    spark = edges.sparkSession
    given = shared_table(edges.select(F.col("src").alias("node"), "dst").where("node is not null").distinct(), "edges")
    n_edges = given.count()
    if rounds < 1 or not n_edges:
        return spark.createDataFrame([], T.StructType([given.schema["node"], T.StructField("rank", T.DoubleType())]))
    stored, names = _numbered(given)
    n = partitions or max(2, -(-n_edges // EDGES_PER_PARTITION),
                          min(spark.sparkContext.defaultParallelism, n_edges // max(1, EDGES_PER_PARTITION // 8)))
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(n))
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")

    def here(df: DataFrame) -> DataFrame:
        """A stored table in the loop's session."""
        return own.read.schema(df.schema).parquet(*{f.rsplit("/", 1)[0] for f in df.inputFiles()})
    heavy_at = max(EDGES_PER_PARTITION, -(-n_edges // n))
    e = here(given if names is None else stored).select(F.col("node").cast("long"), F.col("dst").cast("long"))
    heavy = shared_table(e.groupBy("node").agg(F.count(F.lit(1)).cast("double").alias("deg")).where(F.col("deg") > heavy_at)
                         .select("node", "deg", F.ceil(F.col("deg") / heavy_at).cast("int").alias("pieces")), "heavy")
    ids = F.array(*[F.lit(b) for b in _block_ids(own, n)])

    def block(node, piece):
        return F.element_at(ids, (F.pmod(F.xxhash64(node, piece), F.lit(n)) + 1).cast("int"))
    placed = e.select("node", "dst", block(F.col("node"), F.lit(0)).alias("block"), block(F.col("dst"), F.lit(0)).alias("to"))
    if heavy.limit(1).count():
        targets = F.broadcast(heavy.select(F.col("node").alias("dst"), F.col("pieces").alias("copies")))
        to = block(F.col("dst"), F.lit(0))
        every_piece = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda p: block(F.col("dst"), p.cast("int")))
        placed = (e.join(F.broadcast(heavy), "node", "left").join(targets, "dst", "left")
                  .select("node", "dst", block(F.col("node"), F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(
                      F.pmod(F.xxhash64("dst"), F.col("pieces")).cast("int"))).alias("block"), to.alias("to"), "deg",
                      F.when(F.col("copies").isNotNull(), F.array_join(F.array_remove(F.array_distinct(every_piece), to).cast("array<string>"), ",")).alias("more")))     # a text: lists with nulls are slow to hand over
    parts = shared_table(placed.groupBy("block").applyInArrow(_pack_out, _PARTS), "graph-parts")
    blocks = shared_table(parts.groupBy("block").applyInArrow(_pack_in, _BLOCK), "graph-blocks")
    sent = blocks.agg(F.sum(F.length("in_at") / 4)).head()[0] or 0
    every = max(1, min(checkpoint_every, int(SHUFFLED_EDGES // max(sent, 1))))
    for helper in (parts, heavy, given, *([stored] if names is not None else [])):
        drop_shared(helper)
    kept = blocks.repartition(n, "block").cache()
    messages, written = kept.mapInArrow(_start, _MESSAGE), None
    try:
        for r in range(1, rounds + 1):
            out = "node long, rank double" if r == rounds else _MESSAGE
            messages = messages.groupBy("block").cogroup(kept.groupBy("block")).applyInArrow(_round(damping, r == rounds), out)
            if r % every == 0 or r == rounds:
                messages = shared_table(messages, "ranks")
                if written is not None:
                    drop_shared(written)
                written = messages
    finally:
        kept.unpersist()
    drop_shared(blocks)
    path = {f.rsplit("/", 1)[0] for f in written.inputFiles()}
    ranks = spark.read.schema(written.schema).parquet(*path) if path else spark.createDataFrame([], written.schema)
    if names is not None:
        return ranks.join(names, ranks["node"] == names["id"]).select(names["node"], "rank")
    return ranks.select(F.col("node").cast(given.schema["node"].dataType).alias("node"), "rank")
