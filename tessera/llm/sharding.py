"""Operator 5: byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Groups are the equal texts; a group's weight is the bytes of all its rows.
Groups are dealt by hash to cells of about ``CELL_GROUPS``; a task differences
one cell: it keeps the partial partitions in a heap and repeatedly combines the
two with the largest spread, one in falling and one in rising order of sums.  What
is left of a cell is one partial partition (a sum per shard); those are differenced
in the same way, ``FAN`` of them in a task, level by level until one is left.  The
places of the levels, joined from the top down, fix the shard of every cell's part.
Nothing but two counts of rows reaches the driver.

The balance is limited by the largest group only: a group above 1/shards of all
bytes fills its shard alone.

Defined cases: null text has no bytes (size 1, CRC 0) and equals the empty text.
Repeated rows each get a slot.  Null ids are allowed.  Empty table: no rows.
Slots follow the scan order inside hash ranges, so ``docs`` is read from files.
"""

from __future__ import annotations

import heapq
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import fresh, materialize, partitions, spread

SHARDS = 8
CELL_GROUPS = 1 << 15
FAN = 1 << 12
SLOT_ROWS = 1 << 15


def difference(parts: list[list[int]], k: int) -> list[list[int]]:
    """Karmarkar-Karp over partial partitions of ``k`` sums; place of each part's sums in the result."""
    seq, heap = count(), []
    for i, sums in enumerate(parts):
        slots = sorted(((s, (i, j)) for j, s in enumerate(sums)), key=lambda x: -x[0])
        heapq.heappush(heap, (slots[-1][0] - slots[0][0], next(seq), slots))
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = [(x + y, (left, right)) for (x, left), (y, right) in zip(a, reversed(b))]
        both.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], next(seq), both))
    place = [[0] * k for _ in parts]
    for at, (_, tree) in enumerate(heap[0][2] if heap else []):
        todo = [tree]
        while todo:
            left, right = todo.pop()
            if isinstance(left, tuple):
                todo += [left, right]
            else:
                place[left][right] = at
    return place


def _cell(k: int):
    def run(t):
        t = t.sort_by([("bytes", "descending"), ("g1", "ascending"), ("g2", "ascending")])
        parts = [[w] + [0] * (k - 1) for w in t["bytes"].to_pylist()]
        part = [p[0] for p in difference(parts, k)]
        return pa.table({"cell": t["cell"], "g1": t["g1"], "g2": t["g2"], "bytes": t["bytes"],
                         "part": pa.array(part, pa.int32())})
    return run


def _level(k: int):
    def run(t):
        t = t.sort_by("node")
        sums = t["sums"].to_pylist()
        place, total = difference(sums, k), [0] * k
        for part, at in zip(sums, place):
            for j in range(k):
                total[at[j]] += part[j]
        return pa.table({"node": t["node"], "parent": t["parent"], "place": pa.array(place, pa.list_(pa.int32())),
                         "sums": pa.array([total] + [None] * (len(sums) - 1), pa.list_(pa.int64()))})
    return run


def _parts_to_shards(parts: DataFrame, k: int, cells: int, fan: int = FAN) -> DataFrame:
    """parts(cell, part, bytes) -> cell, shards: the shard of each part (one row per cell)."""
    nodes = parts.groupBy(F.col("cell").alias("node")).agg(F.array(*[
        F.sum(F.when(F.col("part") == j, F.col("bytes")).otherwise(0)) for j in range(k)]).alias("sums"))
    levels, left = [], cells
    while not levels or left > 1:
        levels.append(materialize(
            nodes.withColumn("parent", F.expr(f"node div {fan}")).groupBy("parent")
            .applyInArrow(_level(k), "node long, parent long, place array<int>, sums array<long>"), "level"))
        nodes = levels[-1].where("sums is not null").select(F.col("parent").alias("node"), "sums")
        left = -(-left // fan)
    shards = levels[-1].select("node", F.col("place").alias("shards"))
    for level in reversed(levels[:-1]):
        above = shards.select(F.col("node").alias("parent"), F.col("shards").alias("above"))
        shards = level.join(above, "parent").select(
            "node", F.transform("place", lambda p: F.get("above", p)).alias("shards"))
    return shards.withColumnRenamed("node", "cell")


def assign(rows: DataFrame, k: int = SHARDS, cell_groups: int = CELL_GROUPS, fan: int = FAN) -> DataFrame:
    """rows(rid, g1, g2, size, ...) -> the same rows with shard and slot."""
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"))
    n_rows, n_groups = rows.count(), groups.count()
    cells = max(1, -(-n_groups // cell_groups))
    parts = materialize(groups.withColumn("cell", F.pmod(F.xxhash64("g1", "g2"), F.lit(cells)))
                        .groupBy("cell").applyInArrow(_cell(k), "cell long, g1 long, g2 long, bytes long, part int"), "parts")
    shard_of = parts.join(_parts_to_shards(parts, k, cells, fan), "cell").select(
        "g1", "g2", F.get("shards", F.col("part")).alias("shard"))
    ranges = max(partitions(rows.sparkSession), -(-n_rows // SLOT_ROWS))
    placed = materialize(rows.join(shard_of, ["g1", "g2"]).drop("g1", "g2")
                         .withColumn("range", spread(F.col("rid"), ranges)), "placed")
    counts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    start = counts.select("shard", "range", F.coalesce(
        F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy("shard", "range").orderBy("rid")) - 1
    return (placed.withColumn("local", local).join(start, ["shard", "range"])
            .withColumn("slot", F.col("start") + F.col("local")).drop("range", "local", "start"))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("g1"), F.xxhash64(F.lit("~"), text).alias("g2")), "sizes")


def shard_report(docs: DataFrame, k: int = SHARDS, cell_groups: int = CELL_GROUPS, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: law ``bytes``)."""
    return assign(_rows(docs), k, cell_groups, fan).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, k: int = SHARDS, cell_groups: int = CELL_GROUPS) -> DataFrame:
    """The documents with ``shard`` and ``slot`` (replacing columns of these names), ready to be written by shard."""
    rid = fresh(docs, "rid")
    placed = assign(_rows(docs), k, cell_groups).select(F.col("rid").alias(rid), "shard", "slot")
    return (docs.drop("shard", "slot").withColumn(rid, F.monotonically_increasing_id())
            .join(placed, rid).drop(rid))
