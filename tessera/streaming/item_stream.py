"""Item similarity over a stream: keyed state, expiry by event time, keyed tables.

    rows -> combined per task -> state per (item, salt) -> foreachBatch: tables per (item, salt) and item

* ``combine`` is stateless: some 100,000 rows of a task at a time are reduced to at most ``RECENT`` ratings per
  item and one row per pair, so many events of one item or one pair are few rows before the shuffle.
* The state is kept per (item, salt).  A rating's salt is a hash of its id, a pair's one of
  the partner, so every salt owns its partners and its share of the ratings and keeps the best ``PARTNERS``
  and latest ``RECENT`` of them; the item's own are among those.  A hot item's rows and state
  are spread over ``salts`` keys.  The keys' states are stored, and the state function is called, by buckets of keys.
* Every salt of an item hears of every event time of the item ("touch" rows), so expiry is
  the item's: an item idle for longer than the TTL starts afresh, and an event-time timer removes the
  state, and says so to the sink, once the watermark has passed its last event by the TTL.
* ``SimilaritySink`` puts the salts' summaries into a ``KeyedTable``, merges those of the touched items
  (at most salts x (RECENT + PARTNERS) entries each) and changes the rows of touched items, and the lists of
  their partners, in two more.  What a batch writes follows its items, not the tables.
"""

from __future__ import annotations

import json
import os
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.streaming.keyed_table import BUCKETS, FAN, KeyedTable
from tessera.streaming.similarity import (DELTA, NEIGHBOURS, PARTNERS, RECENT, hoeffding_prune, mirror, pair_similarity)

SALTS = 4
TTL_MS = 7 * 24 * 3600 * 1000
#: Events may come this much after the newest one; later ones are dropped.
LATENESS_MS = 24 * 3600 * 1000
#: Rows of the state store, and calls of the state function in a batch at most.
STATE_BUCKETS = 1024
#: Rows that a task combines at once.
COMBINE_ROWS = 1 << 17

STREAM_INPUT = T.StructType([
    T.StructField("item", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("ts_us", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("rating", T.DoubleType()), T.StructField("partner", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("n", T.LongType()),
])
COMBINED = T.StructType([*STREAM_INPUT.fields, T.StructField("first_us", T.LongType()), T.StructField("salt", T.IntegerType())])
_LISTS = [T.StructField("ts_us", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.LongType())),
          T.StructField("ratings", T.ArrayType(T.DoubleType())), T.StructField("partners", T.ArrayType(T.LongType())),
          T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("ns", T.ArrayType(T.LongType()))]
#: A bucket's keys as JSON: item, salt, the lists, last event time (us), time to go (ms).
STATE = T.StructType([T.StructField("keys", T.StringType())])
PART = T.StructType([T.StructField("item", T.LongType()), T.StructField("salt", T.IntegerType()), *_LISTS])
STATE_OUT = T.StructType([*PART.fields, T.StructField("gone", T.BooleanType())])
ITEM = T.StructType([T.StructField("item", T.LongType()), T.StructField("cnt", T.DoubleType())])
LIST = T.StructType([T.StructField("item", T.LongType()), T.StructField("neighbours", T.ArrayType(T.StructType([
    T.StructField("neighbour", T.LongType()), T.StructField("sim", T.DoubleType())])))])


def stream_rows(item_events: DataFrame, pair_events: DataFrame) -> DataFrame:
    """Batch or streaming events -> the single input layout of the state:
    ratings as kind 'rating', pair events once per item as kind 'pair'.  Both
    carry their event time if the source has a ``ts``; both renew an item's TTL."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    r = item_events.select("item", F.lit("rating").alias("kind"), us.alias("ts_us"), "id",
                           F.col("rating").cast("double").alias("rating"),
                           F.lit(None).cast("long").alias("partner"), F.lit(None).cast("double").alias("score"),
                           F.lit(None).cast("long").alias("n"))
    timed = pair_events.withColumn("_us", us if "ts" in pair_events.columns else F.lit(None).cast("long"))
    p = timed.select("item_i", "item_j", F.col("rating").alias("score"), F.col("n_ij").alias("n"), "_us")
    p = (mirror(p, "item_i", "item_j", "item", "partner", "score", "n", "_us")
         .select("item", F.lit("pair").alias("kind"), F.col("_us").alias("ts_us"),
                 F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("rating"),
                 "partner", F.col("score").cast("double").alias("score"), F.col("n").cast("long").alias("n")))
    return r.unionByName(p)


# -- before the shuffle --------------------------------------------------------

def _latest(rows: pd.DataFrame, recent: int) -> pd.DataFrame:
    ordered = rows.sort_values(["item", "ts_us", "id", "rating"], ascending=[True, False, False, False])
    return ordered.groupby("item", sort=False).head(recent)


def _combine(recent: int, salts: int):
    def together(frames):
        held, size = [], 0
        for rows in frames:
            held, size = [*held, rows], size + len(rows)
            if size >= COMBINE_ROWS:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if size:
            yield pd.concat(held, ignore_index=True)

    def run(frames):
        for rows in together(frames):
            rating, pair = rows[rows["kind"] == "rating"], rows[rows["kind"] == "pair"]
            rating = _latest(rating, recent).assign(salt=lambda d: d["id"] % salts, first_us=None)
            sums = pair.groupby(["item", "partner"], as_index=False).agg(score=("score", "sum"), n=("n", "sum"), ts_us=("ts_us", "max"))
            sums = sums.assign(kind="pair", salt=lambda d: d["partner"] % salts, first_us=None, id=None, rating=None)
            times = rows.groupby("item", as_index=False).agg(ts_us=("ts_us", "max"), first_us=("ts_us", "min"))
            for out in (rating.assign(partner=None, score=None, n=None), sums,
                        *(times.assign(kind="touch", salt=s, id=None, rating=None, partner=None, score=None, n=None) for s in range(salts))):
                if len(out):
                    yield out[COMBINED.fieldNames()].astype({c: "Int64" for c in ("ts_us", "id", "partner", "n", "first_us")})
    return run


def combine(rows: DataFrame, recent: int = RECENT, salts: int = SALTS) -> DataFrame:
    """``COMBINE_ROWS`` rows of a task at a time reduced per item and pair, with their salts; no shuffle, no state.

    A salt is the id or the partner modulo ``salts``.  "touch" rows carry, to every salt of an
    item, the first and last event time of the item's rows.  Rows without an item, ratings without
    a time or an id, and pairs without a partner are left out."""
    whole = F.col("item").isNotNull() & F.when(F.col("kind") == "rating", F.col("ts_us").isNotNull() & F.col("id").isNotNull()).otherwise(
        (F.col("kind") == "pair") & F.col("partner").isNotNull())
    return rows.select(*STREAM_INPUT.fieldNames()).where(whole).mapInPandas(_combine(recent, salts), COMBINED)


# -- state ---------------------------------------------------------------------

def _known(x) -> bool:
    """Not null: neither None nor pandas' NA nor NaN."""
    return x is not None and x is not pd.NA and x == x


def _recent(ratings: list[tuple], recent: int) -> list[tuple]:
    """The latest (ts, id, rating), unknown ratings behind known ones of the same event."""
    return sorted(ratings, key=lambda x: (-x[0], -x[1], not _known(x[2]), -x[2] if _known(x[2]) else 0.0))[:recent]


def _fold(recent: int, partners_k: int, ttl_ms: int):
    """What a key does with its rows, in plain lists, as it has few of them: ``hear`` takes a chunk's, ``close`` the batch's end."""
    ttl_us = ttl_ms * 1000

    def hear(heard, kinds, times, firsts, ids, ratings, partners, scores, ns):
        """``heard``: newest and first time, at most ``recent`` ratings, sums by partner."""
        newest, first, new_ratings, new_scores = heard
        heard[0] = max([int(t) for t in times if _known(t)] + ([] if newest is None else [newest]), default=None)
        heard[1] = min([int(t) for t in firsts if _known(t)] + ([] if first is None else [first]), default=None)
        if "rating" in kinds:
            rows = zip(kinds, times, ids, ratings)
            heard[2] = _recent(new_ratings + [(int(t), int(i), float(r) if _known(r) else float("nan")) for kind, t, i, r in rows if kind == "rating"], recent)
        if "pair" in kinds:
            for kind, p, s, n in zip(kinds, partners, scores, ns):
                if kind == "pair":
                    score, common = new_scores.get(int(p), (0.0, 0))
                    new_scores[int(p)] = (score + (float(s) if _known(s) else 0.0), common + (int(n) if _known(n) else 0))

    def close(old, heard, watermark):
        """(value, last time, timer, whether it changed) of a key; no value: nothing to keep."""
        newest, first, new_ratings, new_scores = heard
        ratings = list(zip(old[0], old[1], old[2]))
        scores = {p: (s, n) for p, s, n in zip(old[3], old[4], old[5])}
        last, changed = old[6], False
        # An item idle for longer than the TTL (event time) starts afresh
        if first is not None and last is not None and first - last > ttl_us:
            changed = len(ratings) + len(scores) > 0
            ratings, scores = [], {}
        if newest is not None:
            last = newest if last is None else max(last, newest)
        changed = changed or len(new_ratings) + len(new_scores) > 0
        if new_ratings:
            ratings = _recent(ratings + new_ratings, recent)                                                          # T1
        for p, (s, n) in new_scores.items():
            before = scores.get(p, (0.0, 0))
            scores[p] = (before[0] + s, before[1] + n)
        best = sorted(scores.items(), key=lambda x: (-x[1][0], x[0]))[:partners_k]                                     # T2
        if not ratings and not best:
            return None, last, None, changed
        ts, ids, values = ([x[c] for x in ratings] for c in range(3))
        timer = watermark + 1 if last is None else last // 1000
        return ((ts, ids, values, [p for p, _ in best], [s for _, (s, _) in best], [n for _, (_, n) in best]), last,
                max(timer, watermark + 1 - ttl_ms) + ttl_ms, changed)
    return hear, close


_HEARD = ("kind", "ts_us", "first_us", "id", "rating", "partner", "score", "n")
_NONE = ([],) * 6


def _out(rows) -> pd.DataFrame:
    """``STATE_OUT`` rows from (key, value, gone)."""
    return pd.DataFrame({"item": [int(k[0]) for k, _, _ in rows], "salt": [int(k[1]) for k, _, _ in rows],
                         **{f.name: [v[c] for _, v, _ in rows] for c, f in enumerate(_LISTS)}, "gone": [gone for _, _, gone in rows]})


def _make_update(recent: int, partners_k: int, ttl_ms: int):
    """The state function of one key."""
    hear, close = _fold(recent, partners_k, ttl_ms)

    def update(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            yield _out([(key, _NONE, True)])
            return
        heard = [None, None, [], {}]
        for pdf in pdfs:                       # each chunk is folded at once: at most ``recent`` ratings are held
            hear(heard, *(pdf[c].tolist() for c in _HEARD))
        value, last, timer, changed = close(state.get if state.exists else (*_NONE, None), heard, state.getCurrentWatermarkMs())
        if value is None:                      # nothing to keep under this salt
            if state.exists:
                state.remove()
            if changed:
                yield _out([(key, _NONE, True)])
            return
        state.update((*value, last))
        state.setTimeoutTimestamp(timer)
        if changed:
            yield _out([(key, value, False)])
    return update


def _make_buckets(recent: int, partners_k: int, ttl_ms: int):
    """The state function of a bucket of keys: each key's as ``_make_update``, with its own time to go.

    Spark takes some ten milliseconds to call a state function, whatever it does, so a call per key takes nearly all the
    time of a batch.  The bucket's timer is that of the key that goes first."""
    hear, close = _fold(recent, partners_k, ttl_ms)

    def update(bucket, pdfs, state):
        watermark = state.getCurrentWatermarkMs()
        kept = {(k[0], k[1]): k[2:] for k in json.loads(state.get[0])} if state.exists else {}
        heard, out = {}, []
        for pdf in pdfs if not state.hasTimedOut else ():
            pdf = pdf.sort_values(["item", "salt"], kind="stable")
            items, salts, *columns = (pdf[c].tolist() for c in ("item", "salt", *_HEARD))
            at = 0
            for (item, salt), rows in groupby(zip(items, salts)):
                end = at + sum(1 for _ in rows)
                hear(heard.setdefault((int(item), int(salt)), [None, None, [], {}]), *(c[at:end] for c in columns))
                at = end
        for key, new in heard.items():
            value, last, timer, changed = close(kept.get(key, (*_NONE, None)), new, watermark)
            if value is None:
                kept.pop(key, None)
            else:
                kept[key] = [*value, last, timer]
            if changed:
                out.append((key, value or _NONE, value is None))
        for key in [k for k, v in kept.items() if k not in heard and v[-1] < watermark]:
            del kept[key]
            out.append((key, _NONE, True))
        if kept:
            state.update((json.dumps([[*k, *v] for k, v in kept.items()], separators=(",", ":")),))
            state.setTimeoutTimestamp(max(min(v[-1] for v in kept.values()), watermark, 1))
        elif state.exists:
            state.remove()
        if out:
            yield _out(out)
    return update


def item_state_stream(rows: DataFrame, recent: int = RECENT, partners: int = PARTNERS, ttl_ms: int = TTL_MS,
                      lateness_ms: int = LATENESS_MS, salts: int = SALTS, buckets: int = STATE_BUCKETS) -> DataFrame:
    """T1 + T2 + T6 as one keyed state per (item, salt) -> ``STATE_OUT`` rows of a micro-batch:
    the summary of each changed key, or ``gone`` for one that has expired.  The state is stored in ``buckets`` rows,
    by a hash of the key; a checkpoint goes on with the number it began with.

    Event time: rows more than ``lateness_ms`` behind the newest event of earlier batches are dropped.
    Rows without a time renew nothing; a key that never had one expires by the watermark at its last row.
    """
    timed = combine(rows, recent, salts).withColumn("event_time", F.timestamp_micros("ts_us"))
    keyed = timed.withWatermark("event_time", f"{lateness_ms} milliseconds").withColumn("bucket", F.pmod(F.xxhash64("item", "salt"), F.lit(buckets)).cast("int"))
    return keyed.groupBy("bucket").applyInPandasWithState(_make_buckets(recent, partners, ttl_ms), STATE_OUT, STATE, "update", "EventTimeTimeout")


def merged_items(parts: DataFrame, recent: int = RECENT, partners: int = PARTNERS) -> DataFrame:
    """Summaries per (item, salt) -> ``(item, cnt, pairs)``: the sum of the item's latest ratings and its best
    partners as (score, partner, n).  An item has a summary per salt at most, so its lists are bounded."""
    rated = F.flatten(F.collect_list(F.arrays_zip("ts_us", "ids", "ratings")))
    paired = F.flatten(F.collect_list(F.transform(F.arrays_zip("scores", "partners", "ns"), lambda p: F.struct(
        (-p["scores"]).alias("less"), p["partners"].alias("partner"), p["ns"].alias("n")))))
    both = parts.groupBy("item").agg(rated.alias("r"), paired.alias("p"))
    latest = F.slice(F.sort_array("r", asc=False), 1, recent)
    return both.select("item", F.aggregate(latest, F.lit(0.0), lambda a, x: a + x["ratings"]).alias("cnt"),
                       F.transform(F.slice(F.sort_array("p"), 1, partners), lambda p: F.struct(
                           (-p["less"]).alias("score"), p["partner"].alias("partner"), p["n"].alias("n"))).alias("pairs"))


# -- sink ----------------------------------------------------------------------

class SimilaritySink:
    """``foreachBatch`` sink over three ``KeyedTable``s under ``root``: ``parts`` (item, salt), ``items``
    (item, cnt) and ``lists`` (item, neighbours).  A replayed batch finds its runs complete and changes
    nothing; a batch after the first that finds no earlier run raises.
    """

    def __init__(self, root: str, neighbours: int = NEIGHBOURS, delta: float = DELTA, buckets: int = BUCKETS, fan: int = FAN):
        self.root, self.k, self.delta, self.buckets, self.fan = root.rstrip("/"), neighbours, delta, buckets, fan

    def table(self, spark: SparkSession, name: str) -> KeyedTable:
        schema, keys = {"parts": (PART, ["item", "salt"]), "items": (ITEM, ["item"]), "lists": (LIST, ["item"])}[name]
        return KeyedTable(spark, os.path.join(self.root, name), schema, keys, ["item"], self.buckets, self.fan)

    def lists(self, spark: SparkSession) -> DataFrame:
        """The present lists, one row per neighbour."""
        return _entries(self.table(spark, "lists").read())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts, items, lists = (self.table(spark, n) for n in ("parts", "items", "lists"))
        if not lists.has(batch_id):
            for t in (parts, items, lists):
                t.require_before(batch_id)
            batch = batch.persist()   # read several times: the stateful stage must run once
            try:
                self._merge(batch, batch_id, parts, items, lists)
            finally:
                batch.unpersist()
        for t in (parts, items, lists):
            t.compact()

    def _merge(self, batch: DataFrame, batch_id: int, parts: KeyedTable, items: KeyedTable, lists: KeyedTable) -> None:
        parts.apply(batch_id, batch.where(~F.col("gone")), batch.where("gone"))
        heard = batch.select("item").distinct()
        touched = merged_items(parts.read(batch_id, only=heard)).persist()
        left = heard.join(touched.select("item"), "item", "left_anti")      # items of which nothing is kept
        items.apply(batch_id, touched.select("item", "cnt"), left)
        # T3 for the touched items' partners, T4 against the previous lists, T5 merge
        pairs = (touched.select("item", F.explode("pairs").alias("p"))
                 .select(F.col("item").alias("item_i"), F.col("p.partner").alias("item_j"),
                         F.col("p.score").alias("rating"), F.col("p.n").alias("n_ij")))
        either = pairs.select(F.explode(F.array("item_i", "item_j")).alias("item")).unionByName(heard).distinct().persist()
        counts = items.read(batch_id, only=either)
        before = lists.read(batch_id - 1, only=either).persist()
        prev = _entries(before)
        kept = hoeffding_prune(pair_similarity(pairs, counts), prev, self.delta)
        # a kept pair enters the lists of both its items, whichever of them was touched
        new = (mirror(kept, "item_i", "item_j", "item", "neighbour", "sim")
               .groupBy("item", "neighbour").agg(F.max("sim").alias("sim")))
        # a pair already listed is kept as it is (never refreshed)
        new = new.join(prev.select("item", "neighbour"), ["item", "neighbour"], "left_anti")
        merged = prev.join(new.select("item").distinct(), "item", "left_semi").unionByName(new)
        w = Window.partitionBy("item").orderBy(F.desc("sim"), F.asc("neighbour"))
        rows = (merged.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= self.k)
                .groupBy("item").agg(F.collect_list(F.struct("neighbour", "sim")).alias("neighbours")))
        lists.apply(batch_id, rows.join(left, "item", "left_anti"), left)
        for df in (touched, either, before):
            df.unpersist()


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("item", F.explode("neighbours").alias("x")).select("item", "x.neighbour", "x.sim")
