"""Streaming job: state and tables = batch twins, replay changes nothing, idle items expire, hot items spread."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.plans.views import item_events, pair_events
from tessera.streaming import item_stream as ST
from tessera.streaming import similarity as SIM
from tests.conftest import SF_SMALL

YEARS = 20 * 366 * 24 * 3600 * 1000


def events(spark, ratings, pairs):
    ev = spark.createDataFrame(ratings, "item long, ts string, id long, rating double").withColumn("ts", F.col("ts").cast("timestamp"))
    pe = spark.createDataFrame(pairs, "item_i long, item_j long, rating double, n_ij long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev, pe


def run(spark, scratch, rows, sink=None, files=None, **state):
    """One more file of ``rows`` through the stream, until it has nothing left to do."""
    src, root = os.path.join(scratch, "in"), os.path.join(scratch, "sink")
    if rows is not None:
        rows.coalesce(files or 1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ST.STREAM_INPUT).option("maxFilesPerTrigger", 8).parquet(src)
    q = (ST.item_state_stream(stream, **state).writeStream.outputMode("update").foreachBatch(sink or ST.SimilaritySink(root, delta=0.5, buckets=4))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    assert q.awaitTermination(300)
    assert q.exception() is None
    return q


def state_of(spark, scratch):
    sink = ST.SimilaritySink(os.path.join(scratch, "sink"), delta=0.5, buckets=4)
    items = {r.item: r.cnt for r in sink.table(spark, "items").read().collect()}
    pairs = {(r.item, p.partner, p.score, p.n) for r in ST.merged_items(sink.table(spark, "parts").read()).collect() for p in r.pairs}
    return items, pairs, sorted(map(tuple, sink.lists(spark).collect()))


def twins(ev, pe):
    counts, partners = SIM.recent_item_counts(ev), SIM.recent_partner_scores(pe)
    lists = SIM.top_similar(SIM.pair_similarity(SIM.listed_pairs(partners), counts))
    return ({r.item: r.cnt for r in counts.collect()}, {(r.item, r.partner, r.score, r.n) for r in partners.collect()},
            sorted(map(tuple, lists.collect())))


def small_world(seed=3, items=40):
    rnd = random.Random(seed)
    ratings = [(i, f"2024-01-01 00:{m:02d}:00", m, float(rnd.randint(1, 5))) for i in range(items) for m in range(rnd.randint(1, 50))]
    pairs = [(i, j, float(rnd.randint(1, 9)), rnd.randint(1, 4), "2024-01-01 00:30:00")
             for i in range(items) for j in range(i + 1, items) if rnd.random() < 0.5]
    return ratings, pairs


def test_stream_equals_batch_twins_over_several_batches(spark, scratch):
    """T1, T2, T3 and T5 after four micro-batches = the batch twins (no item has more than 30 partners here)."""
    ev, pe = events(spark, *small_world())
    rows = ST.stream_rows(ev, pe).persist()
    unordered = (F.least("item", "partner") * 41 + F.greatest("item", "partner")) % 2
    for part in (rows.where("kind = 'rating' AND item % 2 = 0"), rows.where("kind = 'rating' AND item % 2 = 1"),
                 rows.where((F.col("kind") == "pair") & (unordered == 0)), rows.where((F.col("kind") == "pair") & (unordered == 1))):
        run(spark, scratch, part)
    assert state_of(spark, scratch) == twins(ev, pe)


def test_a_hot_item_is_spread_and_equals_its_twin(spark, scratch):
    """A third of all ratings are of one item and a third of all pair events of one pair."""
    rnd = random.Random(8)
    ratings = [(0 if k % 3 == 0 else rnd.randint(1, 60), f"2024-01-01 {k // 3600:02d}:{k // 60 % 60:02d}:{k % 60:02d}", k, float(rnd.randint(1, 5))) for k in range(9000)]
    pairs = [(0, 1, 1.0, 1, "2024-01-01 00:00:00") if k % 3 == 0 else (*sorted(rnd.sample(range(25), 2)), 2.0, 1, "2024-01-01 00:00:00") for k in range(3000)]
    ev, pe = events(spark, ratings, pairs)
    rows = ST.stream_rows(ev, pe)
    combined = ST.combine(rows.repartition(4), salts=4)
    hot = combined.where("item = 0 and kind <> 'touch'").groupBy("salt").count().collect()
    assert len(hot) == 4                                            # its rows go to four keys ...
    assert sum(r["count"] for r in hot) <= 4 * 2 * (30 + 25)        # ... and are few: bounded per Arrow batch
    run(spark, scratch, rows, files=3)
    assert state_of(spark, scratch) == twins(ev, pe)


def state_rows(q):
    return [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]][-1]


def test_untouched_items_expire_and_the_stream_ends(spark, scratch):
    """Ten minutes to live: pair and rating rows both renew, idle items leave state, tables and lists."""
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    live = {"ttl_ms": 600_000, "lateness_ms": 0, "salts": 2}
    feed = lambda ratings, pairs: run(spark, scratch, ST.stream_rows(*events(spark, ratings, pairs)), **live)
    feed([(i, at(0), i, 2.0) for i in (1, 2, 3)], [(1, 2, 1.0, 1, at(0))])
    items, pairs, lists = state_of(spark, scratch)
    assert set(items) == {1, 2, 3} and lists == [(1, 2, 0.5), (2, 1, 0.5)]
    feed([(2, at(8), 7, 1.0)], [(1, 9, 1.0, 1, at(8))])             # 2 renewed by a rating, 1 by a pair, 3 by nothing
    assert set(state_of(spark, scratch)[0]) == {1, 2, 3, 9}
    q = feed([(4, at(15), 1, 1.0)], [])                              # 3 is now idle for longer than it may live
    assert set(state_of(spark, scratch)[0]) == {1, 2, 4, 9}
    assert len(q.recentProgress) <= 3                                # no endless batches
    q = feed([(5, at(60), 1, 1.0)], [])
    items, pairs, lists = state_of(spark, scratch)
    assert items == {5: 1.0} and pairs == set() and lists == []
    assert state_rows(q) == 1 and len(q.recentProgress) <= 3
    assert run(spark, scratch, None, **live).recentProgress == [] or state_of(spark, scratch)[0] == {5: 1.0}


class _State:
    def __init__(self):
        self.value, self.timer, self.hasTimedOut = None, None, False

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):  # noqa: N802
        return 0

    def setTimeoutTimestamp(self, ms):  # noqa: N802
        self.timer = ms


def fold(state, upd, rows):
    """Rows through ``combine``'s function and one salt's state."""
    frames = list(ST._combine(3, 1)(pd.DataFrame([r]) for r in rows)) if isinstance(rows, list) else rows
    return list(upd((1, 0), frames, state))


def test_pair_writes_renew_an_item_and_chunks_do_not_matter():
    upd = ST._make_update(3, 2, ttl_ms=1000)
    base = {"item": 1, "id": 1, "rating": None, "partner": None, "score": None, "n": None}
    rate = lambda us, r, i=1: dict(base, kind="rating", ts_us=us, rating=r, id=i)
    pair = lambda us, p, s: dict(base, kind="pair", ts_us=us, partner=p, score=s, n=1)
    st = _State()
    fold(st, upd, [rate(0, 5.0)])
    for us in (900_000, 1_800_000, 2_700_000):                # pair traffic only
        fold(st, upd, [pair(us, 7, 1.0)])
    out = fold(st, upd, [rate(3_500_000, 2.0)])[0]
    assert out["ratings"][0] == [2.0, 5.0] and out["partners"][0] == [7] and out["scores"][0] == [3.0]
    assert st.timer == 4500
    assert fold(st, upd, [rate(9_000_000, 1.0)])[0]["partners"][0] == []
    rows = [rate(k, float(k), k) for k in range(9)] + [pair(5, k % 4, float(k)) for k in range(9)]
    whole, split = _State(), _State()
    a = fold(whole, upd, list(ST._combine(3, 1)([pd.DataFrame(rows)])).__iter__())[0]
    b = fold(split, upd, rows)[0]
    assert a.equals(b) and sum(a["ratings"][0]) == 21.0 and a["partners"][0] == [0, 3]


def test_a_touch_renews_without_output_and_a_timer_says_gone():
    upd = ST._make_update(3, 2, ttl_ms=1000)
    touch = pd.DataFrame([{"item": 1, "kind": "touch", "ts_us": 5_000, "first_us": 5_000, "id": None, "rating": None, "partner": None, "score": None, "n": None}])
    st = _State()
    assert list(upd((1, 0), [touch], st)) == [] and not st.exists          # nothing to keep: no state
    fold(st, upd, [{"item": 1, "kind": "rating", "ts_us": 0, "id": 1, "rating": 4.0, "partner": None, "score": None, "n": None}])
    assert list(upd((1, 0), [touch], st)) == [] and st.exists and st.timer == 1005
    late = touch.assign(ts_us=9_000_000, first_us=9_000_000)
    assert [bool(x["gone"][0]) for x in upd((1, 0), [late], st)] == [True] and not st.exists   # idle too long: starts afresh
    fold(st, upd, [{"item": 1, "kind": "rating", "ts_us": 0, "id": 1, "rating": 4.0, "partner": None, "score": None, "n": None}])
    st.hasTimedOut = True
    assert [bool(x["gone"][0]) for x in upd((1, 0), [], st)] == [True] and not st.exists


OUT = "item long, salt int, ts_us array<long>, ids array<long>, ratings array<double>, partners array<long>, scores array<double>, ns array<long>, gone boolean"


def test_kept_pair_enters_both_lists_and_lost_state_raises(spark, scratch):
    sink = ST.SimilaritySink(os.path.join(scratch, "s"), buckets=2)
    rated = lambda i, r: (i, 0, [1], [1], [r], [], [], [], False)
    sink(spark.createDataFrame([rated(1, 9.0), rated(2, 4.0)], OUT), 0)
    sink(spark.createDataFrame([(1, 1, [], [], [], [2], [3.0], [1], False)], OUT), 1)     # only item 1 is touched
    assert sorted(map(tuple, sink.lists(spark).collect())) == [(1, 2, 0.5), (2, 1, 0.5)]
    with pytest.raises(FileNotFoundError):
        ST.SimilaritySink(os.path.join(scratch, "elsewhere"))(spark.createDataFrame([], OUT), 7)


def test_sink_replay_is_idempotent(spark, scratch):
    ev, pe = item_events(spark, SF_SMALL), pair_events(spark, SF_SMALL)
    ratings = (ev.withColumn("_n", F.row_number().over(SIM.Window.partitionBy("item").orderBy(F.desc("ts"), F.desc("id")))).where("_n <= 30")
               .groupBy("item").agg(*[F.collect_list(F.unix_micros(F.col("ts").cast("timestamp")) if c == "ts" else F.col(c).cast(t)).alias(n)
                                      for c, n, t in (("ts", "ts_us", ""), ("id", "ids", "long"), ("rating", "ratings", "double"))]))
    pairs = SIM.recent_partner_scores(pe).groupBy("item").agg(F.collect_list("partner").alias("partners"), F.collect_list("score").alias("scores"),
                                                               F.collect_list("n").alias("ns"))
    batch = ratings.join(pairs, "item").select("item", F.lit(0).alias("salt"), "ts_us", "ids", "ratings", "partners", "scores", "ns", F.lit(False).alias("gone"))
    sink = ST.SimilaritySink(os.path.join(scratch, "sink"), buckets=4)
    read = lambda: sorted(map(tuple, sink.lists(spark).collect()))
    sink(batch, 0)
    first = read()
    sink(batch, 0)          # replay of batch 0
    assert read() == first and len(first) > 0
    sink(batch.where("item % 50 = 0"), 1)
    # a gap in batch ids: batch 4 builds on batch 1, not on an empty state
    sink(batch.where("item % 50 = 0"), 4)
    again = read()
    assert {i for i, _, _ in again} == {i for i, _, _ in first}
    assert max(len([1 for i, _, _ in again if i == k]) for k in {i for i, _, _ in again}) <= SIM.NEIGHBOURS


def test_prune_rule(spark):
    sims = spark.createDataFrame([(1, 2, 1000, 0.1), (1, 3, 1, 0.1), (4, 5, 1000, 0.1)],
                                 "item_i long, item_j long, n_ij long, sim double")
    lists = spark.createDataFrame([(1, 9, 0.5), (1, 8, 0.6)], "item long, neighbour long, sim double")
    kept = {(r.item_i, r.item_j) for r in SIM.hoeffding_prune(sims, lists).collect()}
    # (1,2): eps ~ 0.005 < 0.5 - 0.1 -> dropped; (1,3): eps ~ 0.16 < 0.4 -> dropped; (4,5): no list -> kept
    assert kept == {(4, 5)}


def test_stream_through_similarity_sink(spark, scratch):
    ev, pe = item_events(spark, SF_SMALL), pair_events(spark, SF_SMALL)
    rows = ST.stream_rows(ev, pe)
    src = os.path.join(scratch, "in")
    rows.where("kind = 'rating'").coalesce(8).write.mode("append").parquet(src)
    rows.where("kind = 'pair'").coalesce(8).write.mode("append").parquet(src)
    sink = ST.SimilaritySink(os.path.join(scratch, "sink"), buckets=4)
    run(spark, scratch, None, sink, lateness_ms=YEARS)
    lists = sink.lists(spark)
    assert lists.count() > 0
    assert lists.groupBy("item").count().agg(F.max("count")).collect()[0][0] <= SIM.NEIGHBOURS
    # every listed pair is one that either item's state holds
    listed = sink.table(spark, "parts").read().select("item", F.explode("partners").alias("neighbour"))
    partners = listed.union(listed.select("neighbour", "item"))
    assert lists.join(partners, ["item", "neighbour"], "left_anti").count() == 0
    counts = {r.item: r.cnt for r in sink.table(spark, "items").read().collect()}
    assert {r.item: r.cnt for r in SIM.recent_item_counts(ev).collect()}.items() <= counts.items()


def test_state_function_makes_one_frame_per_changed_key(monkeypatch):
    """It is called for every key of every batch: no frames are made, sorted or joined on the way."""
    upd = ST._make_update(2, 2, ttl_ms=1000)
    base = {"item": 1, "id": None, "rating": None, "partner": None, "score": None, "n": None, "first_us": None}
    rows = pd.DataFrame([dict(base, kind="rating", ts_us=k, id=k, rating=r) for k, r in ((1, 4.0), (2, None), (3, 5.0))]
                        + [dict(base, kind="pair", ts_us=2, partner=p, score=s, n=1) for p, s in ((7, 1.0), (8, 2.0), (7, 1.5), (9, 0.5))])
    made, plain = [], pd.DataFrame.__init__
    monkeypatch.setattr(pd.DataFrame, "__init__", lambda self, *a, **k: made.append(1) or plain(self, *a, **k))
    st = _State()
    for n in (1, 2):
        made.clear()
        out = list(upd((1, 0), [rows], st))
        assert len(made) == len(out) == 1
    assert out[0]["ids"][0] == [3, 3] and out[0]["partners"][0] == [7, 8] and out[0]["scores"][0] == [5.0, 4.0] and out[0]["ns"][0] == [4, 2]
    assert st.timer == 1000


def test_a_bucket_of_keys_does_as_its_keys(spark, scratch):
    """One call and one stored state for many keys; each keeps its own lists, time to go and start afresh."""
    rnd, keys = random.Random(4), [(i, s) for i in range(6) for s in range(2)]
    one, many = ST._make_update(3, 2, ttl_ms=1000), ST._make_buckets(3, 2, ttl_ms=1000)
    states, bucket, mark = {k: _State() for k in keys}, _State(), 0
    as_rows = lambda frames: sorted(str(tuple(r)) for f in frames for r in f.itertuples(index=False))
    for _ in range(60):
        now = mark * 1000 + rnd.randint(0, 900_000)
        rows = []
        for item, salt in rnd.sample(keys, rnd.randint(0, 4)):
            kind = rnd.choice(["rating", "pair", "touch"])
            rows += [{"item": item, "salt": salt, "kind": kind, "ts_us": now + k, "first_us": now if kind == "touch" else None, "id": rnd.randint(1, 9) if kind == "rating" else None,
                      "rating": rnd.choice([1.0, 2.5, None]) if kind == "rating" else None, "partner": rnd.randint(1, 5) if kind == "pair" else None,
                      "score": 1.5 if kind == "pair" else None, "n": 1 if kind == "pair" else None} for k in range(rnd.randint(1, 5))]
        for st in (*states.values(), bucket):
            st.getCurrentWatermarkMs = lambda w=mark: w
        frame = pd.DataFrame(rows, columns=["item", "salt", "kind", "ts_us", "first_us", "id", "rating", "partner", "score", "n"])
        want = []
        for k, st in states.items():
            own = frame[(frame["item"] == k[0]) & (frame["salt"] == k[1])]
            st.hasTimedOut = not len(own) and st.exists and st.timer < mark
            if len(own) or st.hasTimedOut:
                want += list(one(k, [own], st))
        bucket.hasTimedOut = not rows and bucket.exists and bucket.timer < mark
        got = list(many((0,), [frame.iloc[:3], frame.iloc[3:]] if len(rows) > 3 else [frame], bucket)) if rows or bucket.hasTimedOut else []
        assert as_rows(got) == as_rows(want) and len(got) <= 1
        assert bucket.exists == any(s.exists for s in states.values())
        mark += rnd.choice([0, 100, 700])
    ev, pe = events(spark, *small_world())
    q = run(spark, scratch, ST.stream_rows(ev, pe), buckets=3)
    assert state_rows(q) == 3 and state_of(spark, scratch) == twins(ev, pe)      # 160 keys
