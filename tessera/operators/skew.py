"""Skew-resistant joins and aggregation.

Salts are deterministic hashes of the row, never ``rand()``: a re-run task
after an executor loss gives every row the same salt again, so a retried
stage can neither duplicate nor lose join partners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import shared_table, stored_once

# Fixed values from the reference's recipes: 100 copies, 10 % sample.
DEFAULT_COPIES = 100
DEFAULT_SAMPLE = 0.1
#: Rows of one side that meet in one cell of a sized join: at most this squared pairs.
PIECE_ROWS = 4096
#: Rows of a join's or an aggregate's side that one task sorts or hashes.
TASK_ROWS = 1 << 20


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def row_salt(df: DataFrame, n, seed: int = 17) -> Column:
    """Salt in [0, n) from the row's content and its partition.

    Repeatable when a task is retried (no row counter, no random number); the
    partition spreads identical rows, which would otherwise share one salt.
    """
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.xxhash64(F.lit(seed), F.spark_partition_id(), *[F.col(c) for c in df.columns]), n).cast("int")


def tasks_for(spark, rows: int) -> int | None:
    """Partitions for ``rows`` rows, about ``TASK_ROWS`` each; None if one task holds them all (left to the planner).

    The planner counts packed bytes: what it takes for one task's share may be a gigabyte once it is
    sorted and hashed, and grows with the table as long as the number of its partitions does not."""
    return max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism) if rows > TASK_ROWS else None


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` by hash of the keys in ``tasks`` partitions (None: as it is)."""
    return df if tasks is None else df.repartition(tasks, *keys)


def heavy_keys(df: DataFrame, key, fraction: float = DEFAULT_SAMPLE, top: int = 1,
               seed: int = 7, min_count: int = 1) -> DataFrame:
    """Most frequent keys of a Bernoulli sample: at most ``top`` rows.

    ``min_count`` drops keys seen fewer times in the sample.  The output
    size is bounded by ``top`` whatever the data, so it may be broadcast.
    The count is a partial hash aggregate; the top is a TakeOrdered.
    """
    ks = _keys(key)
    s = df.select(*ks).sample(withReplacement=False, fraction=fraction, seed=seed)
    counts = s.groupBy(*ks).agg(F.count(F.lit(1)).alias("sample_n"))
    if min_count > 1:
        counts = counts.where(F.col("sample_n") >= min_count)
    return counts.orderBy(F.desc("sample_n"), *ks).limit(top)


def heavy_hitters(df: DataFrame, key, share: int) -> DataFrame:
    """Every key with more than ``1 / share`` of all rows, with its exact count -> ``(*key, n, total)``.

    Pass 1 is one aggregate of a mergeable frequent-items summary (of a hash of the key) and the row
    count: each task sends a summary of bounded size, and no key is shuffled.  It tracks ``16 * share``
    items, so a count is off by less than a sixth of the share: fewer than ``1.2 * share`` items can look as
    frequent as a key above it, and the best ``2 * share`` hold every such key.  Pass 2 counts the
    candidates' rows exactly (a join with at most ``2 * share`` broadcast hashes).  No key above the
    share is missed and none below it is returned, so fewer than ``share`` rows come out.
    """
    ks = _keys(key)
    rows = df.select(*ks, F.xxhash64(*ks).alias("_h"))
    seen = rows.agg(F.expr(f"approx_top_k_accumulate(_h, {16 * share})").alias("_s"), F.count(F.lit(1)).alias("total"))
    best = (seen.select("total", F.explode(F.expr(f"approx_top_k_estimate(_s, {2 * share})")).alias("_i"))
            .select("total", F.col("_i.item").alias("_h")))
    counts = rows.join(F.broadcast(best), "_h").groupBy(*ks, "total").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") * F.lit(int(share)) > F.col("total")).select(*ks, "n", "total")


def heavy_by_share(df: DataFrame, key, share: int, fraction: float = DEFAULT_SAMPLE, seed: int = 7) -> DataFrame:
    """Keys holding more than ``1 / share`` of a Bernoulli sample (of all rows at ``fraction`` 1).

    The total is a scalar subquery of the same plan (no driver action, no
    cross join).  Counts sum to the total, so fewer than ``share`` keys
    qualify: a proven bound for the broadcast in ``salted_join``.
    """
    ks = _keys(key)
    rows = df.select(*ks)
    rows = rows if fraction >= 1 else rows.sample(withReplacement=False, fraction=fraction, seed=seed)
    counts = rows.groupBy(*ks).agg(F.count(F.lit(1)).alias("_cnt"))
    total = counts.select(F.sum("_cnt")).scalar()
    return counts.where(F.col("_cnt") * F.lit(int(share)) > total).select(*ks)


def salted_join(left: DataFrame, right: DataFrame, key, heavy: DataFrame | None,
                left_split: int, right_split: int = 1, how: str = "inner",
                heavy_all: bool = False) -> DataFrame:
    """Equi-join on ``key`` that spreads heavy keys over a grid of tasks.

    Rows of a heavy key get a salt pair (a, b): a left row owns
    ``a = hash % left_split`` and is copied for every b in [0, right_split);
    a right row owns ``b = hash % right_split`` and is copied for every a.
    Each (key, a, b) cell pairs exactly one left part with one right part,
    so every matching pair meets exactly once and a heavy key's work is
    split over ``left_split * right_split`` tasks.  Other keys keep
    a = b = 0 and are not copied.

    ``heavy`` is a bounded table of heavy keys (see ``heavy_keys``) and is
    broadcast; ``heavy_all=True`` salts every key (J8).  ``how`` is
    'inner' or 'left' (left rows are never copied more than
    ``right_split`` times and each copy meets disjoint right parts, so an
    unmatched left row appears once per copy: only 'inner' is allowed when
    ``right_split > 1``).
    """
    ks = _keys(key)
    if how != "inner" and right_split > 1:
        raise ValueError("outer salted join needs right_split == 1")
    if heavy_all:
        lflag = F.lit(True)
        rflag = F.lit(True)
        l, r = left, right
    else:
        h = F.broadcast(heavy.select(*ks).distinct().withColumn("_heavy", F.lit(True)))
        l = left.join(h, ks, "left")
        r = right.join(h, ks, "left")
        lflag = F.coalesce(F.col("_heavy"), F.lit(False))
        rflag = lflag
    l = (l.withColumn("_a", F.when(lflag, row_salt(left, left_split)).otherwise(F.lit(0)))
          .withColumn("_b", F.explode(F.when(lflag, F.sequence(F.lit(0), F.lit(right_split - 1)))
                                      .otherwise(F.array(F.lit(0))))))
    r = (r.withColumn("_b", F.when(rflag, row_salt(right, right_split)).otherwise(F.lit(0)))
          .withColumn("_a", F.explode(F.when(rflag, F.sequence(F.lit(0), F.lit(left_split - 1)))
                                      .otherwise(F.array(F.lit(0))))))
    if not heavy_all:
        l, r = l.drop("_heavy"), r.drop("_heavy")
    elif left_split > 1:
        r = r.hint("merge")      # the planner's estimate leaves out the copies: it would broadcast all of them
    return l.join(r, ks + ["_a", "_b"], how).drop("_a", "_b")


def sized_join(left: DataFrame, right: DataFrame, key, piece_rows: int = PIECE_ROWS, count: str = "both",
               tasks: int | None = None) -> DataFrame:
    """Inner equi-join in cells sized by their work: every cell holds at most about
    ``piece_rows`` rows of a counted side.

    A key with n rows on a side is cut into ceil(n / piece_rows) pieces of that
    side, and the other side's rows of the key go to each of them, so a hot
    key takes as many cells as its pairs need; an ordinary key has one cell.
    One join serves all keys.  A counted side is read twice, for its counts and for the
    join, so one that is more than a scan is stored first.  ``count``: 'both', 'left' (only that side is cut)
    or 'self' (both sides have the same keys, counted once).  The table of cut
    keys is written first, so the planner knows its size when it chooses
    between broadcasting and shuffling it.  ``tasks``: the join's partitions (see ``tasks_for``).
    """
    ks = _keys(key)

    def cut(df, name):
        return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows)
                .select(*ks, F.ceil(F.col("_n") / piece_rows).cast("int").alias(name)))
    if count != "self":           # callers of a self-join store its one table themselves
        left = stored_once(left, "sized-left")
        right = stored_once(right, "sized-right") if count == "both" else right
    cuts = cut(left, "_pl")
    if count == "both":
        cuts = cuts.join(cut(right, "_pr"), ks, "full")
    else:
        cuts = cuts.withColumn("_pr", F.col("_pl") if count == "self" else F.lit(1))
    cuts = shared_table(cuts, "cut-keys")
    pl, pr = F.coalesce("_pl", F.lit(1)), F.coalesce("_pr", F.lit(1))
    l = (left.withColumns({"_sl": row_salt(left, 1 << 30)}).join(cuts, ks, "left")
         .withColumn("_a", F.pmod("_sl", pl)).withColumn("_b", F.explode(F.sequence(F.lit(0), pr - 1))).drop("_sl", "_pl", "_pr"))
    r = (right.withColumns({"_sr": row_salt(right, 1 << 30, seed=18)}).join(cuts, ks, "left")
         .withColumn("_b", F.pmod("_sr", pr)).withColumn("_a", F.explode(F.sequence(F.lit(0), pl - 1))).drop("_sr", "_pl", "_pr"))
    on = ks + ["_a", "_b"]
    return dealt(l, tasks, *on).join(dealt(r, tasks, *on), on).drop("_a", "_b")


def skew_split_join(big: DataFrame, small: DataFrame, key, copies: int = DEFAULT_COPIES,
                    fraction: float | None = None, seed: int = 7) -> DataFrame:
    """Detect the heavy keys (more than 1/copies of the rows of ``big``), salt them over
    ``copies`` tasks (small side copied exactly ``copies`` times), join the rest normally.
    Result equals ``big.join(small, key)``.

    Keys are found by ``heavy_hitters``, which misses none; a ``fraction`` asks for the
    10 % recipe's Bernoulli sample instead.
    """
    heavy = (heavy_hitters(big, key, copies).select(*_keys(key)) if fraction is None
             else heavy_by_share(big, key, copies, fraction=fraction, seed=seed))
    return salted_join(big, small, key, heavy, left_split=copies, right_split=1)


def replicated_salt_join(big: DataFrame, small: DataFrame, key,
                         copies: int = DEFAULT_COPIES) -> DataFrame:
    """No detection; every ``big`` row is salted and ``small`` is copied
    ``copies`` times.  Result equals ``big.join(small, key)``.
    """
    return salted_join(big, small, key, None, left_split=copies, right_split=1, heavy_all=True)


def salted_count(df: DataFrame, key, salts: int = DEFAULT_COPIES, name: str = "n") -> DataFrame:
    """Count per key in two stages: per (key, salt), then per key.

    Each row draws its own salt (the reference draws one for all rows).
    """
    ks = _keys(key)
    stage1 = (df.select(*ks, row_salt(df, salts).alias("_salt"))
              .groupBy(*ks, "_salt").agg(F.count(F.lit(1)).alias("_n")))
    return stage1.groupBy(*ks).agg(F.sum("_n").alias(name))
