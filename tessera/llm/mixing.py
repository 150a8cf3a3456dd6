"""Operator 7: mixing sources to target weights at an exact word budget.

Every document gets a hash-random key (MD5 of its id).  Inside a source the keys
are spread evenly, so key ranges of about ``RANGE_ROWS`` rows are known without
sampling; word sums per range, prefix-summed over blocks of ``BLOCK_RANGES`` ranges and then inside one,
name the range in which the budget ends, and a prefix sum over that range's different (key, size)
names the rows of one key and size in which it does.  Those are interchangeable, and may be as many as all rows (of one
id): a distributed position by row id finds the one to cut.  All
rows are then compared with their source's cut, so no source and no id meets in one task
however large it is.  A budget above the source's size repeats whole epochs; the
last epoch ends at the cut, inside one document if need be.

Targets: the sources, in code point order with null last, share ``share`` times
all words by the weights, repeating; a target stops at ``MOST`` times its source
and the excess goes to the rest by weight until none is above.

Defined cases: null text has no words; a null source is a source.  Documents
without words are taken 0 words (and, in ``mix``, as often as whole epochs pass,
and once more if they precede the cut).  Repeated rows each count.  Empty table
or no words at all: targets 0.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import fresh, materialize, text_groups, utf8, word_blocks
from tessera.operators.ranking import position_in_key

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)       # 150 % of all words, as a fraction
MOST = 2
SEED = "mix-1"
RANGE_ROWS = 1 << 13
BLOCK_RANGES = 1 << 12


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """Number of [^\\x20\\x09-\\x0D]+ words."""
    return pa.array([sum(len(b.split()) for b in word_blocks(t)) for _, g in text_groups(texts) for t in g], pa.int64())


def _first_words(data: bytes, n: int) -> bytes:
    """``data`` up to the end of its n-th word."""
    at = 0
    for block in word_blocks(data):
        have = len(block.split())
        if n <= have:
            rest = block.split(None, n)
            tail = rest[n] if len(rest) > n else b""
            return data[:at + len(block) - len(tail)].rstrip(b"\x20\t\n\x0b\x0c\r")
        n, at = n - have, at + len(block)
    return data


@F.arrow_udf(T.StringType())
def first_words(texts: pa.Array, counts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _first_words(t, n).decode() for t, n in zip(utf8(texts), counts.to_pylist())],
                    pa.string())


def _key(doc_id):
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """sources(source, source_size, ...) -> and target (double), budget (whole words)."""
    ranked = position_in_key(sources.withColumn("_all", F.lit(0)).withColumn("_none", F.col("source").isNull()),
                             "_all", ["_none", "source"], name="_place").drop("_all", "_none")
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    ranked = materialize(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
                         .drop("_place"), "sources")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    total = ranked.agg(F.sum(wide("source_size")), F.sum("weight")).first()
    words, num, den = int(total[0] or 0), 0, max(1, int(total[1] or 0)) * share[1]
    num = share[0] * words
    while True:
        # every round tops more sources; the level num / den (words per unit of weight) only rises
        top = wide("weight") * F.lit(num).cast("decimal(38,0)") > wide("source_size") * F.lit(MOST * den).cast("decimal(38,0)")
        full = ranked.agg(F.sum(F.when(top, wide("source_size"))), F.sum(F.when(~top, F.col("weight")))).first()
        after = (share[0] * words - share[1] * MOST * int(full[0] or 0), share[1] * int(full[1] or 0) or 1)
        if after == (num, den):
            break
        num, den = after
    level = F.lit(num).cast("double") if num.bit_length() > 60 else F.lit(num).cast("long")
    share_of = F.col("weight") * level
    return ranked.select(
        "*", F.when(top, (F.col("source_size") * MOST).cast("double"))
        .otherwise(share_of.cast("double") / F.lit(float(den))).alias("target"),
        F.when(top, F.col("source_size") * MOST)
        .otherwise(F.floor(wide("weight") * F.lit(num).cast("decimal(38,0)") / F.lit(den).cast("decimal(38,0)")).cast("long"))
        .alias("budget"))


def _end_of(sums: DataFrame, order: list[str], start: Column) -> DataFrame:
    """Of sums (source, words, rest, ...) in order, per source the row in which the budget ends, with the words ``before`` it."""
    w = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = start + F.coalesce(F.sum("words").over(w), F.lit(0))
    return sums.withColumn("before", before).where("before <= rest and rest < before + words")


def _beside(ends: DataFrame, name: str) -> DataFrame:
    """Ends under names that clash with no row's: one row per source."""
    return ends.select(F.col("source").alias("_s1"), F.col(name).alias(f"_{name}"), F.col("before").alias("_before"))


def source_cuts(rows: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """rows(rid, source, size, key) -> per source: source_size, target, epochs, cut row, words of the cut row."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    goals = (source_targets(sources, weights, share)
             .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
             .withColumn("rest", F.when(F.col("source_size") > 0, F.col("budget") % F.col("source_size")).otherwise(F.lit(0)))
             .withColumn("_ranges", F.ceil(F.col("_rows") / RANGE_ROWS)))
    goals = materialize(goals, "goals")
    where = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("_ranges") / F.lit(1 << 32)).cast("long")
    ranged = rows.join(goals.select(F.col("source").alias("_s"), "rest", "_ranges"), F.col("source").eqNullSafe(F.col("_s"))) \
        .withColumn("range", where)
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    sums = materialize(sums.withColumn("block", F.expr(f"range div {BLOCK_RANGES}")), "range-words")
    # the block of ranges in which the budget ends, then the range, then the rows of one key and size
    blocks = _end_of(sums.groupBy("source", "block").agg(F.sum("words").alias("words"), F.first("rest").alias("rest")), ["block"], F.lit(0))
    inside = sums.join(_beside(blocks, "block"), F.col("source").eqNullSafe(F.col("_s1")) & (F.col("block") == F.col("_block")))
    ends = _end_of(inside, ["range"], F.col("_before"))
    inside = ranged.select("source", "range", "key", "size", "rest", "rid").join(
        _beside(ends, "range"), F.col("source").eqNullSafe(F.col("_s1")) & (F.col("range") == F.col("_range")))
    alike = (inside.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"), F.first("_before").alias("_before"))
             .withColumn("words", F.col("n") * F.col("size")))
    group = _end_of(alike, ["key", "size"], F.col("_before")).select(
        F.col("source").alias("_s1"), F.col("key").alias("_key"), F.col("size").alias("_size"),
        F.expr("(rest - before) div size").alias("whole"), ((F.col("rest") - F.col("before")) % F.col("size")).alias("cut_words"))
    # of such rows, which may all be of one id, the one behind those that are taken whole
    rows_of = (rows.join(group, F.col("source").eqNullSafe(F.col("_s1")) & (F.col("key") == F.col("_key")) & (F.col("size") == F.col("_size")))
               .select("source", "key", "size", "rid", "whole", "cut_words"))
    cut = (position_in_key(rows_of, "source", "rid", name="_nth").where(F.col("_nth") == F.col("whole") + 1)
           .select(F.col("source").alias("_s"), F.struct("key", "size", "rid").alias("cut"), "cut_words"))
    return goals.join(cut, goals["source"].eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "epochs", "cut", "cut_words")


def _rows(docs: DataFrame) -> DataFrame:
    return materialize(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source",
                                   word_count(F.col("text")).alias("size"), _key("doc_id").alias("key")), "words")


def mix_report(docs: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = _rows(docs)
    cuts = materialize(source_cuts(rows, weights, share), "cuts").withColumnRenamed("source", "_source")
    me = F.struct("key", "size", "rid")
    part = F.when(me < F.col("cut"), F.col("size")).when(me == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0))
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.coalesce(part, F.lit(0))).cast("long").alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """The mix itself: each row once per epoch that takes it, the cut row's last copy cut after its words."""
    cuts = materialize(source_cuts(_rows(docs), weights, share), "cuts")
    rid, size, cut, words, n = (fresh(docs, x) for x in ("rid", "size", "cut", "words", "copy"))
    goal = cuts.select(F.col("source").alias(fresh(docs, "src")), F.col("epochs").alias(n), F.col("cut").alias(cut),
                       F.col("cut_words").alias(words))
    me = F.struct(F.lower(_key("doc_id")).alias("key"), F.col(size).alias("size"), F.col(rid).alias("rid"))
    keyed = (docs.withColumn(rid, F.monotonically_increasing_id()).withColumn(size, word_count(F.col("text")))
             .join(goal, F.col("source").eqNullSafe(F.col(fresh(docs, "src")))))
    last = F.when(me < F.col(cut), F.lit(-1)).when((me == F.col(cut)) & (F.col(words) > 0), F.col(words))
    copies = F.array_compact(F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col(n).cast("int")), F.array(last.cast("long"))))
    dealt = keyed.withColumn(words, F.explode(copies))
    text = F.when(F.col(words) < 0, F.col("text")).otherwise(
        first_words(F.when(F.col(words) >= 0, F.col("text")), F.col(words)))
    return dealt.withColumn("text", text).select(*docs.columns)
