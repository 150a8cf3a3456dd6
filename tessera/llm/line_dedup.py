"""Operator 3: line dedup by winnowing over line hashes, DataFrame functions only.

* Lines are the pieces of a text between line feeds; each is a pair of 64-bit
  hashes.  A window is a stretch of ``MIN_LINES`` lines, or of fewer that have
  ``MIN_WORDS`` words (a text too short for either is one window).
* Every window selects its fingerprint: the rightmost line with the least hash.  Equal
  stretches select the same line wherever they stand, so every repeated stretch has a
  fingerprint at two positions or more.  Windows whose fingerprint stands at one position only
  are done with after one partial aggregate of (hash, position).
* Positions of the remaining windows are joined to the first one with the same fingerprint and the
  same window content.  The content is in the key because the first text that has a *line* need not be the
  one that has the passage; with it a passage meets a text that has it, whichever that is.
* Matches on one diagonal (later text, first text, distance) are extended both ways: the windows before and
  after a match are matched too as long as the lines agree, so neighbouring and overlapping matches grow into
  one run, up to the line that differs, or from which on an even earlier text has the rest.
* Lines in a run that stands earlier (smaller doc_id, then earlier row, then
  earlier line) are deleted: all lines of every repeated run of ``MIN_LINES`` lines or ``MIN_WORDS`` words.

Only hashes are joined; a hot passage is one row per task after the partial
aggregate, and its occurrences meet one row each.  A diagonal has at most the lines of one text.

Defined cases: null text stays null, an empty text is one empty line.  A null
doc_id comes after all others.  Repeated rows count as later copies of the
first.  Row ids follow the scan, so ``docs`` must be read from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import fresh, materialize

MIN_LINES = 3
MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """One narrow row per line: rid, doc_id, pos, h1, h2, words."""
    split = docs.where(F.col("text").isNotNull()).select("rid", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    blank = r"[^\x20\x09-\x0D]+"
    return split.select("rid", "doc_id", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("~"), "line").alias("h2"),
                        F.regexp_count("line", F.lit(blank)).alias("words"))


def windows(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """rid, doc_id, pos, size (lines), k1, k2 (content), fp and at (least line hash and its rightmost position)."""
    w = Window.partitionBy("rid").orderBy("pos")
    nxt = [F.struct(*[F.lead(c, i).over(w).alias(c) for c in ("h1", "h2", "words")]) if i else
           F.struct("h1", "h2", "words") for i in range(min_lines)]
    rows = lines.select("rid", "doc_id", "pos", *[x.alias(f"l{i}") for i, x in enumerate(nxt)],
                        F.count(F.lit(1)).over(Window.partitionBy("rid")).alias("n"))
    have = sum((F.col(f"l{i}.h1").isNotNull().cast("int") for i in range(1, min_lines)), F.lit(1))
    sizes, total = [], F.lit(0)
    for i in range(min_lines):
        total = total + F.coalesce(F.col(f"l{i}.words"), F.lit(0))
        full = (F.lit(i + 1) == min_lines) | (total >= min_words)
        sizes.append(F.when(full & (have > i), F.lit(i + 1)))
    # the whole of a short text
    short = F.when(F.col("pos") == 0, F.col("n").cast("int"))
    fit = F.array_compact(F.array(*sizes))
    rows = rows.withColumn("size", F.explode(F.when(F.size(fit) > 0, fit).otherwise(F.array_compact(F.array(short)))))
    held = [[F.when(F.col("size") > i, F.col(f"l{i}.{h}")) for i in range(min_lines)] for h in ("h1", "h2")]
    rows = rows.withColumn("fp", F.least(*held[0]) if min_lines > 1 else F.col("l0.h1"))
    at = F.coalesce(*[F.when((F.col("size") > i) & (F.col(f"l{i}.h1") == F.col("fp")), F.col("pos") + i) for i in reversed(range(min_lines))])
    return rows.select("rid", "doc_id", "pos", "size", F.xxhash64("size", *held[0]).alias("k1"), F.xxhash64("size", *held[1]).alias("k2"),
                       "fp", at.alias("at"))


def matches(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(rid, pos, size, at, first): windows that stand earlier, with the place of their first occurrence."""
    wins = materialize(windows(lines, min_lines, min_words), "windows")
    spot = F.struct("rid", "at")
    twice = wins.groupBy("fp").agg(F.min(spot).alias("a"), F.max(spot).alias("z")).where("a <> z").select("fp")
    held = wins.join(twice, "fp", "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "pos", "at")
    first = held.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    return (held.join(first, ["k1", "k2"]).where((F.col("rid") != F.col("first.rid")) | (F.col("pos") != F.col("first.pos")))
            .select("rid", "pos", "size", "at", "first"))


def runs(found: DataFrame) -> DataFrame:
    """(rid, start, stop): matches of one diagonal grown together while they touch or overlap."""
    line = found.select("rid", "pos", (F.col("pos") + F.col("size")).alias("stop"), F.col("first.rid").alias("src"),
                        (F.col("first.at") - F.col("at")).alias("off"))
    w = Window.partitionBy("rid", "src", "off").orderBy("pos", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("pos") > reach), 1).otherwise(0)
    run = F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (line.withColumn("opens", opens).withColumn("run", run).groupBy("rid", "src", "off", "run")
            .agg(F.min("pos").alias("start"), F.max("stop").alias("stop")).select("rid", "start", "stop"))


def repeated_lines(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """rid, pos of every line to delete."""
    return (runs(matches(lines, min_lines, min_words))
            .select("rid", F.explode(F.sequence("start", F.col("stop") - 1)).alias("pos")).distinct())


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text that stays, and the counts ``lines`` and ``deleted`` (replacing columns of these names)."""
    rid, mask = fresh(docs, "rid"), fresh(docs, "mask")
    docs = docs.drop("lines", "deleted").withColumn(rid, F.monotonically_increasing_id())
    lines = materialize(_lines(docs.select(F.col(rid).alias("rid"), "doc_id", "text")), "lines")
    gone = materialize(repeated_lines(lines, min_lines, min_words), "repeated")
    # one mask per text that loses lines: as long as its lines, so the text is filtered in one pass
    hit = lines.join(gone.select("rid").distinct(), "rid", "left_semi").select("rid", "pos")
    marks = hit.join(gone.withColumn("gone", F.lit(True)), ["rid", "pos"], "left").groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("gone", F.lit(False)).alias("gone")))).alias("m"))
    marks = marks.select(F.col("rid").alias(rid), F.col("m.gone").alias(mask))
    joined = docs.join(marks, rid, "left")
    split = F.split("text", "\n", -1)
    kept = F.filter(split, lambda x, i: ~F.get(F.col(mask), i))
    cols = [F.when(F.col(mask).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text")
            if c.lower() == "text" else F.col(c) for c in docs.columns if c != rid]
    count = lambda a: F.coalesce(F.size(a), F.lit(0)).cast("long")
    return joined.select(*cols, F.when(F.col("text").isNull(), F.lit(0)).otherwise(count(split)).cast("long").alias("lines"),
                         F.when(F.col(mask).isNull(), F.lit(0)).otherwise(
                             F.size(F.filter(F.col(mask), lambda x: x))).cast("long").alias("deleted"))


def line_report(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, lines, deleted, kept_sha256 (of the text that stays, null text as empty)."""
    return dedup_lines(docs.select("doc_id", "text"), min_lines, min_words).select(
        "doc_id", "lines", "deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
