"""Operator 8: exact dedup through an extendible-hash index, DataFrame functions only.

* ``entries``: one narrow row per document (row id, doc_id, 64-bit hash and
  SHA-256 of the normalised text), written once to the shared folder.
* Directory: a slot per used prefix of the hashes.  It doubles (its prefixes grow by ``STEP`` bits) until no
  slot holds more than ``CAPACITY`` different hashes; a bucket is the shortest prefix that holds as many, so
  an overfull one has been split and sparse ones share slots.  Its depth follows the hashes alone, up to all 64 bits.
* Every entry looks its bucket up in the directory.  A bucket has one owner task, which counts the entries of
  each hash; a hash with one entry is a text of its own.
* Of hashes with more entries the texts themselves come to the owner, equal ones combined before the shuffle
  (a hot group of copies is one row per task).  Texts of other hashes are not moved as long as the list of
  repeated hashes is small enough for the planner to broadcast it.  The owner compares bytes: the different texts of one hash are
  chained in their order, and each has its copies counted and its kept row chosen.
* The index (bucket, hash, chain place, digest, kept row, copies) is a table on the shared folder; every
  document probes it by these three.  A document's place is 1 unless its hash has a longer chain; then it is
  the place of the text with the document's bytes.

Defined cases: null text counts as empty.  Of rows with the largest doc_id of
their group (repeated rows) the last read is kept; a null doc_id is smaller than
all others, and a group of only null ids keeps its last row and has a null
keep_id.  Empty table: no rows.  Row ids follow the scan, so ``docs`` must be
read from files (as tables are), not from an unordered computation.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import fresh, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CAPACITY = 4096
STEP = 4

Hash = Callable[[Column], Column]


def normalise(text: Column) -> Column:
    """A-Z lower-cased, every other character kept; null becomes empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike(r"[^\x00-\x7F]"), F.translate(t, UPPER, LOWER)).otherwise(F.lower(t))


def slot_of(depth: int, h: str = "h") -> Column:
    """The first ``depth`` bits of a hash as text."""
    return F.substring(F.lpad(F.bin(F.col(h)), 64, "0"), 1, depth) if depth else F.lit("")


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """hashes(h), all different -> (slot, bucket) of every used slot, and the directory's depth."""
    n = hashes.count()
    least = max(0, math.ceil(math.log2(n / capacity)) - STEP) if n > capacity else 0
    depth = least
    while True:
        slots = hashes.groupBy(slot_of(depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        if depth == 64 or (slots.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        depth = min(64, depth + STEP)
    prefixes = slots.select("slot", "n", F.explode(F.sequence(F.lit(least), F.lit(depth))).alias("bits"))
    prefixes = prefixes.select("slot", "n", "bits", F.expr("substring(slot, 1, bits)").alias("bucket"))
    fits = prefixes.groupBy("bits", "bucket").agg(F.sum("n").alias("held")).where((F.col("held") <= capacity) | (F.col("bits") == depth))
    found = prefixes.join(fits, ["bits", "bucket"]).groupBy("slot").agg(F.min_by("bucket", "bits").alias("bucket"))
    return found, depth


def _texts(docs: DataFrame, hash_of: Hash) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", normalise(F.col("text")).alias("norm"))
    return rows.select("rid", "doc_id", "norm", hash_of(F.col("norm")).alias("h"))


def build_index(docs: DataFrame, capacity: int = CAPACITY, hash_of: Hash = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """(entries, index): rid, doc_id, sha, bucket, h, chain per document; and one row per different text:
    bucket, h, chain, sha, keep_id, keep_rid, copies."""
    entries = materialize(_texts(docs, hash_of).select("rid", "doc_id", "h", F.sha2("norm", 256).alias("sha")), "entries")
    slots, depth = directory(materialize(entries.select("h").distinct(), "hashes"), capacity)
    slots = materialize(slots, "directory")        # written, so that its size decides how it is joined
    entries = entries.withColumn("slot", slot_of(depth)).join(slots, "slot").drop("slot")
    # the owner of a bucket: entries per hash, and for hashes with several the different texts, chained
    owned = materialize(entries.groupBy("bucket", "h").agg(F.count(F.lit(1)).alias("rows"), F.max(F.struct("doc_id", "rid", "sha")).alias("last")), "owned")
    several = materialize(owned.where("rows > 1").select("bucket", "h"), "repeated-hashes")    # written, as the directory is
    texts = (_texts(docs, hash_of).join(several, "h").groupBy("bucket", "h", "norm")
             .agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("doc_id", "rid")).alias("last")))
    chain = F.row_number().over(Window.partitionBy("bucket", "h").orderBy("norm"))
    length = F.count(F.lit(1)).over(Window.partitionBy("bucket", "h"))
    chained = texts.withColumn("chain", chain).withColumn("length", length).select(
        "bucket", "h", "chain", F.sha2("norm", 256).alias("sha"), F.col("last.doc_id").alias("keep_id"), F.col("last.rid").alias("keep_rid"),
        "copies", F.when(F.col("length") > 1, F.col("norm")).alias("text"))
    lone = owned.where("rows = 1").select("bucket", "h", F.lit(1).alias("chain"), "last.sha", F.col("last.doc_id").alias("keep_id"),
                                          F.col("last.rid").alias("keep_rid"), F.col("rows").alias("copies"), F.lit(None).cast("string").alias("text"))
    index = materialize(chained.unionByName(lone), "hash-index")
    clashes = index.where("text is not null").select("h", "text", "chain")
    if clashes.isEmpty():
        placed = entries.withColumn("chain", F.lit(1))
    else:
        own = _texts(docs, hash_of).join(clashes, "h").where("norm = text").select("rid", "chain")
        placed = entries.join(own, "rid", "left").withColumn("chain", F.coalesce("chain", F.lit(1)))
    return placed, index.drop("text")


def exact_dedup_report(docs: DataFrame, capacity: int = CAPACITY, hash_of: Hash = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    entries, index = build_index(docs, capacity, hash_of)
    return entries.select("rid", "doc_id", "bucket", "h", "chain").join(index, ["bucket", "h", "chain"]).select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, hash_of: Hash = F.xxhash64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rid = fresh(docs, "rid")
    _, index = build_index(docs, capacity, hash_of)
    return (docs.withColumn(rid, F.monotonically_increasing_id())
            .join(index.select(F.col("keep_rid").alias(rid)), rid, "left_semi").drop(rid))
