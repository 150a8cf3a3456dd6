"""Nearest items without all pairs: an inverted index with norm bounds.

Exact cosine similarity of items (vectors over users), above a threshold or the k best.

Users have one order, the rarest first.  Of an item's entries in that order the *prefix* is the
shortest one whose rest has a norm below threshold x the item's norm.  Two items at or
above the threshold share a user of both prefixes: of their common users all in the shorter
prefix are in the longer one too, and those behind it add less than the threshold.  So

1. the index lists, per user, the items that have the user in their prefix; items that meet in
   a list are summed from packed lists (``cooccurrence.pair_meetings``: no shuffled row per meeting, and a user of
   very many items is cut into cells);
2. a pair's products over shared prefix users plus the norm of the rest of the item whose
   prefix ends first bound its similarity from above; pairs below the threshold go: first in the block that
   summed them, by both items' codes (norm and tail, rounded to the safe side), then by the numbers themselves;
3. the others lack only the users behind the prefix that ends first: these entries alone are looked up and added.

The frequent users, whose lists make most of the pairs, are in few prefixes.  Sums of squares
and the bounds are compared with a small margin, so rounding loses no pair.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.aggregates import top_k_per_key
from tessera.operators.cooccurrence import pair_meetings
from tessera.operators.matrix import mirror
from tessera.operators.ranking import position_in_key
from tessera.operators.skew import PIECE_ROWS
from tessera.session import shared_table

#: Bounds are widened by this share of themselves.
MARGIN = 1e-9
#: Threshold of the prefixes that give the k best their first bounds.
FIRST = 0.8


def entries(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """(u, it, r, nn, rest): stored entries with the item's sum of squares and that of the entries behind.

    ``rest`` is a running sum per item from the most frequent user backwards; an item's
    entries are numbered by ``position_in_key``, so an item of very many users is no single task's.
    Entries of 0 take no part.
    """
    r = (ratings.select(F.col(user).cast("long").alias("u"), F.col(item).cast("long").alias("it"), F.col(rating).cast("double").alias("r"))
         .where(F.col("r") != 0))
    r = shared_table(r, "item-entries")
    freq = r.groupBy("u").agg(F.count(F.lit(1)).alias("freq"))
    norms = r.groupBy("it").agg(F.sum(F.col("r") * F.col("r")).alias("nn"), F.count(F.lit(1)).alias("_n"))
    ranked = position_in_key(r.join(freq, "u"), "it", ["freq", "u"], name="pos")
    return shared_table(_running(ranked.join(norms, "it")), "ranked-entries")


def _running(rows: DataFrame, chunk: int = 4096) -> DataFrame:
    """Add ``rest``: sum of squares of the item's entries behind this one, in chunks of positions."""
    rows = rows.withColumn("_c", F.floor((F.col("pos") - 1) / F.lit(chunk)))
    per = rows.groupBy("it", "_c").agg(F.sum(F.col("r") * F.col("r")).alias("_s"))
    w = Window.partitionBy("it").orderBy(F.desc("_c")).rowsBetween(Window.unboundedPreceding, -1)   # a row per chunk
    behind = per.select("it", "_c", F.coalesce(F.sum("_s").over(w), F.lit(0.0)).alias("_after"))
    inside = Window.partitionBy("it", "_c").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum(F.col("r") * F.col("r")).over(inside), F.lit(0.0))).join(behind, ["it", "_c"])
            .select("u", "it", "r", "nn", "freq", "pos", (F.col("_in") + F.col("_after")).alias("rest")))


def reaches(threshold):
    """True for entries up to the first whose rest is below the threshold: rest + r^2, the norm before it, is not."""
    return F.col("rest") + F.col("r") * F.col("r") >= threshold * threshold * F.lit(1 - MARGIN) * F.col("nn")


def _marked(index: DataFrame, threshold, own: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, items).  Entries (k, it, r, x, p): ``p`` in the item's prefix, ``x`` the item's code.  Items (it, nn, end,
    tail, behind, top, least): the prefix's last user, the (squared) norm and the number of the entries behind it, the
    largest (squared) entry, the threshold (of ``own``'s columns, if given).

    Repeated entries of a prefix's last user are all in it, so ``tail`` and ``behind`` may count some of them: bounds."""
    own = (index if own is None else own).withColumn("least", threshold)
    inside = reaches(F.col("least"))
    ends = own.groupBy("it").agg(
        F.max("nn").alias("nn"), F.max(F.when(inside, F.struct("freq", "u"))).alias("end"), F.min(F.when(inside, F.col("rest"))).alias("tail"),
        F.count(F.when(inside, F.lit(None)).otherwise(F.lit(1))).alias("behind"), F.max(F.col("r") * F.col("r")).alias("top"), F.max("least").alias("least"))
    ends = shared_table(ends.where("end is not null"), "prefix-ends")
    entries = index.drop("nn").join(ends, "it").select(F.col("u").alias("k"), "it", "r", _code().alias("x"),
                                                       (F.struct("freq", "u") <= F.col("end")).alias("p"))
    return shared_table(entries, "prefixes"), ends


#: An item's code, from the lowest byte: its norm in quarters of a power of two (rounded down; two bytes), the tail's share of
#: the norm in 254ths (up), the threshold in 255ths (down), the largest entry's share in 254ths (up), the entries behind.
_LOW = 1 << 13


def _code():
    def share(x):
        part = F.sqrt(x / F.col("nn"))
        return F.when(x <= 0, F.lit(0)).when(part.between(0, 1), F.ceil(part * 254 + 1e-6)).otherwise(F.lit(255))
    norm = F.when(F.col("nn").between(1e-300, 1e300), F.floor(F.log2("nn") * 4 - 1e-6)).otherwise(F.lit(1 - _LOW)) + F.lit(_LOW)
    least = F.when(F.col("least").between(0, 1), F.floor(F.col("least") * 255)).otherwise(F.lit(0))
    return (norm + share(F.col("tail")) * (1 << 16) + least * (1 << 24) + share(F.col("top")) * F.lit(1 << 32)
            + F.least("behind", F.lit(255)) * F.lit(1 << 40)).cast("long")


def _uncode(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """(root of the norm, tail's share, threshold, largest entry's share, root of the number behind): the first and third at
    most the item's, the others at least."""
    byte = lambda n: (x >> n) & 0xFF
    behind = byte(40)
    return np.exp2(((x & 0xFFFF) - _LOW) / 8), byte(16) / 254, byte(24) / 255, byte(32) / 254, np.where(behind < 255, np.sqrt(behind), np.inf)


def _enough(min_common: int):
    return lambda v, n, x_i, x_j: n >= min_common


def _keep(threshold: float | None, min_common: int):
    """Pairs of a block that may reach the threshold, or one of the items' own (None), with enough common users."""
    def keep(v, n, x_i, x_j):
        (norm_i, tail_i, least_i, top_i, behind_i), (norm_j, tail_j, least_j, top_j, behind_j) = _uncode(x_i), _uncode(x_j)
        with np.errstate(all="ignore"):
            if threshold is None:
                least, tail = np.minimum(least_i, least_j), tail_i * tail_j
            else:                     # the users behind the first end are no more than its item has, and none weighs more than the other's largest
                least, tail = threshold, np.maximum(tail_i * np.fmin(1, behind_i * top_j), tail_j * np.fmin(1, behind_j * top_i))
            below = np.maximum(v, 0) / norm_i / norm_j + tail < least * (1 - MARGIN) - MARGIN
        return ~below & ((n >= min_common) | (tail > 0))
    return keep


def _with_items(met: DataFrame, items: DataFrame) -> DataFrame:
    for side in "ij":
        met = met.join(items.select(F.col("it").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("nn", "end", "tail", "behind", "top", "least")]), side)
    return met.withColumn("part", F.col("v") / F.sqrt(F.col("nn_i") * F.col("nn_j")))


_PAIR = ("i", "j", "v", "n", "nn_i", "nn_j", "part")


def _met(marked: DataFrame, items: DataFrame, keep, piece_rows: int) -> DataFrame:
    """(i < j, ...) of the pairs that meet in their prefixes; users behind the prefix of ``a``, the item whose
    prefix ends first, are not in the sums yet, and add ``tail`` to ``part`` at most."""
    met = _with_items(pair_meetings(marked.where("p"), keep, piece_rows=piece_rows), items)
    first = F.col("end_i") <= F.col("end_j")

    def tail(a, b):
        weigh = F.least(F.lit(1.0), F.col(f"behind_{a}") * F.col(f"top_{b}") / F.col(f"nn_{b}"))
        return F.sqrt(F.greatest(F.col(f"tail_{a}") / F.col(f"nn_{a}") * weigh, F.lit(0.0)))
    return met.select(*_PAIR, F.when(first, F.col("i")).otherwise(F.col("j")).alias("a"), F.when(first, F.col("j")).otherwise(F.col("i")).alias("b"),
                      F.when(first, tail("i", "j")).otherwise(tail("j", "i")).alias("tail"))


def _candidates(marked: DataFrame, items: DataFrame, threshold: float, piece_rows: int, min_common: int = 1) -> DataFrame:
    """The rows of ``_met`` that may reach the threshold."""
    met = _met(marked, items, _keep(threshold, min_common), piece_rows)
    return met.where(F.greatest("part", F.lit(0.0)) + F.col("tail") >= F.lit(threshold * (1 - MARGIN) - MARGIN))


def _met_from(marked: DataFrame, items: DataFrame, piece_rows: int, min_common: int = 1) -> DataFrame:
    """(i < j, ...) of the pairs that meet in the prefix of either and may reach the threshold of either; users
    behind both prefixes are not in the sums yet."""
    met = _with_items(pair_meetings(marked, _keep(None, min_common), either=True, piece_rows=piece_rows), items)
    tail = F.sqrt(F.greatest(F.col("tail_i") / F.col("nn_i"), F.lit(0.0))) * F.sqrt(F.greatest(F.col("tail_j") / F.col("nn_j"), F.lit(0.0)))
    met = met.select(*_PAIR, F.col("i").alias("a"), F.col("j").alias("b"), tail.alias("tail"), F.least("least_i", "least_j").alias("least"))
    return met.where(F.col("part") + F.col("tail") >= F.col("least") * (1 - MARGIN) - MARGIN)


def _scored(met: DataFrame, marked: DataFrame, min_common: int, either: bool = False) -> DataFrame:
    """(i, j, sim): the sums of ``met`` completed by the entries behind ``a``'s prefix (``either``: behind both)."""
    met = shared_table(met.select("i", "j", "v", "n", "nn_i", "nn_j", "a", "b", "tail"), "met")
    pair = ("i", "j", "nn_i", "nn_j")
    behind = marked.where("not p").select(F.col("it").alias("a"), "k", F.col("r").alias("ra"))
    others = (marked.where("not p") if either else marked).select(F.col("it").alias("b"), "k", F.col("r").alias("rb"))
    missing = (met.where("tail > 0").select(*pair, "a", "b").join(behind, "a").join(others, ["b", "k"])
               .select(*pair, (F.col("ra") * F.col("rb")).alias("v"), F.lit(1).cast("long").alias("n")))
    sums = (met.where("tail > 0").select(*pair, "v", "n").unionByName(missing).groupBy(*pair).agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
            .unionByName(met.where("not tail > 0").select(*pair, "v", "n")))
    return sums.where(F.col("n") >= min_common).select("i", "j", F.try_divide(F.col("v"), F.sqrt(F.col("nn_i") * F.col("nn_j"))).alias("sim"))


def candidates(index: DataFrame, threshold: float, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(i < j) of the pairs that the bounds leave."""
    return _candidates(*_marked(index, F.lit(float(threshold))), threshold, piece_rows).select("i", "j")


def similar_items(ratings: DataFrame, threshold: float, user: str = "user", item: str = "item", rating: str = "rating",
                  min_common: int = 1, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``matrix.cosine_similarity`` where ``sim >= threshold`` (> 0): ``(i, j, sim)``, both directions."""
    if threshold <= 0:
        raise ValueError("a threshold above 0 is needed; matrix.cosine_similarity has all pairs")
    marked, items = _marked(entries(ratings, user, item, rating), F.lit(float(threshold)))
    met = _candidates(marked, items, threshold, piece_rows, min_common)
    return mirror(_scored(met, marked, min_common).where(F.col("sim") >= threshold), ["sim"])


def nearest_items(ratings: DataFrame, k: int, user: str = "user", item: str = "item", rating: str = "rating",
                  min_common: int = 1, first: float = FIRST, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The k most similar items of every item (ties: smaller j): ``(i, j, sim)``, sim above 0.

    Of the items that meet in the short prefixes of threshold ``first`` with enough common users there, an item's best
    by their shared products are scored: their k-th best is a lower bound of its true k-th best (0 if there are
    fewer), and the threshold from which its neighbours are sought.  An item's prefix meets all entries then, its
    partner's prefix or not: users behind both cannot add up to either's threshold.  Ratings must not be negative.
    """
    index = entries(ratings, user, item, rating)
    marked, items = _marked(index, F.lit(float(first)))
    some = shared_table(_met(marked, items, _enough(min_common), piece_rows), "first-met")
    tops = top_k_per_key(mirror(some.select("i", "j", "part"), ["part"]), "i", "part", 2 * k, tie="j")
    chosen = some.join(tops.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct(), ["i", "j"], "left_semi")
    best = top_k_per_key(mirror(_scored(chosen, marked, min_common), ["sim"]), "i", "sim", k, tie="j")
    best = best.groupBy(F.col("i").alias("it")).agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
    least = F.when(F.col("n") >= k, F.col("low")).otherwise(F.lit(0.0))
    own = index.join(shared_table(best, "first-best"), "it", "left")
    marked, items = _marked(index, least, own)
    pairs = mirror(_scored(_met_from(marked, items, piece_rows, min_common), marked, min_common, either=True), ["sim"])
    return top_k_per_key(pairs.where(F.col("sim") > 0), "i", "sim", k, tie="j")
