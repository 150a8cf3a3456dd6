"""Correlation matrix and the quantile-style discretizer.

Discretizer plan (``discretize``):

1. the continuous columns of the whole table are unpivoted to
   ``(column, value)`` and counted per distinct value (partial hash agg); a
   sample is read only if the caller asks for a fraction;
2. the stride walk over the sorted (value, count) pairs is evaluated in closed
   form (``_walk``) with running aggregates inside ranges of (column, value),
   carried over range bounds, so no column meets in one task;
3. the splits (at most ``max_bins + 1`` values per column) become the edges of one
   ``Bucketizer`` projection over the table; each value finds its bin by binary search.

Splits can also come from mergeable quantile sketches (``sketch_columns``).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import HASH_BUCKETS, hash_bucket
from tessera.operators.ordering import hash_fraction
from tessera.operators.ranking import RANGE, before_range, join_before, ranged_table

# Fixed values of the discretizer: default bins, minimum sample, seed, limits.
DEFAULT_MAX_BINS = 32
MIN_SAMPLES = 10000
SAMPLE_SEED = 888
MAX_BINS_LIMIT = 100000


def corr_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Pearson correlation of every column pair in **one** aggregate.

    Output: one row per column, ``column`` then one double per column.  A
    constant column gives null (Spark's ``corr`` would raise under ANSI).
    """
    cols = columns or [c for c, t in df.dtypes if t != "string"]
    aggs = []
    for a_i, a in enumerate(cols):
        aggs.append(F.stddev_pop(F.col(a).cast("double")).alias(f"_sd_{a_i}"))
        for b_i in range(a_i, len(cols)):
            b = cols[b_i]
            aggs.append(F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_cv_{a_i}_{b_i}"))
    wide = df.agg(*aggs)

    def cell(i, j):
        lo, hi = min(i, j), max(i, j)
        return F.try_divide(F.col(f"_cv_{lo}_{hi}"), F.col(f"_sd_{lo}") * F.col(f"_sd_{hi}"))

    rows = [F.struct(F.lit(c).alias("column"), *[cell(i, j).alias(cols[j]) for j in range(len(cols))])
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def sample_fraction(max_bins: int, n: int) -> float:
    """Fraction of rows to sample for split finding (long arithmetic)."""
    required = max(int(max_bins) * int(max_bins), MIN_SAMPLES)
    return required / n if required < n else 1.0


def _unpivot(df: DataFrame, columns) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("value").isNotNull())


def find_splits(df: DataFrame, columns, max_bins: int = DEFAULT_MAX_BINS, n: int | None = None,
                fraction: float | None = None, seed: int = SAMPLE_SEED, sample_key=None) -> DataFrame:
    """Split points per continuous column -> ``(column, splits array<double>)``.

    Counts the whole table.  A caller who wants the sampled form passes
    ``fraction`` (``sample_fraction`` gives the usual one); with ``sample_key``
    the sample is a hash of that column (repeatable in any engine), otherwise
    Spark's seeded Bernoulli sampler.  ``n`` is the row count (computed when not
    given).  Columns with at most ``max_bins`` distinct values split at
    the values themselves; others follow the stride walk: after each value, if
    the running count moved away from the target, the midpoint of the previous
    and the current value is a split and the target moves on by one stride.
    """
    if n is None:
        n = df.count()
    s, num_samples = df, n
    if fraction is not None and fraction < 1.0:
        num_samples = int(fraction * n)
        s = (df.where(hash_fraction(sample_key) < F.lit(fraction)) if sample_key is not None
             else df.sample(withReplacement=False, fraction=fraction, seed=seed))
    hist = (_unpivot(s, columns).groupBy("column", "value").agg(F.count(F.lit(1)).cast("double").alias("cnt")))
    return _walk(hist, max_bins, num_samples, num_samples / (max_bins + 1))


def _walk(hist: DataFrame, max_bins: int, num_samples: int, stride: float) -> DataFrame:
    """Split points of every column from its (value, cnt) histogram.

    The fold "split when the target is nearer the previous running count
    than the current one, then move the target one stride on" has a closed
    form.  With m_i the midpoint of the running counts before and after
    value i, a split happens at step i exactly when the current target is
    below m_i.  If q_i is the number of targets k * stride below m_i
    (non-decreasing), the split count after step i is
    s_i = min(q_i, s_{i-1} + 1), i.e. s_i = i + min(0, min_{j<=i}(q_j - j)),
    and value i yields the split (v_{i-1} + v_i) / 2 when s_i > s_{i-1}.
    So the walk needs, per value, its place, the running count and the running
    minimum of q_j - j: aggregates inside a range of (column, value) plus
    those of the column's earlier ranges (at most one row per range).
    """
    rows = ranged_table(hist, ["column", "value"])
    one = Window.partitionBy(RANGE, "column").orderBy("value")
    run = one.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(RANGE, "column").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("c"), F.max("value").alias("last"))
    by_range = Window.partitionBy("column").orderBy(RANGE)
    before = before_range(totals, ["column"], {"n": "n0", "c": "c0"}).join(
        totals.select(RANGE, "column", F.lag("last").over(by_range).alias("v0")), [RANGE, "column"])
    sizes = totals.groupBy("column").agg(F.sum("n").alias("k"))  # one row per column of the table
    h = join_before(rows, before, ["column"]).join(F.broadcast(sizes), "column")
    idx = F.coalesce("n0", F.lit(0)) + F.row_number().over(one) - 1
    cum = F.coalesce("c0", F.lit(0.0)) + F.sum("cnt").over(run)
    h = h.select(RANGE, "column", "value", "k", idx.alias("idx"), (cum - F.col("cnt") / 2.0).alias("m"),
                 F.coalesce(F.lag("value").over(one), F.col("v0")).alias("prev_value"))
    if stride > 0:
        near = F.greatest(F.floor(F.col("m") / F.lit(stride)), F.lit(1))
        below = lambda k: F.when(k * F.lit(stride) < F.col("m"), 1).otherwise(0)
        q = near - 1 + below(near) + below(near + 1)
    else:
        q = F.lit(0)
    h = h.withColumn("a", F.when(F.col("idx") == 0, F.lit(0)).otherwise(q - F.col("idx")))
    lows = h.groupBy(RANGE, "column").agg(F.min("a").alias("low"))
    low0 = lows.select(RANGE, "column", F.min("low").over(by_range.rowsBetween(Window.unboundedPreceding, -1)).alias("low0"))
    h = join_before(h, low0.where("low0 is not null"), ["column"])
    lowest = lambda w: F.least(F.lit(0), F.coalesce("low0", F.lit(0)), F.coalesce(F.min("a").over(w), F.lit(0)))
    s_here = F.col("idx") + lowest(run)
    s_prev = F.col("idx") - 1 + lowest(one.rowsBetween(Window.unboundedPreceding, -1))
    h = h.select("column", "value", "k", "prev_value", ((F.col("idx") > 0) & (s_here > s_prev)).alias("split_here"))
    point = (F.when(F.col("k") <= max_bins, F.col("value"))
             .when(F.col("split_here"), (F.col("prev_value") + F.col("value")) / 2.0))
    pts = h.select("column", point.alias("p")).where(F.col("p").isNotNull())
    return pts.groupBy("column").agg(F.array_sort(F.collect_list("p")).alias("splits"))


def assign_upper(df: DataFrame, splits: dict[str, list[float]], names: dict[str, str] | None = None) -> DataFrame:
    """Per column the smallest split greater than the value; at or above the last -> the last.

    ``splits``: sorted numbers per column; the result replaces the column, or is added under
    ``names[column]``.  A value finds its place by Spark ML's ``Bucketizer`` (a binary search in the JVM).  No splits
    or a null value: null; NaN counts as the largest.
    """
    names = names or {c: c for c in splits}
    cols = [c for c in splits if len(splits[c])]
    places = {c: f"_place_{i}" for i, c in enumerate(cols)}
    values = {c: f"_value_{i}" for i, c in enumerate(cols)}
    out = df.withColumns({values[c]: F.col(_quoted(c)).cast("double") for c in cols})
    if cols:
        edges = [[-math.inf, *map(float, splits[c]), math.inf] for c in cols]
        out = Bucketizer(splitsArray=edges, inputCols=list(values.values()), outputCols=list(places.values()), handleInvalid="keep").transform(out)

    def upper(c):
        if c not in places:
            return F.lit(None).cast("double")
        at = F.least(F.col(places[c]).cast("int"), F.lit(len(splits[c]) - 1))     # behind the last split: the last
        return F.when(F.col(values[c]).isNotNull(), F.get(constant_array(splits[c]), at))
    return out.withColumns({names[c]: upper(c) for c in splits}).drop(*places.values(), *values.values())


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def split_values(splits: DataFrame) -> dict[str, list[float]]:
    """(column, splits) -> the numbers of each column.

    At most ``max_bins + 1`` numbers per column come to the driver, a bound set
    by the caller's parameter.
    """
    return {r["column"]: list(r["splits"]) for r in splits.collect()}


def constant_array(values):
    """A constant array<double> Column from one text literal (exact: shortest round-trip digits)."""
    if not len(values):
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>")


# ---- splits from sketches ----------------------------------------------------

#: Accuracy of the quantile sketches, and how their error follows from it (fixed values of the KLL sketch:
#: the share of all rows by which a rank is off, at most, in 99 of 100 cases).
SKETCH_K = 1024


def sketch_rank_error(k: int = SKETCH_K) -> float:
    return 2.296 / k ** 0.9723


def sketch_columns(df: DataFrame, columns, by=(), k: int = SKETCH_K) -> DataFrame:
    """X3, mergeable: one KLL quantile sketch per column (and per value of ``by``) -> ``(*by, column, sketch)``.

    One pass with partial aggregates of a few kB each: no sort, no shuffle of values, no sample.  Sketches
    of days or partitions can be kept and merged later.  Nulls take no part.
    """
    made = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(_quoted(c)).cast("double"), F.lit(k)).alias(f"_s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return made.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.column", "_r.sketch").where(F.col("sketch").isNotNull())


def splits_from_sketches(sketches: DataFrame, max_bins: int = DEFAULT_MAX_BINS) -> DataFrame:
    """Sketches (column, sketch), any number per column, merged -> ``(column, n, splits array<double>)``.

    The splits are the different values at ranks j / (max_bins + 1), j = 1 ... max_bins, each off by
    ``sketch_rank_error`` of the rows.  A column of few values yields those that hold such a rank.
    """
    steps = F.array(*[F.lit(j / (max_bins + 1)) for j in range(1, max_bins + 1)])
    merged = sketches.groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("_m"))
    merged = merged.select("column", "_m", F.kll_sketch_get_n_double("_m").alias("n")).where(F.col("n") > 0)
    return merged.select("column", "n", F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("_m", steps))).alias("splits"))


def category_values(df: DataFrame, columns=None) -> DataFrame:
    """The splits of a string column are its distinct values -> ``(column, value)``."""
    cols = columns or [c for c, t in df.dtypes if t == "string"]
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()


def discretize(df: DataFrame, max_bins: int = DEFAULT_MAX_BINS, passthrough_short: bool = False,
               hash_columns=(), fraction: float | None = None, seed: int = SAMPLE_SEED, sample_key=None,
               sketch_k: int | None = None) -> DataFrame:
    """Replace every continuous value by the upper edge of its bin.

    * string columns are categories and stay text; those the caller names in
      ``hash_columns`` are hashed into 10,000 buckets first;
    * other columns are cast to double and binned with ``find_splits`` over the
      whole table (or over a sample, if the caller gives ``fraction``, or from quantile
      sketches of accuracy ``sketch_k``, one pass without a sort); with
      ``passthrough_short`` a column with fewer than ``max_bins`` splits is
      passed through raw;
    * nulls stay null.
    Raises when ``max_bins`` is below the largest category count or above
    100,000.
    """
    str_cols = [c for c, t in df.dtypes if t == "string"]
    num_cols = [c for c, t in df.dtypes if t != "string"]
    if max_bins > MAX_BINS_LIMIT:
        raise ValueError(f"maxBins {max_bins} is above {MAX_BINS_LIMIT}")
    prof = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.countDistinct(c).alias(c) for c in str_cols]).collect()[0]
    largest = max([min(prof[c], HASH_BUCKETS) if c in hash_columns else prof[c] for c in str_cols], default=0)
    if max_bins < largest:
        raise ValueError(f"maxBins {max_bins} is below the largest category count {largest}")
    found = {}
    if num_cols and sketch_k:
        found = split_values(splits_from_sketches(sketch_columns(df, num_cols, k=sketch_k), max_bins))
    elif num_cols:
        found = split_values(find_splits(df, num_cols, max_bins, n=prof["_n"], fraction=fraction, seed=seed, sample_key=sample_key))
    binned = {c: v for c, v in found.items() if len(v) >= (max_bins if passthrough_short else 1)}
    out = []
    for c, t in df.dtypes:
        out.append(hash_bucket(c).alias(c) if c in hash_columns else F.col(_quoted(c)) if t == "string" else F.col(_quoted(c)).cast("double").alias(c))
    return assign_upper(df.select(*out), binned)
