"""Linear SVM, raw margins and exact area under ROC."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import constant_array
from tessera.operators.ordering import hash_fraction
from tessera.operators.ranking import exclusive_prefix_sums
from tessera.session import shared_table

# Fixed values of the reference run: 100 iterations, 60/40 split, seed 11.
SVM_ITERATIONS = 100
TRAIN_FRACTION = 0.6
SPLIT_SEED = 11
# Fixed values of its training rule: step, L2 regularisation, and the movement at which it ends.
SGD_STEP = 1.0
SGD_REG = 0.01
SGD_TOLERANCE = 0.001


def assemble(df: DataFrame, feature_cols, label_col: str = "label") -> DataFrame:
    """Columns -> ``(label double, features vector)`` plus the other columns."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip")
    return va.transform(df.withColumn("label", F.col(label_col).cast("double")))


def train_svm(train: DataFrame, iterations: int = SVM_ITERATIONS, reg: float = 0.0):
    """L1: linear SVM (hinge loss; Spark's OWL-QN solver, not SGD)."""
    return LinearSVC(maxIter=iterations, regParam=reg, featuresCol="features", labelCol="label").fit(train)


@dataclass(frozen=True)
class SgdModel:
    """Weights by feature (no intercept), the steps taken, and whether they had settled."""
    features: tuple[str, ...]
    weights: tuple[float, ...]
    steps: int
    settled: bool

    def margin(self):
        return reduce(add, [F.col(c) * F.lit(w) for c, w in zip(self.features, self.weights)])


def train_svm_sgd(train: DataFrame, features, label: str = "label", iterations: int = SVM_ITERATIONS, step: float = SGD_STEP,
                  reg: float = SGD_REG, fraction: float = 1.0, key: str | None = None, tolerance: float = SGD_TOLERANCE) -> SgdModel:
    """L1 by the reference run's own rule: subgradient descent on the hinge loss, labels 0 and 1, from zero weights.

    Step t: of the rows in its sample, the sum over those with margin below 1 of -y x, divided by the
    sample's size; ``w <- w (1 - s reg) - s grad`` with ``s = step / sqrt(t)``.  It ends after ``iterations``, or
    when a step moves the weights by less than ``tolerance`` x max(1, their norm).  A step's sample is a hash of
    (``key``, t), the same on every cluster and in every retry; ``fraction`` 1 takes every row, and a sample without rows
    changes nothing.  Rows with a null or NaN feature or a null label take no part.

    Each step is one aggregate over the rows with partial sums in every task; one row of sums comes to
    the driver.  The rows are stored once.
    """
    features = tuple(features)
    cols = [f"x{i}" for i in range(len(features))]
    rows = train.select(*[F.col(c).cast("double").alias(x) for c, x in zip(features, cols)], (2.0 * F.col(label).cast("double") - 1.0).alias("y"),
                        *([F.col(key).cast("string").alias("key")] if key else []))
    rows = shared_table(rows.dropna(subset=[*cols, "y"]), "sgd-rows")
    w, t = [0.0] * len(features), 0
    for t in range(1, iterations + 1):
        weights = constant_array(w)                    # an array literal: its numbers are no part of the generated code
        dot = reduce(add, [F.col(x) * F.get(weights, F.lit(i)) for i, x in enumerate(cols)])
        batch = rows if fraction >= 1 else rows.where(hash_fraction(F.concat(F.col("key"), F.lit(f"-{t}"))) < fraction)
        wrong = F.when(F.col("y") * dot < 1, -F.col("y"))
        got = batch.agg(F.count(F.lit(1)).alias("n"), *[F.sum(wrong * F.col(x)).alias(x) for x in cols]).collect()[0]
        if not got["n"]:
            continue
        s = step / math.sqrt(t)
        new = [v * (1 - s * reg) - s * (got[x] or 0.0) / got["n"] for v, x in zip(w, cols)]
        moved = math.sqrt(sum((a - b) ** 2 for a, b in zip(new, w)))
        w = new
        if t > 1 and moved < tolerance * max(1.0, math.sqrt(sum(a * a for a in w))):
            return SgdModel(features, tuple(w), t, True)
    return SgdModel(features, tuple(w), t, False)


def raw_scores(model, test: DataFrame, keep=()) -> DataFrame:
    """L2: raw margin per test row with its label -> ``(…keep, label, score)``."""
    out = model.transform(test)
    return out.select(*keep, "label", vector_to_array("rawPrediction")[1].alias("score"))


def auc_roc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """L3: exact area under the ROC curve -> one row ``auc``.

    Per distinct score: positives and negatives (partial hash aggregate),
    then the number of negatives below each score by a distributed prefix
    sum; ``AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)`` (ties
    count one half, the Mann-Whitney form).
    """
    per = (scored.groupBy(F.col(score).alias("s"))
           .agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).cast("double").alias("pos"),
                F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).cast("double").alias("neg")))
    pre = exclusive_prefix_sums(per, "s", ["neg"])
    return pre.agg(F.try_divide(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)),
                                F.sum("pos") * F.sum("neg")).alias("auc"))
