"""Binary logistic regression by Newton steps (iteratively reweighted least
squares): one distributed Gram matrix per step.

The steps are those of Spark's generalized linear regression with a binomial
family: rows are weighted on the executors, their outer products summed by tree
aggregation, and one matrix of (features + 1)^2 numbers is solved on the
driver.  A dozen passes reach the optimum where a first-order fit needs some
ninety.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .partitioning import FitLayout, kept
from .vectors import assembler

TOLERANCE = 1e-6         # of the largest change of a coefficient in one step
MOST_STEPS = 16


@dataclass(frozen=True)
class NewtonLogistic:
    """A fit: ``coefficients`` in order of ``features``; ``gradient`` is the
    largest mean gradient left in a standardised coefficient, ``loss`` the mean
    log loss, so how near the optimum the fit ended can be read off."""
    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float
    steps: int
    gradient: float
    loss: float
    rows: int

    def raw(self) -> Column:
        return sum((F.col(c) * F.lit(float(b)) for c, b in zip(self.features, self.coefficients)),
                   F.lit(float(self.intercept)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``raw_score``, ``p`` (of class 1) and ``prediction``."""
        out = df.withColumn("raw_score", self.raw()).withColumn("p", 1 / (1 + F.exp(-F.col("raw_score"))))
        return out.withColumn("prediction", (F.col("p") > 0.5).cast("double"))

    def coefficient_rows(self, spark) -> DataFrame:
        """``(class_index, feature, coefficient)``; the intercept is feature
        ``(intercept)``."""
        rows = [(0, name, float(b)) for name, b in zip(self.features, self.coefficients)]
        return spark.createDataFrame([*rows, (0, "(intercept)", float(self.intercept))],
                                     "class_index int, feature string, coefficient double")


def gradients(scored: DataFrame, features, label_col: str = "label") -> Column:
    """Mean of ``(p - y) * x`` of each standardised feature, then of the
    intercept, as one array: what is 0 at the optimum."""
    miss = F.col("p") - F.col(label_col)
    each = [F.coalesce(F.when(F.stddev(c) > 0, (F.avg(miss * F.col(c)) - F.avg(miss) * F.avg(c)) / F.stddev(c)),
                       F.lit(0.0)) for c in features]
    return F.array(*each, F.avg(miss))


def newton_logistic(rows: DataFrame, features, label_col: str = "label", tolerance: float = TOLERANCE,
                    most_steps: int = MOST_STEPS) -> NewtonLogistic:
    """Fit without regularisation until no coefficient changes by
    ``tolerance`` in a step, or for ``most_steps``.

    Separable classes have no finite optimum: there the last step counts, and
    each step makes the gradient some three times smaller.  Constant features
    get 0; if features depend linearly on each other Spark's solver goes on by
    quasi-Newton steps.  Labels other than 0 and 1, and no rows, are errors.
    """
    features = tuple(features)
    low, high, n = rows.agg(F.min(label_col), F.max(label_col), F.count(F.lit(1))).first()
    if not n or low < 0 or high > 1:
        raise ValueError(f"labels must be 0 or 1 and there must be some: {n} rows from {low} to {high}")
    table = assembler(features, "__features").transform(rows.select(label_col, *features))
    with kept(table.coalesce(FitLayout().count(n))) as table:       # few rows, few tasks
        model = GeneralizedLinearRegression(
            family="binomial", link="logit", featuresCol="__features", labelCol=label_col, regParam=0.0,
            maxIter=most_steps, tol=tolerance).fit(table)
        fit = NewtonLogistic(features, model.coefficients.toArray(), float(model.intercept),
                             int(model.summary.numIterations), float("nan"), float("nan"), n)
        margin = F.col("raw_score") * (2 * F.col(label_col) - 1)
        loss = F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
        scored = fit.transform(table)
        left = scored.agg(gradients(scored, features, label_col).alias("g"), F.avg(loss).alias("l")).first()
    return NewtonLogistic(features, fit.coefficients, fit.intercept, fit.steps,
                          float(np.abs(left.g).max()), float(left.l), n)
