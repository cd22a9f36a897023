"""Multinomial naive Bayes in long form.

Model, with smoothing ``λ`` and ``n`` features (hash buckets)::

    log_prior[c]   = ln(n_c + λ) - ln(N + k·λ)
    log_theta[c,j] = ln(s[c,j] + λ) - ln(s[c] + λ·n)
    score[c](x)    = log_prior[c] + Σ_j x_j · log_theta[c,j]

where ``n_c`` counts training rows of class ``c`` and ``s[c,j]`` sums
feature ``j`` over them.  These are the quantities Spark's ``NaiveBayes``
(``pi``, ``theta``) holds; here they stay DataFrames.  A bucket never seen
with class ``c`` has ``log_theta = ln(λ) - ln(s[c] + λ·n)`` (the class
default), so only seen (class, bucket) pairs are stored:

    score[c] = log_prior[c] + default[c]·Σ_j x_j + Σ_seen x_j·(log_theta - default)[c,j]

Fitting is two partial aggregates; scoring is a broadcast join with a
table of at most ``n`` rows and one aggregate per document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class NaiveBayesModel:
    classes: DataFrame      # label, n_docs, log_prior, log_default (k rows)
    theta: DataFrame        # label, bucket, log_theta (<= k * num_features rows)
    num_features: int
    smoothing: float


def naive_bayes_stats(features: DataFrame, docs: DataFrame, label_col: str = "label"):
    """The two aggregates a fit needs: training rows per class ``(label,
    n_docs)`` (k rows) and feature sums ``(label, bucket, s)`` (at most
    k * num_features rows).  Both aggregate partially per task first, so
    a class or bucket holding most rows is no hot spot."""
    counts = docs.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_docs"))
    sums = (features.where(F.col("bucket").isNotNull())
                    .groupBy(label_col, "bucket").agg(F.sum("weight").alias("s")))
    return counts, sums


def naive_bayes_from_stats(counts: DataFrame, sums: DataFrame, label_col: str = "label",
                           num_features: int = 10000,
                           smoothing: float = 1.0) -> NaiveBayesModel:
    lam = float(smoothing)
    totals = sums.groupBy(label_col).agg(F.sum("s").alias("s_total"))
    # k rows: the window over them is a tiny single-partition step.
    everything = Window.partitionBy()
    log_norm = F.log(F.coalesce(F.col("s_total"), F.lit(0.0)) + lam * num_features)
    classes = (counts.join(totals, label_col, "left")
               .select(label_col, "n_docs",
                       (F.log(F.col("n_docs") + lam)
                        - F.log(F.sum("n_docs").over(everything)
                                + F.count(F.lit(1)).over(everything) * lam)).alias("log_prior"),
                       (F.log(F.lit(lam)) - log_norm).alias("log_default"),
                       log_norm.alias("log_norm")))
    theta = (sums.join(F.broadcast(classes.select(label_col, "log_norm")), label_col)
                 .select(label_col, "bucket",
                         (F.log(F.col("s") + lam) - F.col("log_norm")).alias("log_theta")))
    return NaiveBayesModel(classes.drop("log_norm"), theta, num_features, lam)


def naive_bayes_fit(features: DataFrame, docs: DataFrame, label_col: str = "label",
                    num_features: int = 10000, smoothing: float = 1.0) -> NaiveBayesModel:
    """``features``: ``(..., label, bucket, weight)`` rows of the training
    documents; ``docs``: one row per training document with its label (a
    document without terms still counts in the prior)."""
    counts, sums = naive_bayes_stats(features, docs, label_col)
    return naive_bayes_from_stats(counts, sums, label_col, num_features, smoothing)


def naive_bayes_score(model: NaiveBayesModel, features: DataFrame, keys,
                      label_col: str = "label", l2_normalize: bool = False) -> DataFrame:
    """Score documents given as long-form features (one row per document
    and bucket, documents without terms as a null-bucket row).

    With ``l2_normalize`` the features are taken raw and scaled here: as
    ``w = x / |x|``, every term of a score is a plain per-document sum
    (``Σx``, ``Σx·δ`` and ``Σx²`` for the norm), so the scaling costs no
    window (no sort) -- just one more sum in the same aggregate.

    Output: ``keys..., prediction, score, probability`` where ``score`` is
    the winning raw score and ``probability`` its softmax share.  Ties go
    to the lower class, like ``argmax`` on the raw-score vector.

    The k class values and their two constants are read to the driver
    (k numbers each, bounded by the number of classes) to lay the scores
    out as k columns; the per-bucket table is pivoted to one row per
    bucket (at most ``num_features`` rows) and broadcast.
    """
    keys = list(keys)
    rows = (model.classes.select(label_col, "log_prior", "log_default")
            .orderBy(label_col).collect())
    values = [r[0] for r in rows]
    deltas = (model.theta.join(F.broadcast(model.classes.select(label_col, "log_default")),
                               label_col)
              .groupBy("bucket")
              .agg(*[F.max(F.when(F.col(label_col) == F.lit(v),
                                  F.col("log_theta") - F.col("log_default")))
                     .alias(f"__d{i}") for i, v in enumerate(values)]))
    joined = features.join(F.broadcast(deltas), "bucket", "left")
    sums = joined.groupBy(*keys).agg(
        F.sum("weight").alias("__w"),
        F.sum(F.col("weight") * F.col("weight")).alias("__q"),
        *[F.sum(F.col("weight") * F.coalesce(F.col(f"__d{i}"), F.lit(0.0))).alias(f"__s{i}")
          for i in range(len(values))])
    if l2_normalize:
        norm = F.sqrt(F.col("__q"))

        def scaled(c):
            return F.when(norm > 0, F.col(c) / norm).otherwise(F.lit(0.0))
    else:
        def scaled(c):
            return F.col(c)
    scores = [F.lit(r["log_prior"]) + F.lit(r["log_default"]) * scaled("__w") + scaled(f"__s{i}")
              for i, r in enumerate(rows)]
    scored = sums.select(*keys, *[s.alias(f"__r{i}") for i, s in enumerate(scores)])
    raw = [F.col(f"__r{i}") for i in range(len(values))]
    best = F.greatest(*raw) if len(raw) > 1 else raw[0]
    pred = F.coalesce(*[F.when(r == best, F.lit(float(v))) for r, v in zip(raw, values)])
    denom = sum((F.exp(r - best) for r in raw), F.lit(0.0))
    return scored.select(*keys, pred.alias("prediction"), best.alias("score"),
                         (F.lit(1.0) / denom).alias("probability"))
