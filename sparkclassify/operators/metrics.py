"""Evaluation as aggregations.

Class metrics (accuracy, weighted precision / recall / F1) all derive from
one confusion table: one pass over the (prediction, label) pairs with a
partial aggregate, after which everything works on at most ``k * k`` rows.

Binary curves (ROC, PR) and their areas are exact, i.e. the thresholds are
all distinct scores (``numBins = 0``).  A running sum in score order over
all rows would put every distinct score in one task; instead the distinct
scores are cut into quantile blocks, summed per block in parallel, and
each block adds the totals of the blocks before it (a table of one row
per block, broadcast).  Each distinct score is one row after the first
aggregate, so no block can be hot.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def confusion_matrix(pairs: DataFrame, prediction_col: str = "prediction",
                     label_col: str = "label") -> DataFrame:
    """``(label, prediction, n)`` for every combination that occurs."""
    return (pairs.groupBy(F.col(label_col).alias("label"),
                          F.col(prediction_col).alias("prediction"))
                 .agg(F.count(F.lit(1)).alias("n")))


def class_table(pairs: DataFrame, prediction_col: str = "prediction",
                label_col: str = "label") -> DataFrame:
    """Per true class: ``label, n_label, tp, n_pred, precision, recall, f1``.

    Precision of a class that is never predicted is 0; F1 is 0 when
    precision and recall are both 0 (the conventions of Spark's
    ``MulticlassMetrics``)."""
    cm = confusion_matrix(pairs, prediction_col, label_col)
    # Each cell counts once for its label and once for its prediction, so the
    # pairs are read once.
    n, hit = F.col("n"), F.col("label") == F.col("prediction")
    none = F.lit(0).cast("long")
    roles = cm.select(F.explode(F.array(
        F.struct(F.col("label").cast("double").alias("c"), n.alias("n_label"),
                 F.when(hit, n).otherwise(none).alias("tp"), none.alias("n_pred")),
        F.struct(F.col("prediction").cast("double").alias("c"), none.alias("n_label"), none.alias("tp"),
                 n.alias("n_pred")))).alias("r")).select("r.*")
    t = (roles.groupBy(F.col("c").alias("label"))
         .agg(F.sum("n_label").alias("n_label"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"))
         .filter("n_label > 0"))
    precision = F.when(F.col("n_pred") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("n_pred"))
    recall = F.col("tp") / F.col("n_label")
    t = t.select("*", precision.alias("precision"), recall.alias("recall"))
    f1 = (F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0))
           .otherwise(2 * F.col("precision") * F.col("recall")
                      / (F.col("precision") + F.col("recall"))))
    return t.withColumn("f1", f1)


def classification_summary(pairs: DataFrame, prediction_col: str = "prediction",
                           label_col: str = "label") -> DataFrame:
    """One row: ``n, accuracy, weighted_precision, weighted_recall,
    weighted_f1``."""
    t = class_table(pairs, prediction_col, label_col)
    total = F.sum("n_label")
    return t.agg(total.alias("n"),
                 (F.sum("tp") / total).alias("accuracy"),
                 (F.sum(F.col("precision") * F.col("n_label")) / total).alias("weighted_precision"),
                 (F.sum(F.col("recall") * F.col("n_label")) / total).alias("weighted_recall"),
                 (F.sum(F.col("f1") * F.col("n_label")) / total).alias("weighted_f1"))


def accuracy(pairs: DataFrame, prediction_col: str = "prediction",
             label_col: str = "label") -> DataFrame:
    """The direct route: mean of (prediction == label)."""
    hit = (F.col(prediction_col) == F.col(label_col)).cast("double")
    return pairs.agg(F.avg(hit).alias("accuracy"))


# --- binary curves ---------------------------------------------------------

def score_counts(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """``(score, pos, neg)`` per distinct score; labels are 0/1."""
    lab = F.col(label_col).cast("double")
    return (scored.groupBy(F.col(score_col).cast("double").alias("score"))
                  .agg(F.sum(lab).alias("pos"), F.sum(F.lit(1.0) - lab).alias("neg")))


def running_totals_desc(counts: DataFrame, num_blocks: int | None = None,
                        scores_per_block: int = 1_000_000) -> DataFrame:
    """Add ``tp``/``fp``: sums of ``pos``/``neg`` over all scores >= this one.

    Without ``num_blocks`` there is one block per ``scores_per_block``
    distinct scores (a count of the small per-score table).  The cut points
    come from ``approxQuantile`` (one job, ``num_blocks`` numbers to the
    driver) with a rank error of a tenth of a block, so a block holds at most
    1.2 times its share however many there are; the sums stay exact anyway.
    """
    blocks = num_blocks or max(1, -(-counts.count() // scores_per_block))
    cuts = []
    if blocks > 1:
        probs = [i / blocks for i in range(1, blocks)]
        cuts = sorted({c for c in counts.approxQuantile("score", probs, 0.1 / blocks)
                       if c is not None})
    if cuts:
        splits = [float("-inf")] + cuts + [float("inf")]
        blocked = (Bucketizer(splits=splits, inputCol="score", outputCol="_bucket",
                              handleInvalid="keep").transform(counts)
                   .withColumn("_block", F.col("_bucket").cast("int")).drop("_bucket"))
    else:
        blocked = counts.withColumn("_block", F.lit(0))
    block_tot = blocked.groupBy("_block").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # One row per block: this window is tiny.
    before = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = block_tot.select("_block",
                               F.coalesce(F.sum("_bp").over(before), F.lit(0.0)).alias("_op"),
                               F.coalesce(F.sum("_bn").over(before), F.lit(0.0)).alias("_on"))
    within = (Window.partitionBy("_block").orderBy(F.desc("score"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = blocked.select("score", "pos", "neg", "_block",
                             F.sum("pos").over(within).alias("_tp"),
                             F.sum("neg").over(within).alias("_fp"))
    return (running.join(F.broadcast(offsets), "_block")
                   .select("score", "pos", "neg",
                           (F.col("_tp") + F.col("_op")).alias("tp"),
                           (F.col("_fp") + F.col("_on")).alias("fp")))


def binary_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                 num_blocks: int | None = None) -> DataFrame:
    """One row per distinct score (threshold), highest first in meaning:
    ``threshold, tp, fp, tpr, fpr, recall, precision`` and the same for the
    previous threshold (``prev_*``), which the areas need."""
    # Read three times (cut points, totals, curve): computed once.
    counts = materialize(score_counts(scored, score_col, label_col), "score-counts")
    totals = counts.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    n_pos = totals.select("n_pos").scalar()
    n_neg = totals.select("n_neg").scalar()
    r = running_totals_desc(counts, num_blocks)

    def rate(num, den):
        return F.when(den == 0, F.lit(0.0)).otherwise(num / den)

    def prec(tp, fp):
        return F.when(tp + fp == 0, F.lit(1.0)).otherwise(tp / (tp + fp))

    ptp, pfp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    cur_prec = prec(F.col("tp"), F.col("fp"))
    return r.select(
        F.col("score").alias("threshold"), "tp", "fp",
        rate(F.col("tp"), n_pos).alias("tpr"), rate(F.col("fp"), n_neg).alias("fpr"),
        rate(ptp, n_pos).alias("prev_tpr"), rate(pfp, n_neg).alias("prev_fpr"),
        cur_prec.alias("precision"),
        # The PR curve starts at (0, precision at the first threshold).
        F.when(ptp + pfp == 0, cur_prec).otherwise(prec(ptp, pfp)).alias("prev_precision"),
        # The lowest threshold has counted every row; the ROC curve closes
        # from its point to (1, 1) (width 0 unless there are no negatives).
        (F.col("tp") + F.col("fp") == n_pos + n_neg).alias("is_last"))


def _roc_area():
    closing = F.when(F.col("is_last"), (1 - F.col("fpr")) * (F.col("tpr") + 1) / 2).otherwise(0.0)
    return F.sum((F.col("fpr") - F.col("prev_fpr")) * (F.col("tpr") + F.col("prev_tpr")) / 2 + closing).alias("auroc")


def _pr_area():
    return F.sum((F.col("tpr") - F.col("prev_tpr"))
                 * (F.col("precision") + F.col("prev_precision")) / 2).alias("aupr")


def area_under_roc(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                   num_blocks: int | None = None) -> DataFrame:
    """Trapezoids between consecutive ROC points, from (0, 0) to (1, 1)."""
    return binary_curve(scored, score_col, label_col, num_blocks).agg(_roc_area())


def area_under_pr(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                  num_blocks: int | None = None) -> DataFrame:
    """Trapezoids over (recall, precision), starting at recall 0 with the
    precision of the first threshold."""
    return binary_curve(scored, score_col, label_col, num_blocks).agg(_pr_area())


def both_areas(scored: DataFrame, score_col: str = "score", label_col: str = "label",
               num_blocks: int | None = None) -> DataFrame:
    """``auroc`` and ``aupr`` from one curve."""
    return binary_curve(scored, score_col, label_col, num_blocks).agg(_roc_area(), _pr_area())
