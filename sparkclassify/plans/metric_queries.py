"""Queries for evaluation (E1-E8) on rule-made predictions and scores.

The predictions need no model, so every metric is checked against SQL:

* multiclass pairs: the language of each document (indexed by frequency)
  against a guess from its letters (n-tilde -> es, sharp s -> de,
  c-cedilla -> fr, else en);
* binary scores: the share of characters that are not ASCII letters in a
  document, against its ``labels.quality``; hard predictions cut that
  share at 0.25.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import (accuracy, area_under_pr, area_under_roc,
                                 binary_curve, class_table, classification_summary,
                                 confusion_matrix)
from ..session import load_table
from . import sqlparts as S
from .catalog import register
from .common import documents
from .doc_features import ASCII_LETTERS


def _guess_lang():
    t = F.col("text")
    return (F.when(t.contains("ñ"), "es").when(t.contains("ß"), "de")
             .when(t.contains("ç"), "fr").otherwise("en"))


def lang_pairs(spark, sf_dir):
    """(prediction, label) per document, both as lang indices."""
    docs = documents(spark, sf_dir, ["doc_id", "lang", "text"])
    guessed = docs.select("doc_id", "lang", _guess_lang().alias("guess"))
    from ..operators.vectors import label_indexer
    model = label_indexer("lang", "label").fit(docs.select("lang"))
    labelled = model.transform(guessed)
    guess_idx = model.copy().setInputCol("guess").setOutputCol("prediction")
    return guess_idx.transform(labelled).select("doc_id", "prediction", "label")


def quality_scores(spark, sf_dir):
    """(doc_id, score, label, prediction) for labelled documents."""
    docs = documents(spark, sf_dir, ["doc_id", "text"])
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    # ASCII letters counted by deleting them (per-character map).
    letters = F.length("text") - F.length(F.translate("text", ASCII_LETTERS, ""))
    score = (F.when(F.length("text") == 0, F.lit(0.0))
              .otherwise(F.lit(1.0) - letters / F.length("text")))
    # Scored before the join: one double per document goes through it.
    return (docs.select("doc_id", score.alias("score")).join(labels, "doc_id")
                .select("doc_id", "score", F.col("quality").cast("double").alias("label"))
                .withColumn("prediction", F.when(F.col("score") >= 0.25, 1.0).otherwise(0.0)))


_PAIRS_SQL = f"""WITH {S.LANG_INDEX},
guess AS (
  SELECT doc_id, lang, CASE WHEN contains(text, 'ñ') THEN 'es' WHEN contains(text, 'ß') THEN 'de'
    WHEN contains(text, 'ç') THEN 'fr' ELSE 'en' END AS g FROM documents),
pairs AS (
  SELECT doc_id, gi.label AS prediction, li.label AS label
  FROM guess JOIN lang_index li ON li.lang = guess.lang JOIN lang_index gi ON gi.lang = guess.g),
cm AS (SELECT label, prediction, count(*) AS n FROM pairs GROUP BY label, prediction),
lab AS (SELECT label, sum(n) AS n_label,
  sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
pred AS (SELECT prediction, sum(n) AS n_pred FROM cm GROUP BY prediction),
cls AS (
  SELECT lab.label, CAST(n_label AS BIGINT) AS n_label, CAST(tp AS BIGINT) AS tp,
    CAST(coalesce(n_pred, 0) AS BIGINT) AS n_pred,
    CASE WHEN coalesce(n_pred, 0) = 0 THEN 0.0 ELSE tp / n_pred END AS precision,
    tp / n_label AS recall
  FROM lab LEFT JOIN pred ON lab.label = pred.prediction),
cls2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
  ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM cls),
summary AS (
  SELECT CAST(sum(n_label) AS BIGINT) AS n, sum(tp) / sum(n_label) AS accuracy,
    sum(precision * n_label) / sum(n_label) AS weighted_precision,
    sum(recall * n_label) / sum(n_label) AS weighted_recall,
    sum(f1 * n_label) / sum(n_label) AS weighted_f1 FROM cls2)"""


@register("confusion_matrix", _PAIRS_SQL + "\nSELECT label, prediction, n FROM cm")
def confusion_matrix_query(spark, sf_dir):
    return confusion_matrix(lang_pairs(spark, sf_dir))


@register("class_metrics", _PAIRS_SQL + """
SELECT label, n_label, tp, n_pred, precision, recall, f1 FROM cls2""",
          round6=("precision", "recall", "f1"))
def class_metrics(spark, sf_dir):
    return class_table(lang_pairs(spark, sf_dir))


@register("metric_accuracy", _PAIRS_SQL + """
SELECT avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy,
  (SELECT accuracy FROM summary) AS accuracy_from_confusion FROM pairs""",
          round6=("accuracy", "accuracy_from_confusion"))
def metric_accuracy(spark, sf_dir):
    """Both routes of the original job: mean of hits, and from the
    confusion table."""
    pairs = lang_pairs(spark, sf_dir)
    direct = accuracy(pairs)
    via_cm = classification_summary(pairs).select(
        F.col("accuracy").alias("accuracy_from_confusion"))
    return direct.select("accuracy", via_cm.select("accuracy_from_confusion").scalar()
                         .alias("accuracy_from_confusion"))


@register("metric_weighted_precision", _PAIRS_SQL + """
SELECT n, weighted_precision FROM summary""", round6=('weighted_precision',))
def metric_weighted_precision(spark, sf_dir):
    return classification_summary(lang_pairs(spark, sf_dir)).select("n", "weighted_precision")


@register("metric_weighted_f1", _PAIRS_SQL + """
SELECT n, weighted_recall, weighted_f1 FROM summary""", round6=('weighted_recall', 'weighted_f1'))
def metric_weighted_f1(spark, sf_dir):
    return classification_summary(lang_pairs(spark, sf_dir)).select(
        "n", "weighted_recall", "weighted_f1")


def _curve_sql(score: str) -> str:
    return f"""WITH s AS (
  SELECT d.doc_id, CASE WHEN length(d.text) = 0 THEN 0.0
    ELSE 1.0 - length(regexp_replace(d.text, '[^A-Za-z]', '', 'g')) / length(d.text) END AS score,
    CAST(l.quality AS DOUBLE) AS label FROM documents d JOIN labels l USING (doc_id)),
s2 AS (SELECT doc_id, label, score,
  CASE WHEN score >= 0.25 THEN 1.0 ELSE 0.0 END AS prediction FROM s),
agg AS (SELECT CAST({score} AS DOUBLE) AS score, sum(label) AS pos, sum(1.0 - label) AS neg
  FROM s2 GROUP BY 1),
tot AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg FROM agg),
cum AS (SELECT score, pos, neg,
  sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM agg),
pts AS (
  SELECT score AS threshold, tp, fp,
    CASE WHEN n_pos = 0 THEN 0.0 ELSE tp / n_pos END AS tpr,
    CASE WHEN n_neg = 0 THEN 0.0 ELSE fp / n_neg END AS fpr,
    CASE WHEN n_pos = 0 THEN 0.0 ELSE (tp - pos) / n_pos END AS prev_tpr,
    CASE WHEN n_neg = 0 THEN 0.0 ELSE (fp - neg) / n_neg END AS prev_fpr,
    CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN (tp - pos) + (fp - neg) = 0
      THEN (CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END)
      ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END AS prev_precision,
    tp + fp = n_pos + n_neg AS is_last
  FROM cum, tot)"""


@register("metric_auroc", _curve_sql("score") + """
SELECT sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2
  + CASE WHEN is_last THEN (1 - fpr) * (tpr + 1) / 2 ELSE 0.0 END) AS auroc FROM pts""",
          round6=("auroc",))
def metric_auroc(spark, sf_dir):
    return area_under_roc(quality_scores(spark, sf_dir), "score", "label")


@register("metric_auroc_hard", _curve_sql("prediction") + """
SELECT sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2
  + CASE WHEN is_last THEN (1 - fpr) * (tpr + 1) / 2 ELSE 0.0 END) AS auroc FROM pts""",
          round6=("auroc",))
def metric_auroc_hard(spark, sf_dir):
    """The same area from 0/1 predictions: a three-point curve."""
    return area_under_roc(quality_scores(spark, sf_dir), "prediction", "label")


@register("metric_aupr", _curve_sql("score") + """
SELECT sum((tpr - prev_tpr) * (precision + prev_precision) / 2) AS aupr FROM pts""",
          round6=("aupr",))
def metric_aupr(spark, sf_dir):
    return area_under_pr(quality_scores(spark, sf_dir), "score", "label")


@register("roc_curve", _curve_sql("score") + """
SELECT threshold, fpr, tpr FROM pts""", round6=('threshold', 'fpr', 'tpr'))
def roc_curve(spark, sf_dir):
    return binary_curve(quality_scores(spark, sf_dir)).select("threshold", "fpr", "tpr")


@register("pr_curve", _curve_sql("score") + """
SELECT threshold, tpr AS recall, precision FROM pts""", round6=('threshold', 'recall', 'precision'))
def pr_curve(spark, sf_dir):
    return binary_curve(quality_scores(spark, sf_dir)).select(
        "threshold", F.col("tpr").alias("recall"), "precision")
