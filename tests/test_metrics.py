"""Evaluation: golden values from the recorded run, parity with Spark's
evaluators, edge cases, and independence from the block layout."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sparkclassify.operators.cleaning import score_label_pairs
from sparkclassify.operators.metrics import (accuracy, area_under_pr, area_under_roc,
                                             binary_curve, class_table, classification_summary,
                                             confusion_matrix)
from sparkclassify.plans.metric_queries import lang_pairs, quality_scores

from .conftest import SF_MEDIUM
from .fixtures import IRIS_PAIRS, pairs_with_nulls, tied_scores


def _pairs(spark, rows):
    return spark.createDataFrame([(p, lab) for lab, p in rows], "prediction double, label double")


def test_iris_golden(spark):
    s = classification_summary(_pairs(spark, IRIS_PAIRS)).first()
    assert s.n == 14
    assert s.accuracy == pytest.approx(0.928571, abs=1e-6)
    assert s.weighted_precision == pytest.approx(0.942857, abs=1e-6)
    assert s.weighted_f1 == pytest.approx(0.929792, abs=1e-6)
    assert accuracy(_pairs(spark, IRIS_PAIRS)).first().accuracy == pytest.approx(13 / 14)
    cm = {(r.label, r.prediction): r.n for r in confusion_matrix(_pairs(spark, IRIS_PAIRS)).collect()}
    assert cm == {(0.0, 0.0): 3, (1.0, 1.0): 4, (2.0, 2.0): 6, (2.0, 1.0): 1}


@pytest.mark.parametrize("metric,col", [("accuracy", "accuracy"),
                                        ("weightedPrecision", "weighted_precision"),
                                        ("weightedRecall", "weighted_recall"),
                                        ("f1", "weighted_f1")])
def test_class_metrics_equal_evaluator(spark, metric, col):
    pairs = lang_pairs(spark, SF_MEDIUM)
    want = MulticlassClassificationEvaluator(metricName=metric).evaluate(pairs)
    assert classification_summary(pairs).first()[col] == pytest.approx(want, abs=1e-12)


def test_class_never_predicted(spark):
    rows = [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]  # (label, prediction)
    pairs = _pairs(spark, rows)
    t = {r.label: r for r in class_table(pairs).collect()}
    assert t[1.0].precision == 0.0 and t[1.0].f1 == 0.0 and t[1.0].n_pred == 0
    want = MulticlassClassificationEvaluator(metricName="weightedPrecision").evaluate(pairs)
    assert classification_summary(pairs).first().weighted_precision == pytest.approx(want)


def test_pairs_with_nulls_are_skipped(spark):
    got = score_label_pairs(pairs_with_nulls(spark)).collect()
    assert len(got) == 4 and all(r.prediction is not None and r.label is not None for r in got)


def _evaluator_area(df, metric):
    from pyspark.ml.functions import array_to_vector
    vec = df.select(array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("rawPrediction"),
                    "label")
    return BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(vec)


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_areas_equal_evaluator_with_ties(spark, blocks):
    df = tied_scores(spark)
    roc = area_under_roc(df, num_blocks=blocks).first().auroc
    pr = area_under_pr(df, num_blocks=blocks).first().aupr
    assert roc == pytest.approx(_evaluator_area(df, "areaUnderROC"), abs=1e-12)
    assert pr == pytest.approx(_evaluator_area(df, "areaUnderPR"), abs=1e-12)


def test_areas_equal_evaluator_on_table(spark):
    df = quality_scores(spark, SF_MEDIUM)
    assert area_under_roc(df).first().auroc == pytest.approx(
        _evaluator_area(df, "areaUnderROC"), abs=1e-12)
    assert area_under_pr(df).first().aupr == pytest.approx(
        _evaluator_area(df, "areaUnderPR"), abs=1e-12)


def test_curve_is_monotone_and_ends_at_one(spark):
    c = binary_curve(quality_scores(spark, SF_MEDIUM), num_blocks=5).orderBy(F.desc("threshold")).collect()
    tprs = [r.tpr for r in c]
    fprs = [r.fpr for r in c]
    assert tprs == sorted(tprs) and fprs == sorted(fprs)
    assert tprs[-1] == pytest.approx(1.0) and fprs[-1] == pytest.approx(1.0)


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_scores(spark, label):
    df = spark.createDataFrame([(0.2, label), (0.7, label), (0.7, label)], "score double, label double")
    assert area_under_roc(df).first().auroc == pytest.approx(_evaluator_area(df, "areaUnderROC"))
    assert area_under_pr(df).first().aupr == pytest.approx(_evaluator_area(df, "areaUnderPR"))
