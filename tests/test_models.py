"""Estimators: invariants, the original jobs' traps, quality floors."""

import pytest
from pyspark.sql import functions as F

from sparkclassify.operators.metrics import area_under_roc, classification_summary
from sparkclassify.operators.models import (build_pipeline, logistic_regression, random_forest,
                                            text_naive_bayes_pipeline)
from sparkclassify.operators.tuning import grid_rows, param_grid
from sparkclassify.operators.vectors import assembler, label_indexer
from sparkclassify.plans.jobs import FULL_GRID, logistic_job, text_naive_bayes, tuned_forest

from .conftest import SF_MEDIUM
from .fixtures import flowers, mail


def test_full_grid_has_120_candidates():
    rf = random_forest()
    assert len(param_grid(rf, FULL_GRID)) == 120
    rows = grid_rows(FULL_GRID)
    assert len(rows) == 120 and rows[0] == {"numTrees": 8, "maxDepth": 4, "impurity": "gini"}


def test_forest_invariants_and_seed(spark):
    df = flowers(spark)
    pipe = build_pipeline(label_indexer("species", "label"),
                          assembler(["f1", "f2", "f3", "f4"], "features"),
                          random_forest(num_trees=10, max_depth=4, seed=7))
    a = pipe.fit(df).transform(df)
    rows = a.select("probability", "prediction").collect()
    for r in rows:
        p = r.probability.toArray()
        assert sum(p) == pytest.approx(1.0)
        assert int(p.argmax()) == int(r.prediction)
    b = pipe.fit(df).transform(df)
    assert [r.prediction for r in a.collect()] == [r.prediction for r in b.collect()]


def test_elastic_net_without_strength_has_no_effect(spark):
    df = assembler(["f1", "f2", "f3", "f4"], "features").transform(
        flowers(spark).where("species != 'Iris-setosa'")
        .withColumn("label", (F.col("species") == "Iris-virginica").cast("double")))
    m0 = logistic_regression(elastic_net=0.0).fit(df)
    m1 = logistic_regression(elastic_net=0.75).fit(df)
    assert list(m0.coefficients) == pytest.approx(list(m1.coefficients))


def test_one_class_naive_bayes(spark):
    """Training on one class gives a one-class model: probability [1.0],
    prediction 0.0."""
    df = mail(spark).where("label = 0.0").withColumn("t", F.lower("text"))
    out = text_naive_bayes_pipeline("t", "label").fit(df).transform(df)
    r = out.first()
    assert list(r.probability.toArray()) == [1.0] and r.prediction == 0.0


# Two candidates: the full grid is searched by the registered queries.
SMALL_GRID = {"numTrees": (8, 16), "maxDepth": (10,), "impurity": ("gini",)}


def test_job_forest_multiclass_floor(spark):
    preds, _, search = tuned_forest(spark, SF_MEDIUM, "lang", 0.85, SMALL_GRID)
    assert classification_summary(preds).first().weighted_f1 >= 0.95
    assert len(search.metrics) == 2 and search.metrics[search.best] == max(search.metrics)
    assert search.train_rows + search.validation_rows == 852


def test_job_forest_binary_beats_majority_class(spark):
    """J2 on sf0.01: weighted F1 must beat always predicting the most
    frequent class of the same test rows."""
    preds = tuned_forest(spark, SF_MEDIUM, "quality", 0.80, SMALL_GRID)[0]
    s = classification_summary(preds).first()
    majority = preds.groupBy("label").count().orderBy(F.desc("count")).first()["label"]
    base = classification_summary(preds.withColumn("prediction", F.lit(majority))).first()
    assert s.weighted_f1 > base.weighted_f1 + 0.05, (s, base)


def test_job_logistic_floor(spark):
    preds = logistic_job(spark, SF_MEDIUM)[0]
    auroc = area_under_roc(preds, "raw_score", "label").first().auroc
    assert auroc >= 0.75
    assert preds.where((F.col("p") >= 0.5) != (F.col("prediction") == 1.0)).count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_job_text_naive_bayes_floor(spark):
    preds = text_naive_bayes(spark, SF_MEDIUM)
    s = classification_summary(preds).first()
    assert s.n == 1855
    assert s.weighted_f1 >= 0.95
