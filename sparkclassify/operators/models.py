"""Estimators, pipelines and batch scoring (``pyspark.ml``).

Spark's tree, gradient and Bayes solvers are already distributed (level-wise
tree growth with per-node statistics aggregated across executors; L-BFGS
with gradient sums by tree aggregation), so they are used as they are.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.feature import IDF, HashingTF, Normalizer, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame


FOREST_SEED = 98765

# Forests on so many partitions or more have their node ids checkpointed every
# so many levels.
LINEAGE_PARTITIONS = 32
LINEAGE_LEVELS = 4


def random_forest(features_col: str = "features", label_col: str = "label",
                  num_trees: int = 20, max_depth: int = 5, impurity: str = "gini",
                  feature_subset: str = "sqrt", seed: int = FOREST_SEED,
                  **params) -> RandomForestClassifier:
    """Random forest; ``sqrt`` features per split as in the original jobs.
    The seed is fixed (PySpark's own default is a string hash that changes
    with every process).  Each row's node of each tree is kept from level to
    level (``cacheNodeIds``, in memory only) instead of being sought from the
    root: the same trees, sooner."""
    params = {"cacheNodeIds": True, "checkpointInterval": -1, **params}
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col,
                                numTrees=num_trees, maxDepth=max_depth,
                                impurity=impurity, featureSubsetStrategy=feature_subset,
                                seed=seed, **params)
    return rf


def with_short_lineage(forest: RandomForestClassifier, partitions: int) -> RandomForestClassifier:
    """The forest as it is fitted on a table of ``partitions``.  Every task of a
    level reads the lineage of the kept node ids, which holds all splits made
    since their last checkpoint; that cost grows with partitions times nodes, so
    with many partitions the node ids are checkpointed every few levels.  The
    trees are the same.  An interval of the caller's own stays."""
    if partitions < LINEAGE_PARTITIONS or forest.getCheckpointInterval() != -1:
        return forest
    return forest.copy({forest.checkpointInterval: LINEAGE_LEVELS})


def logistic_regression(features_col: str = "features", label_col: str = "label",
                        reg_param: float = 0.0, elastic_net: float = 0.75,
                        family: str = "auto", max_iter: int = 100) -> LogisticRegression:
    """Logistic regression.  The original set elastic net 0.75 but never a
    regularisation strength, so the mix had no effect (strength 0); both are
    exposed and 0.0 stays the default."""
    return LogisticRegression(featuresCol=features_col, labelCol=label_col,
                              regParam=reg_param, elasticNetParam=elastic_net,
                              family=family, maxIter=max_iter)


def text_naive_bayes_pipeline(text_col: str, label_col: str = "label",
                              num_features: int = 10000,
                              smoothing: float = 1.0) -> Pipeline:
    """The six-stage vector-form text pipeline: Tokenizer -> StopWordsRemover
    -> HashingTF -> IDF -> Normalizer -> NaiveBayes.  Every stage is
    row-wise except IDF and NaiveBayes, whose fits are tree aggregates of
    fixed-size vectors (``num_features`` and ``k * num_features``)."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text_col, outputCol="__words"),
        StopWordsRemover(inputCol="__words", outputCol="__terms"),
        HashingTF(inputCol="__terms", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="__tfidf"),
        Normalizer(inputCol="__tfidf", outputCol="features", p=2.0),
        NaiveBayes(featuresCol="features", labelCol=label_col, smoothing=smoothing,
                   modelType="multinomial"),
    ])


def build_pipeline(*stages) -> Pipeline:
    """Ordered stages; a fitted model may be a stage too."""
    return Pipeline(stages=list(stages))


def score(model, df: DataFrame, keep=None, probability_of: int | None = None) -> DataFrame:
    """Batch scoring: ``rawPrediction``, ``probability``, ``prediction`` are
    added by ``model.transform``; ``keep`` selects what to return, and
    ``probability_of`` adds that class's probability as a plain double."""
    out = model.transform(df)
    if probability_of is not None:
        out = out.withColumn("p", vector_to_array("probability")[probability_of])
    if keep:
        cols = list(keep) + ["prediction"] + (["p"] if probability_of is not None else [])
        out = out.select(*cols)
    return out


def lr_coefficients(model, feature_names, spark=None) -> DataFrame:
    """Coefficient matrix and intercepts as rows ``(class_index, feature,
    coefficient)``; the intercept is feature ``(intercept)``.  The model's
    parameters are on the driver already (classes x features numbers)."""
    spark = spark or model.summary.predictions.sparkSession
    matrix = model.coefficientMatrix.toArray()
    intercepts = model.interceptVector.toArray()
    rows = []
    for k in range(matrix.shape[0]):
        rows.extend((k, name, float(matrix[k, j])) for j, name in enumerate(feature_names))
        rows.append((k, "(intercept)", float(intercepts[k])))
    return spark.createDataFrame(rows, "class_index int, feature string, coefficient double")


def feature_importances(model, feature_names, spark) -> DataFrame:
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(feature_names, imp)],
                                 "feature string, importance double")
