"""Hashed TF -> IDF -> L2 -> naive Bayes as one fitted unit.

Two forms: rows of (document, bucket, weight), and one sparse vector per
document (``fit_text_vectors``).  The vector form is row-local from text to
score; no exchange carries text or features, whatever the input's layout.

The long form:

This is the six-stage text pipeline (tokenizer, stop words, hashing, IDF,
normaliser, naive Bayes) with the token steps done by the caller, so the
same fitted model scores any frame of token arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .features import IdfModel, hashed_tf, idf_fit, l2_normalize, tfidf
from .naive_bayes import (NaiveBayesModel, naive_bayes_from_stats, naive_bayes_score,
                          naive_bayes_stats)


@dataclass
class TextNaiveBayesModel:
    idf: IdfModel
    nb: NaiveBayesModel
    num_buckets: int
    algo: str


def fit_text_naive_bayes(train: DataFrame, keys, tokens_col: str = "terms",
                         label_col: str = "label", num_buckets: int = 10000,
                         algo: str = "murmur3", smoothing: float = 1.0) -> TextNaiveBayesModel:
    """Fit IDF and naive Bayes on ``train`` (one row per document).

    The text work runs once: the training TF rows are persisted and every
    statistic is read from them -- rows per class (k numbers, read to the
    driver in the same job that fills the cache), document frequencies,
    then feature sums.  The two fitted tables, at most ``num_buckets`` rows
    for IDF and ``k * num_buckets`` for the sums, are written to the
    shared folder, so scoring reads them instead of re-running training.
    """
    keys = list(keys)
    carry = keys + [label_col]
    spark = train.sparkSession
    tf = hashed_tf(train, carry, tokens_col, num_buckets, algo, keep_empty=True)
    tf = tf.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # keep_empty leaves every document at least one row; with the input
        # clustered by document this distinct needs no exchange.
        docs = tf.select(*carry).distinct()
        per_class = docs.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_docs")).collect()
        n_docs = sum(r["n_docs"] for r in per_class)
        counts = spark.createDataFrame(
            [(float(r[label_col]), int(r["n_docs"])) for r in per_class],
            f"{label_col} double, n_docs bigint")
        fitted = idf_fit(tf, None, n_docs=n_docs)
        idf = IdfModel(materialize(fitted.weights, "idf"), F.lit(n_docs))
        feats = l2_normalize(tfidf(tf, idf), keys)
        _, sums = naive_bayes_stats(feats, docs.select(label_col), label_col)
        nb = naive_bayes_from_stats(counts, materialize(sums, "nb-sums"), label_col,
                                    num_buckets, smoothing)
    finally:
        tf.unpersist()
    return TextNaiveBayesModel(idf, nb, num_buckets, algo)


def score_text_naive_bayes(model: TextNaiveBayesModel, df: DataFrame, keys,
                           tokens_col: str = "terms",
                           label_col: str | None = "label") -> DataFrame:
    """``keys..., [label,] prediction, score, probability`` per row.

    TF -> TF-IDF with the fitted IDF (broadcast), then one aggregate per
    document that also applies the L2 scaling (see ``naive_bayes_score``):
    with input clustered by document, no exchange and no sort."""
    carry = list(keys) + ([label_col] if label_col else [])
    tf = hashed_tf(df, carry, tokens_col, model.num_buckets, model.algo, keep_empty=True)
    return naive_bayes_score(model.nb, tfidf(tf, model.idf), carry, label_col or "label",
                             l2_normalize=True)


def fit_text_vectors(train: DataFrame, tokens_col: str = "terms", label_col: str = "label",
                     num_features: int = 10000, smoothing: float = 1.0) -> PipelineModel:
    """HashingTF -> IDF -> Normalizer -> NaiveBayes fitted on token arrays.

    The training term vectors are written once to the shared folder; the two
    fits, each a tree aggregate of fixed-size vectors, read them there."""
    hashing = HashingTF(inputCol=tokens_col, outputCol="tf", numFeatures=num_features)
    tf = materialize(hashing.transform(train.select(label_col, tokens_col)).select(label_col, "tf"), "tf")
    idf = IDF(inputCol="tf", outputCol="tfidf").fit(tf)
    unit = Normalizer(inputCol="tfidf", outputCol="features", p=2.0)
    bayes = NaiveBayes(featuresCol="features", labelCol=label_col, smoothing=smoothing,
                       modelType="multinomial").fit(unit.transform(idf.transform(tf)))
    return PipelineModel(stages=[hashing, idf, unit, bayes])


def score_text_vectors(model: PipelineModel, df: DataFrame, keep) -> DataFrame:
    """``keep..., prediction, score, probability``: the winning class, its
    raw score and its probability."""
    out = model.transform(df)
    best = F.col("prediction").cast("int") + 1
    return out.select(*keep, "prediction",
                      F.element_at(vector_to_array("rawPrediction"), best).alias("score"),
                      F.element_at(vector_to_array("probability"), best).alias("probability"))
