"""Text features in long form: hashed TF, IDF, TF-IDF, L2 normalisation.

A document's feature vector is the set of rows ``(keys..., bucket,
weight)``; a document with no term keeps one row with a null bucket and
weight 0 when ``keep_empty`` is set, so that it survives to scoring without
an outer join.  Everything is built-in SQL: explode, partial aggregation,
a broadcast of tables whose size is bounded by the number of buckets, and
a window per document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import term_bucket


def hash_terms(df: DataFrame, tokens_col: str, num_buckets: int = 10000, algo: str = "murmur3") -> DataFrame:
    """Each row's terms as an array of their buckets, in place: four bytes a
    term, for tables that are written or exchanged before they are counted."""
    def bucket(term):
        return F.when(term.isNotNull(), term_bucket(term, num_buckets, algo).cast("int"))
    return df.withColumn(tokens_col, F.transform(tokens_col, bucket))


def hashed_tf(df: DataFrame, keys, tokens_col: str, num_buckets: int = 10000,
              algo: str | None = "murmur3", keep_empty: bool = False) -> DataFrame:
    """Term counts per hash bucket: ``(keys..., bucket int, tf double)``.

    The count is partial per task before the shuffle (all tokens of a
    document are exploded in the task that holds it), so the shuffle
    carries one row per distinct (document, bucket), the size of a sparse
    TF vector.  If ``df`` is already hash-partitioned by a subset of
    ``keys`` (see ``partitioning.by_key``) there is no shuffle at all.
    Without ``algo`` the tokens are buckets already (see ``hash_terms``).
    """
    keys = list(keys)
    exploded = df.select(*keys, F.explode_outer(tokens_col).alias("__term"))
    if not keep_empty:
        # Same rows as ``explode``, without its inferred size filter (see
        # ``operators.text.explode_elements``).
        exploded = exploded.where(F.col("__term").isNotNull())
    bucket = (F.when(F.col("__term").isNull(), F.lit(None).cast("int"))
               .otherwise(term_bucket("__term", num_buckets, algo) if algo else F.col("__term")))
    return (exploded.groupBy(*keys, bucket.alias("bucket"))
                    .agg(F.count("__term").cast("double").alias("tf")))


@dataclass
class IdfModel:
    """Fitted IDF: ``weights`` has ``(bucket, doc_freq, idf)`` for every
    bucket seen in training (at most ``num_buckets`` rows); an unseen
    bucket has document frequency 0, so ``idf = ln(n_docs + 1)``."""
    weights: DataFrame
    n_docs: Column

    @property
    def default_idf(self) -> Column:
        return F.log(self.n_docs.cast("double") + F.lit(1.0))


def idf_fit(tf: DataFrame, docs: DataFrame | None, min_doc_freq: int = 0,
            n_docs: int | None = None) -> IdfModel:
    """``idf = ln((m + 1) / (df + 1))``; buckets with ``df < min_doc_freq``
    get 0.  ``m`` counts the training rows in ``docs`` (rows without any
    term count too), as a scalar subquery: no cross join, no collect; a
    caller that already knows it passes ``n_docs`` instead."""
    n_docs = (F.lit(n_docs) if n_docs is not None
              else docs.select(F.count(F.lit(1))).scalar())
    doc_freq = (tf.where(F.col("bucket").isNotNull())
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("doc_freq")))
    idf = F.log((n_docs.cast("double") + 1.0) / (F.col("doc_freq") + 1.0))
    if min_doc_freq > 0:
        idf = F.when(F.col("doc_freq") >= min_doc_freq, idf).otherwise(F.lit(0.0))
    return IdfModel(doc_freq.select("bucket", "doc_freq", idf.alias("idf")), n_docs)


def tfidf(tf: DataFrame, model: IdfModel, out_col: str = "weight") -> DataFrame:
    """Multiply each TF by its bucket's IDF.  The IDF table has at most one
    row per bucket (``num_buckets``), a fixed bound, so it is broadcast and
    the TF rows never move."""
    joined = tf.join(F.broadcast(model.weights.select("bucket", "idf")), "bucket", "left")
    idf = F.coalesce(F.col("idf"), model.default_idf)
    cols = [c for c in tf.columns if c != "tf"]
    return joined.select(*cols, (F.col("tf") * idf).alias(out_col))


def l2_normalize(df: DataFrame, keys, weight_col: str = "weight",
                 out_col: str | None = None) -> DataFrame:
    """Divide each weight by the L2 norm of its document; an all-zero
    document stays zero.  A window per document: with input clustered by
    the document key it needs no exchange."""
    w = Window.partitionBy(*keys)
    norm = F.sqrt(F.sum(F.col(weight_col) * F.col(weight_col)).over(w))
    scaled = F.when(norm > 0, F.col(weight_col) / norm).otherwise(F.lit(0.0))
    return df.withColumn(out_col or weight_col, scaled)
