"""Queries for text features (F1-F4) and long-form naive Bayes (M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.features import hash_terms, hashed_tf, idf_fit, l2_normalize, tfidf
from ..operators.partitioning import by_key
from ..operators.sampling import hash_split
from ..operators.text_model import fit_text_naive_bayes, fit_text_vectors, score_text_vectors
from ..session import materialize
from . import sqlparts as S
from .catalog import register
from .common import SPLIT_SEED, doc_terms, lang_label_model, line_terms

LINE_KEYS = ["doc_id", "line_no"]

_MURMUR_SQL = f"""WITH {S.LINE_TERMS},
exploded AS (SELECT doc_id, line_no, unnest(terms) AS term FROM line_terms),
{S.murmur3_buckets('exploded', byte_tail=True)}
SELECT doc_id, line_no, bucket, CAST(count(*) AS DOUBLE) AS tf
FROM exploded JOIN term_bucket USING (term) GROUP BY ALL"""

_TF_SQL = f"""WITH {S.LINE_TERMS},
tf AS (
  SELECT doc_id, line_no, {S.md5_bucket('term')} AS bucket, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT doc_id, line_no, unnest(terms) AS term FROM line_terms)
  GROUP BY ALL),
idf AS (
  SELECT bucket, count(*) AS doc_freq,
    ln((CAST((SELECT count(*) FROM line_terms) AS DOUBLE) + 1.0) / (count(*) + 1.0)) AS idf
  FROM tf GROUP BY bucket),
w AS (SELECT doc_id, line_no, bucket, tf * idf AS weight FROM tf JOIN idf USING (bucket))"""


@register("hashed_tf", _TF_SQL + "\nSELECT doc_id, line_no, bucket, tf FROM tf")
def hashed_tf_query(spark, sf_dir):
    """Term counts per (line, md5 bucket of 10000)."""
    return hashed_tf(line_terms(spark, sf_dir), LINE_KEYS, "terms", 10000, "md5")


@register("hashed_tf_murmur3", _MURMUR_SQL)
def hashed_tf_murmur3(spark, sf_dir):
    """Same with the Murmur3 buckets of the original runs."""
    return hashed_tf(line_terms(spark, sf_dir), LINE_KEYS, "terms", 10000, "murmur3")


def _line_tf_idf(spark, sf_dir):
    """(TF rows, IDF): terms are hashed once, and one row per line, its buckets
    as an array, is written.  That table is exchanged by line, before terms are
    exploded: counts, document frequencies and the norm per line all read this
    one exchange, and no TF row is exchanged or written."""
    lines = materialize(hash_terms(line_terms(spark, sf_dir).select(*LINE_KEYS, "terms"), "terms", 10000, "md5"), "buckets")
    tf = hashed_tf(by_key(lines, LINE_KEYS), LINE_KEYS, "terms", algo=None, keep_empty=True)
    return tf.where(F.col("bucket").isNotNull()), idf_fit(tf, lines.select(*LINE_KEYS).distinct())


@register("idf_weights", _TF_SQL + "\nSELECT bucket, doc_freq, idf FROM idf", round6=('idf',))
def idf_weights(spark, sf_dir):
    _, idf = _line_tf_idf(spark, sf_dir)
    return idf.weights


@register("tfidf", _TF_SQL + "\nSELECT doc_id, line_no, bucket, weight FROM w", round6=('weight',))
def tfidf_query(spark, sf_dir):
    tf, idf = _line_tf_idf(spark, sf_dir)
    return tfidf(tf, idf)


@register("l2_normalize", _TF_SQL + """
SELECT doc_id, line_no, bucket,
  CASE WHEN sqrt(sum(weight * weight) OVER (PARTITION BY doc_id, line_no)) > 0
       THEN weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id, line_no))
       ELSE 0.0 END AS weight
FROM w""", round6=('weight',))
def l2_normalize_query(spark, sf_dir):
    tf, idf = _line_tf_idf(spark, sf_dir)
    return l2_normalize(tfidf(tf, idf), LINE_KEYS)


# Whole documents, 4 languages: label = index of lang, split by doc id.
_DOC_SRC = f"""WITH {S.DOC_TERMS}, {S.lang_index(S.split_part(['doc_id'], [0.8, 0.2], SPLIT_SEED) + ' = 0')},
src AS (
  SELECT doc_id, li.label, terms, {S.split_part(['doc_id'], [0.8, 0.2], SPLIT_SEED)} AS part
  FROM doc_terms JOIN lang_index li USING (lang)),
{{chain}}"""
_LONG_SQL = _DOC_SRC.format(chain=S.nb_chain('src', 'doc_id'))
_VECTOR_SQL = _DOC_SRC.format(chain=S.nb_chain('src', 'doc_id', murmur=True))


def _doc_parts(spark, sf_dir):
    split = [0.8, 0.2]
    docs = lang_label_model(spark, sf_dir, split).transform(doc_terms(spark, sf_dir))
    return hash_split(docs.select("doc_id", "label", "terms"), ["doc_id"], split, SPLIT_SEED)


@register("nb_model", _LONG_SQL + """
SELECT th.label, th.bucket, c.log_prior, th.log_theta
FROM nb_theta th JOIN nb_c c USING (label)""", round6=('log_prior', 'log_theta'))
def nb_model(spark, sf_dir):
    """Fitted long-form model: per (class, bucket) log prior and log theta."""
    train, _ = _doc_parts(spark, sf_dir)
    model = fit_text_naive_bayes(train, ["doc_id"], algo="md5").nb
    return (model.theta.join(model.classes.select("label", "log_prior"), "label")
            .select("label", "bucket", "log_prior", "log_theta"))


@register("nb_score", _VECTOR_SQL + """
SELECT doc_id, label, prediction, score, probability FROM nb_scored""",
          round6=("score", "probability"))
def nb_score(spark, sf_dir):
    """Held-out documents scored by the vector-form model fitted on the
    training part."""
    train, test = _doc_parts(spark, sf_dir)
    return score_text_vectors(fit_text_vectors(train), test, ["doc_id", "label"])
