"""Shared inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import java_trim, strip_punctuation
from ..operators.partitioning import spread
from ..operators.sampling import hash_split
from ..operators.text import clean_column, remove_stop_words, tokenize
from ..operators.vectors import label_indexer
from ..session import load_table
from ..sources.lines import explode_lines


def english_label(lang_col: str = "lang"):
    """Binary label like ham/spam: 0.0 for English, 1.0 otherwise."""
    return F.when(F.col(lang_col) == "en", F.lit(0.0)).otherwise(F.lit(1.0))


def documents(spark: SparkSession, sf_dir: str, cols) -> DataFrame:
    """Columns of ``documents``, spread over the task slots when the scan has
    fewer splits (see ``partitioning.spread``); what follows is the same
    row-local plan either way."""
    return spread(load_table(spark, sf_dir, "documents").select(*cols), "doc_id")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` split into lines: (doc_id, line_no, label, line)."""
    docs = documents(spark, sf_dir, ["doc_id", english_label().alias("label"), "text"])
    return explode_lines(docs, "text", "line", "line_no", keep=("doc_id", "label"))


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, label, clean): each line stripped, trimmed and
    lower-cased.

    Stripping and lower-casing map characters one by one and keep the
    newline, so they run once per document, before the split; only the trim
    is per line."""
    docs = documents(spark, sf_dir, ["doc_id", english_label().alias("label"), "text"])
    docs = docs.select("doc_id", "label", F.lower(strip_punctuation("text")).alias("text"))
    lines = explode_lines(docs, "text", "line", "line_no", keep=("doc_id", "label"))
    return lines.select("doc_id", "line_no", "label", java_trim("line").alias("clean"))


def line_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, label, terms): tokenised, stop words removed."""
    toks = tokenize(clean_lines(spark, sf_dir), "clean", "words")
    return remove_stop_words(toks, "words", "terms").select(
        "doc_id", "line_no", "label", "terms")


# The seed all the original jobs passed to their splits.
SPLIT_SEED = 98765


def doc_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents: (doc_id, lang, terms)."""
    docs = documents(spark, sf_dir, ["doc_id", "lang", "text"])
    toks = tokenize(clean_column(docs, "text", "clean"), "clean", "words")
    return remove_stop_words(toks, "words", "terms").select("doc_id", "lang", "terms")


def lang_label_model(spark: SparkSession, sf_dir: str, split):
    """Indexer of ``lang`` (most frequent -> 0.0, ties alphabetical), fitted
    on the training part of a split by document."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang")
    train = hash_split(docs, ["doc_id"], list(split), SPLIT_SEED)[0]
    return label_indexer("lang", "label", handle_invalid="skip").fit(train)
