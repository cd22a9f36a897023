"""A training-data pipeline over ``documents``.

Five stages, each the operator of ``sparkclassify.llm`` named beside it, each
over everything its predecessor kept.  A stage takes ``(spark, docs, sf_dir)``
and returns a DataFrame; between stages the result is written as Parquet and
read again.  All stages but the last return the columns of ``documents``; the
last returns the token ids of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkclassify.llm.bpe import share_vocabulary, token_digests
from sparkclassify.llm.mixing import domain_of_labels, mix
from sparkclassify.llm.near_duplicates import keep_one_per_component
from sparkclassify.llm.pii import sanitise
from sparkclassify.llm.quality import quality_filter
from sparkclassify.session import shared_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the smallest id."""
    return keep_one_per_component(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced in the texts."""
    return sanitise(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go by the rates that meet the domain targets."""
    return mix(docs, domain_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded bytes."""
    return token_digests(docs, "doc_id", "text", share_vocabulary(spark), with_ids=True)


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix_domains),
    ("byte-level BPE", encode_tokens),
]

# SQL has neither the tokenizer nor the fitted classifier; the stages are
# tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written below the
    shared checkpoint folder and read by the next (``release_tables`` deletes
    it once the result has been consumed)."""
    root = shared_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
