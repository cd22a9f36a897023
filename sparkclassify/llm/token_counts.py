"""Exact token-length histogram with suffix sums.

Documents are encoded once and counted by encoded length; from then on only
the histogram is read, at most one row per distinct length.  With documents
and tokens summed from a length upwards (suffix sums) it answers, exactly and
for every context limit, how many documents are cut, how many tokens remain
when each is truncated to the limit, and any quantile.

Counting combines in each task before the exchange, so a length shared by a
third of all rows costs one row per task.  Suffix sums run in bands of
``BAND`` lengths in parallel, on top of the totals of the bands above.

Defined results: a null or empty text has length 0 and is counted; an empty
table gives an empty histogram, zero totals and null quantiles; repeated rows
count each time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import share_vocabulary, texts_of, worker_encoder
from .common import settle, tidy

BAND = 1024


def encoded_lengths(rows: DataFrame, text_col: str, vocabulary) -> DataFrame:
    """``n_tokens`` of every row."""
    def run(batches):
        with worker_encoder(vocabulary) as encoder:
            for batch in batches:
                sizes = [len(encoder.encode(t)) // 4 for part in texts_of(batch.column(0)) for t in part]
                yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return rows.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "n_tokens long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length with its suffix sums:

    ``documents`` of exactly this length, ``documents_up`` and ``tokens_up``
    of this length or more, ``documents_below``, ``tokens_below``, and
    ``tokens_at_limit``: all tokens that remain if every document is
    truncated to this length.
    """
    counts = settle(lengths.groupBy(F.col(length_col).alias("n_tokens"))
                    .agg(F.count("*").alias("documents"))
                    .withColumn("band", F.floor(F.col("n_tokens") / BAND)))
    tokens = F.col("documents") * F.col("n_tokens")
    bands = counts.groupBy("band").agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
    above = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = bands.select(
        "band", F.coalesce(F.sum("d").over(above), zero).alias("d_above"),
        F.coalesce(F.sum("t").over(above), zero).alias("t_above"),
        F.coalesce(F.sum("d").over(below), zero).alias("d_below"),
        F.coalesce(F.sum("t").over(below), zero).alias("t_below"))
    up = Window.partitionBy("band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("band").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(offsets, "band").select(
        "n_tokens", "documents",
        (F.col("d_above") + F.sum("documents").over(up)).alias("documents_up"),
        (F.col("t_above") + F.sum(tokens).over(up)).alias("tokens_up"),
        (F.col("d_below") + F.coalesce(F.sum("documents").over(down), zero)).alias("documents_below"),
        (F.col("t_below") + F.coalesce(F.sum(tokens).over(down), zero)).alias("tokens_below"),
    ).withColumn("tokens_at_limit", F.col("tokens_below") + F.col("n_tokens") * F.col("documents_up"))


def limit_totals(histogram: DataFrame, limits) -> DataFrame:
    """For each context limit: documents cut by it and tokens that remain."""
    sums = []
    for k, limit in enumerate(limits):
        cut = F.col("n_tokens") > limit
        sums += [F.coalesce(F.sum(F.when(cut, F.col("documents"))), F.lit(0)).alias(f"cut{k}"),
                 F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("documents")), F.lit(0)).alias(f"kept{k}")]
    rows = ", ".join(f"{int(limit)}L, cut{k}, kept{k}" for k, limit in enumerate(limits))
    return histogram.agg(*sums).selectExpr(
        f"stack({len(limits)}, {rows}) AS (context_limit, documents_cut, tokens_kept)")


def length_quantiles(histogram: DataFrame, shares) -> DataFrame:
    """The smallest length with at least ``share`` of all documents at or
    under it, for each share in (0, 1]."""
    reached = F.col("documents_below") + F.col("documents")
    total = F.col("documents_below") + F.col("documents_up")
    cells = [F.min(F.when(reached >= F.ceil(F.lit(float(s)) * total), F.col("n_tokens"))).alias(f"q{k}")
             for k, s in enumerate(shares)]
    rows = ", ".join(f"{float(s)}D, q{k}" for k, s in enumerate(shares))
    return histogram.agg(*cells).selectExpr(f"stack({len(shares)}, {rows}) AS (share, n_tokens)")


def op6_token_counts(spark, sf_dir):
    """The length histogram of all ``documents`` with its suffix sums."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return length_histogram(encoded_lengths(docs, "text", share_vocabulary(spark)))
