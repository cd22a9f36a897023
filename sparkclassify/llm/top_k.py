"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are turned into integers, ``floor(scale * x)``.  A candidate block is
a set of posting lists, one per dimension ("term"): the candidates whose
component is not zero, and those components.  A query is sparse too: each of
its non-zero components scatters ``weight * component`` over its posting list
into the dense score array of the block.  The best ``k`` of an array are taken
by partition selection; the lists of all blocks merge per query.

Queries and candidates meet as blocks: every query chunk with every candidate
chunk, one bounded pair per group, so no task holds more than two chunks and
what is sent is blocks, not pairs of rows.  Of equal candidate rows only ``k``
are sent, and rows go to chunks by a hash, so no repeated row fills a chunk.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; an empty vector scores 0 with all.  A candidate with the query's own id is never its
result.  Vectors of different lengths meet on their common dimensions.  Rows
repeated as candidates count each time; query rows with one id and one vector
are one query.  Ties go to the smaller id.  Sums are exact below 2^53, rounded
as doubles beyond, and end at the range of 64-bit integers; an empty table of
queries or candidates gives no rows; other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TopKConfig:
    k: int = 5
    scale: float = 256.0
    query_chunk: int = 2048
    candidate_chunk: int = 8192
    block: int = 2048            # candidates scored at a time


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``(id, v)`` of the usable rows; ``v`` holds whole doubles (from 2^53 on
    a double is whole as it is)."""
    def whole(y):
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    x = F.transform(vector_col, lambda c: c.cast("double"))
    usable = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & usable).select(
        F.col(id_col).alias("id"),
        F.transform(x, lambda c: whole(c * scale)).alias("v"))


def as_longs(scores: np.ndarray) -> list[int]:
    """Scores as 64-bit integers; beyond their range the nearest one, and 0
    where infinite terms cancel."""
    top = float(1 << 63)
    return [0 if x != x else (1 << 63) - 1 if x >= top else -(1 << 63) if x <= -top else int(x) for x in scores.tolist()]


class _Postings:
    """Posting lists of one candidate block."""

    def __init__(self, ids: np.ndarray, vectors: list):
        self.ids = ids
        width = max(len(v) for v in vectors)
        dense = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            dense[i, :len(v)] = v
        self.lists = []
        for term in range(width):
            held = np.flatnonzero(dense[:, term])
            self.lists.append((held, dense[held, term]))

    def scores(self, query: np.ndarray) -> np.ndarray:
        total = np.zeros(self.ids.size)
        for term in np.flatnonzero(query[:len(self.lists)]):
            held, weights = self.lists[term]
            if held.size == total.size:            # a full list needs no positions
                total += query[term] * weights
            else:
                total[held] += query[term] * weights
        return total


def best(ids: np.ndarray, scores: np.ndarray, k: int):
    """The ``k`` highest scores, ties to the smaller id, best first."""
    if scores.size > k:
        least = scores[np.argpartition(-scores, k - 1)[:k]].min()
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(scores.size)
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def _search_pair(queries, candidates, config: TopKConfig):
    """Top lists of each query over the candidates of one chunk."""
    kept = [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
    for at in range(0, len(candidates), config.block):
        part = candidates[at:at + config.block]
        postings = _Postings(np.array([c[0] for c in part], np.int64), [c[1] for c in part])
        for i, (query_id, vector) in enumerate(queries):
            scores = postings.scores(vector)
            own = postings.ids != query_id
            ids, scores = (postings.ids, scores) if own.all() else (postings.ids[own], scores[own])
            ids = np.concatenate([kept[i][0], ids])
            scores = np.concatenate([kept[i][1], scores])
            chosen = best(ids, scores, config.k)
            kept[i] = (ids[chosen], scores[chosen])
    return kept


def top_k(queries: DataFrame, candidates: DataFrame, config: TopKConfig = TopKConfig()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of integer vectors ``(id, v)``."""
    queries = queries.distinct().withColumn("h", F.xxhash64("id", "v"))
    # of equal rows, k are all that can be among the best
    candidates = (candidates.groupBy("id", "v").agg(F.count("*").alias("times"))
                  .withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(config.k)).cast("int"))))
                  .select("id", "v", "copy"))
    query_chunks = max(1, -(-queries.count() // config.query_chunk))
    candidate_chunks = max(1, -(-candidates.count() // config.candidate_chunk))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select(
        F.pmod("h", F.lit(query_chunks)).alias("q"), every(candidate_chunks).alias("c"), "id", "h", "v")
    right = candidates.select(
        every(query_chunks).alias("q"),
        F.pmod(F.xxhash64("id", "v", "copy"), F.lit(candidate_chunks)).alias("c"), "id", "v")

    def search(key, wanted: pa.Table, offered: pa.Table):
        asked = [(i, h, np.array(v, float)) for i, h, v in zip(*(wanted.column(c).to_pylist() for c in ("id", "h", "v")))]
        offered = sorted(zip(offered.column("id").to_pylist(), offered.column("v").to_pylist()))
        kept = _search_pair([(i, v) for i, _, v in asked], offered, config)
        return pa.table({
            "query_id": pa.array([i for (i, _, _), (ids, _) in zip(asked, kept) for _ in ids], pa.int64()),
            "h": pa.array([h for (_, h, _), (ids, _) in zip(asked, kept) for _ in ids], pa.int64()),
            "vec_id": pa.array([int(x) for ids, _ in kept for x in ids], pa.int64()),
            "score": pa.array([x for _, scores in kept for x in as_longs(scores)], pa.int64())})

    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(
        search, "query_id long, h long, vec_id long, score long")
    order = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= config.k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_top_k(spark, sf_dir, config: TopKConfig = TopKConfig()):
    """The five best partners of every fiftieth vector of ``embeddings``."""
    rows = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", config.scale)
    return top_k(rows.filter(F.col("id") % 50 == 0), rows, config)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.e) = 0 OR len(c.e) = 0 THEN 0
    ELSE CAST(list_dot_product(q.e, c.e) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
