import math

from pyspark.sql import functions as F

from sparkclassify.llm.top_k import TopKConfig, integer_vectors, op5_top_k, top_k


def brute(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in good if i % 50 == 0}
    out = []
    for q, v in queries:
        best = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in good if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def search(df, config=TopKConfig()):
    rows = integer_vectors(df, "vec_id", "embedding", config.scale)
    return top_k(rows.filter("id % 50 = 0"), rows, config)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25, 0.0]), (50, [0.0, 0.0, 0.0]), (1, [0.5, 0.5, 0.5]), (2, [0.5, 0.5, 0.5]), (3, None),
            (4, [1.0, None, 1.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, []), (8, [9.0]), (9, [0.1, 0.2, 0.3, 4.0]),
            (1, [0.5, 0.5, 0.5]), (50, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (100, [-1.5, 2.0, 0.001])]
    rows += [(10, [0.25, 0.25, 0.25])] * 9
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit(1).alias(c) for c in ("id", "v", "q", "c", "score", "rank")])
    for config in (TopKConfig(), TopKConfig(query_chunk=1, candidate_chunk=3, block=2)):
        assert result(search(df, config)) == brute(rows)
    assert search(df.filter("false")).collect() == []


def test_given_vectors(spark):
    from tests.conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert result(op5_top_k(spark, SF_SMALL)) == brute(rows)


def test_large_components(spark):
    """Finite vectors always take part; scores end at the range of longs."""
    big = float(1 << 60)
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [big, 1.0]), (50, [1e300, 1e300]), (4, [1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in search(df).collect()}
    assert got[0, 1] == got[0, 3] == (1 << 63) - 1 and got[0, 2] == -(1 << 63)
    assert got[50, 4] == 0 and len(got) == 10
