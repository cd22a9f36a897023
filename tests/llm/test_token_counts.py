from sparkclassify.llm.bpe import share_vocabulary
from sparkclassify.llm.token_counts import encoded_lengths, length_histogram, length_quantiles, limit_totals

from . import cases
from .test_bpe import library  # noqa: F401


def test_histogram_against_brute_force(spark, library):  # noqa: F811
    docs = cases.documents(spark)
    sizes = [len(library.encode_ordinary(r.text or "")) for r in docs.collect()]
    hist = length_histogram(encoded_lengths(docs, "text", share_vocabulary(spark)))
    got = {r.n_tokens: r for r in hist.collect()}
    assert set(got) == set(sizes)
    for n, r in got.items():
        assert r.documents == sizes.count(n)
        assert r.documents_up == sum(s >= n for s in sizes) and r.tokens_up == sum(s for s in sizes if s >= n)
        assert r.documents_below == sum(s < n for s in sizes) and r.tokens_below == sum(s for s in sizes if s < n)
        assert r.tokens_at_limit == sum(min(s, n) for s in sizes)
    limits = [0, 1, 3, 100, 10 ** 9]
    for r in limit_totals(hist, limits).collect():
        assert r.documents_cut == sum(s > r.context_limit for s in sizes)
        assert r.tokens_kept == sum(min(s, r.context_limit) for s in sizes)
    for r in length_quantiles(hist, [0.1, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == min(x for x in sizes if sum(s <= x for s in sizes) >= r.share * len(sizes))


def test_many_bands(spark):
    lengths = spark.range(5000).selectExpr("id * 7 % 4999 AS n_tokens")
    sizes = [i * 7 % 4999 for i in range(5000)]
    hist = length_histogram(lengths)
    assert all(r.tokens_up == sum(s for s in sizes if s >= r.n_tokens) for r in hist.filter("n_tokens % 997 = 0").collect())


def test_empty_table(spark):
    hist = length_histogram(spark.range(0).selectExpr("id AS n_tokens"))
    assert hist.collect() == []
    assert [tuple(r) for r in limit_totals(hist, [5]).collect()] == [(5, 0, 0)]
    assert [r.n_tokens for r in length_quantiles(hist, [0.5]).collect()] == [None]
