from sparkclassify.llm.mixing import MixConfig, domain_of_labels, mix, mixing_rates, op7_mixing

from . import cases


def tables(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), domain_of_labels(spark.read.parquet(f"{sf}/labels.parquet"))


def test_rates_meet_targets(spark):
    from tests.conftest import SF_MEDIUM
    config = MixConfig()
    rows = op7_mixing(spark, SF_MEDIUM, config).toPandas()
    docs, labels = tables(spark, SF_MEDIUM)
    assert sorted(rows.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert (rows.rate >= 0).all()
    total = rows.n_tokens.sum()
    for name, share in config.targets:
        assert abs((rows.n_tokens * rows.rate * rows[f"p_{name}"]).sum() / total - share) < 1e-3
    known = labels.toPandas().merge(rows, on="doc_id")
    best = known[[f"p_{d}" for d in config.domains]].idxmax(axis=1).str[2:]
    assert (best == known.domain).mean() > 0.9


def test_held_out_posteriors(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.1")
    rows = mixing_rates(docs, labels.filter("doc_id % 4 <> 0")).toPandas()
    known = labels.filter("doc_id % 4 = 0").toPandas().merge(rows, on="doc_id")
    best = known[["p_good", "p_poor", "p_toxic"]].idxmax(axis=1).str[2:]
    assert (best == known.domain).mean() > 0.85


def test_mixing_repeats_rows_by_rate(spark):
    from tests.conftest import SF_MEDIUM
    docs, labels = tables(spark, SF_MEDIUM)
    rate = {r.doc_id: r.rate for r in mixing_rates(docs, labels).collect()}
    mixed = mix(docs, labels)
    assert mixed.schema == docs.schema
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(abs(times.get(i, 0) - r) < 1 for i, r in rate.items())
    assert abs(sum(times.values()) / sum(rate.values()) - 1) < 0.05


def test_awkward_tables(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, "good"), (13, "poor"), (None, "good"), (1, None), (77, "good"), (12, "other")],
                                   "doc_id long, domain string")
    rates = mixing_rates(docs, labels).collect()
    assert len(rates) == docs.count() and all(r.rate >= 0 and r.p_toxic == 0 for r in rates)
    assert mix(docs, labels).columns == docs.columns
    for none in (labels.filter("false"), labels.filter("domain = 'good'")):
        got = mixing_rates(docs, none).collect()
        assert len(got) == docs.count()
    assert {r.rate for r in mixing_rates(docs, labels.filter("false")).collect()} == {1.0}
    assert mixing_rates(cases.empty(docs), labels).collect() == []
    assert mix(cases.empty(docs), labels).collect() == []


def test_steps_end_at_the_targets_or_at_a_stationary_point(spark):
    from tests.conftest import SF_MEDIUM
    docs, labels = tables(spark, SF_MEDIUM)
    for share in ((0.98, 0.01, 0.01), (0.999, 0.0005, 0.0005)):
        config = MixConfig(targets=tuple(zip(("good", "poor", "toxic"), share)), stored_steps=6, still=1e-4 if share[0] > 0.99 else 1e-6)
        rows = mixing_rates(docs, labels, config=config).toPandas()
        off = max(abs((rows.n_tokens * rows.rate * rows[f"p_{d}"]).sum() / rows.n_tokens.sum() - w) for d, w in config.targets)
        assert abs(off - rows.miss[0]) < 1e-4 and (rows.rate >= 0).all()
        if share[0] == 0.98:
            assert rows.miss[0] <= 1e-6


def test_labels_without_a_value_teach_nothing(spark):
    labels = spark.createDataFrame([(1, None, None), (2, 1, None), (3, None, 0), (4, 0, 0), (5, 1, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in domain_of_labels(labels).collect()} == {(2, "good"), (3, "good"), (4, "poor"), (5, "toxic")}


def test_rows_repeated_under_a_labelled_id(spark):
    from tests.conftest import SF_SMALL
    docs, labels = tables(spark, SF_SMALL)
    hot = labels.join(docs.select("doc_id"), "doc_id").agg({"doc_id": "min"}).first()[0]
    more = docs.filter(f"doc_id = {hot}").crossJoin(spark.range(200)).drop("id")
    one = {r.doc_id: (r.p_good, r.p_poor) for r in mixing_rates(docs, labels).collect()}
    many = mixing_rates(docs.unionByName(more), labels).collect()
    assert len(many) == len(one) + 200
    assert all(abs(r.p_good - one[r.doc_id][0]) < 1e-5 and abs(r.p_poor - one[r.doc_id][1]) < 1e-5 for r in many)


def test_main_path_runs_no_python(spark):
    from tests.conftest import SF_SMALL
    docs, labels = tables(spark, SF_SMALL)
    plan = mix(docs, labels)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("PythonUDF", "Pandas", "MapInArrow"))
