"""Long-form TF-IDF and naive Bayes against golden values and against the
vector-form ``pyspark.ml`` stages on the same input."""

import math

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, Normalizer
from pyspark.ml.linalg import SparseVector

from sparkclassify.functions.text import clean_text
from sparkclassify.operators.features import hash_terms, hashed_tf, idf_fit, l2_normalize, tfidf
from sparkclassify.operators.naive_bayes import naive_bayes_fit, naive_bayes_score
from sparkclassify.operators.text import remove_stop_words, tokenize
from sparkclassify.operators.text_model import fit_text_naive_bayes, score_text_naive_bayes

from .fixtures import MAIL

N = 16  # small bucket count: collisions happen, as they would at scale


def _mail_terms(spark):
    df = spark.createDataFrame([(i, lab, t) for i, (lab, t) in enumerate(MAIL)],
                               "id long, label double, text string")
    toks = tokenize(df.withColumn("clean", clean_text("text")), "clean", "w")
    return remove_stop_words(toks, "w", "terms").select("id", "label", "terms")


def _vectors(rows, n):
    """(id, bucket, weight) rows -> {id: SparseVector} (test-side only)."""
    by_id = {}
    for r in rows:
        if r.bucket is not None:
            by_id.setdefault(r.id, {})[r.bucket] = r.weight
    return by_id


def _golden_rows(spark):
    # 3 rows over 3 features: (1,0,2), (0,3,0), (1,1,0); classes (0,1,0).
    dense = [(0, 0.0, [1.0, 0.0, 2.0]), (1, 1.0, [0.0, 3.0, 0.0]), (2, 0.0, [1.0, 1.0, 0.0])]
    long_rows = [(i, lab, j, v) for i, lab, vec in dense for j, v in enumerate(vec) if v]
    feats = spark.createDataFrame(long_rows, "id long, label double, bucket int, weight double")
    docs = spark.createDataFrame([(i, lab) for i, lab, _ in dense], "id long, label double")
    return dense, feats, docs


def test_idf_golden(spark):
    _, feats, docs = _golden_rows(spark)
    tf = feats.withColumnRenamed("weight", "tf")
    got = {r.bucket: (r.doc_freq, r.idf) for r in idf_fit(tf, docs).weights.collect()}
    assert got[0][0] == 2 and got[0][1] == pytest.approx(0.287682, abs=1e-6)
    assert got[1][0] == 2
    assert got[2][0] == 1 and got[2][1] == pytest.approx(0.693147, abs=1e-6)


def test_nb_golden(spark):
    _, feats, docs = _golden_rows(spark)
    model = naive_bayes_fit(feats, docs, num_features=3, smoothing=1.0)
    pri = {r.label: r.log_prior for r in model.classes.collect()}
    assert pri[0.0] == pytest.approx(-0.5108, abs=1e-4)
    assert pri[1.0] == pytest.approx(-0.9163, abs=1e-4)
    th = {(r.label, r.bucket): r.log_theta for r in model.theta.collect()}
    default = {r.label: r.log_default for r in model.classes.collect()}
    full = {(c, j): th.get((c, j), default[c]) for c in (0.0, 1.0) for j in range(3)}
    assert [round(full[(0.0, j)], 4) for j in range(3)] == [-0.9808, -1.3863, -0.9808]
    assert [round(full[(1.0, j)], 4) for j in range(3)] == [-1.7918, -0.4055, -1.7918]


def test_long_form_equals_ml_stages(spark):
    """TF -> IDF -> L2 -> NB in long form equals IDF, Normalizer and
    NaiveBayes of pyspark.ml fed with the same TF vectors."""
    terms = _mail_terms(spark)
    tf = hashed_tf(terms, ["id", "label"], "terms", N, "murmur3", keep_empty=True)
    idf = idf_fit(tf, terms)
    feats = l2_normalize(tfidf(tf, idf), ["id"])
    model = naive_bayes_fit(feats, terms.select("label"), num_features=N)
    scored = {r.id: r for r in naive_bayes_score(model, feats, ["id", "label"]).collect()}

    tf_vec = _vectors(tf.withColumnRenamed("tf", "weight").collect(), N)
    labels = {r.id: r.label for r in terms.collect()}
    rows = [(i, labels[i], SparseVector(N, tf_vec.get(i, {}))) for i in sorted(labels)]
    vdf = spark.createDataFrame(rows, ["id", "label", "tf"])
    ml_idf = IDF(inputCol="tf", outputCol="tfidf").fit(vdf).transform(vdf)
    ml_norm = Normalizer(inputCol="tfidf", outputCol="features", p=2.0).transform(ml_idf)
    ml_model = NaiveBayes(featuresCol="features", labelCol="label", smoothing=1.0).fit(ml_norm)
    ml_scored = {r.id: r for r in ml_model.transform(ml_norm).collect()}

    long_feats = _vectors(feats.collect(), N)
    for i, r in ml_scored.items():
        want = r.features.toArray()
        got = [long_feats.get(i, {}).get(j, 0.0) for j in range(N)]
        assert got == pytest.approx(list(want), abs=1e-9)
        assert scored[i].prediction == r.prediction
        assert scored[i].score == pytest.approx(max(r.rawPrediction.toArray()), abs=1e-9)
        assert scored[i].probability == pytest.approx(max(r.probability.toArray()), abs=1e-9)
    pi = ml_model.pi.toArray()
    got_pi = {r.label: r.log_prior for r in model.classes.collect()}
    assert [got_pi[0.0], got_pi[1.0]] == pytest.approx(list(pi), abs=1e-12)


def test_all_zero_row_stays_zero(spark):
    df = spark.createDataFrame([(1, 3, 0.0), (2, 1, 2.0)], "id long, bucket int, weight double")
    got = {r.id: r.weight for r in l2_normalize(df, ["id"]).collect()}
    assert got == {1: 0.0, 2: 1.0}


def test_text_model_keeps_documents_without_terms(spark):
    """A line whose every token is a stop word still gets a prediction
    (from the priors alone)."""
    terms = _mail_terms(spark)
    model = fit_text_naive_bayes(terms, ["id"], "terms", "label", N, "murmur3")
    extra = spark.createDataFrame([(99, 0.0, [])], "id long, label double, terms array<string>")
    out = score_text_naive_bayes(model, terms.unionByName(extra), ["id"], "terms", "label")
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == len(MAIL) + 1
    priors = {r.label: r.log_prior for r in model.nb.classes.collect()}
    assert rows[99].score == pytest.approx(max(priors.values()))
    assert all(0.0 < r.probability <= 1.0 for r in rows.values())


def test_unseen_bucket_uses_default_idf(spark):
    docs = spark.createDataFrame([(1, 0.0, ["a"]), (2, 1.0, ["b"])],
                                 "id long, label double, terms array<string>")
    tf = hashed_tf(docs, ["id", "label"], "terms", 1000, "md5")
    idf = idf_fit(tf, docs)
    test = spark.createDataFrame([(3, 0.0, ["zzz-unseen"])], "id long, label double, terms array<string>")
    w = tfidf(hashed_tf(test, ["id", "label"], "terms", 1000, "md5"), idf).first().weight
    assert w == pytest.approx(math.log(3.0))


def test_hashed_terms_count_like_terms(spark):
    """Also with repeated, null and empty keys and terms."""
    df = spark.createDataFrame(
        [(1, ["a", "b", "a", None]), (1, ["a"]), (None, ["b", "c"]), (None, ["b"]), (2, []), (3, None)],
        "id long, terms array<string>")
    for algo in ("md5", "murmur3"):
        for keep_empty in (False, True):
            want = hashed_tf(df, ["id"], "terms", N, algo, keep_empty)
            got = hashed_tf(hash_terms(df, "terms", N, algo), ["id"], "terms", algo=None, keep_empty=keep_empty)
            assert got.dtypes == want.dtypes
            assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_norms_exchange_no_tf_rows(spark):
    """One exchange by line, below the explode; what is exchanged above it are
    document frequencies."""
    from sparkclassify.plans.feature_queries import l2_normalize_query
    from .conftest import SF_SMALL
    plan = l2_normalize_query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Window" in above and "hashpartitioning(doc_id" not in above.split("BroadcastHashJoin")[-1], plan
    between = above[above.index("Window"):above.index("Subquery")] + above.split("BroadcastHashJoin")[-1]
    assert "Exchange" not in between, plan


def test_character_statistics_read_a_text_once(spark):
    """Counts by brute force on awkward texts; no expression goes over the text
    but its length and the one pass that counts."""
    from math import log1p
    from sparkclassify.plans.doc_features import CHAR_CLASSES, CHAR_PROBES, char_statistics, feature_names
    texts = [None, "", "the then thethe Schsch THE quou inging", "ñßçéèüöäíó ññ \n\n\t .,;:!? 09", "Ã±Ÿ e\u0301 \u0000\x7f\x80",
             "日本語 😀 été", "x" * 70000 + "ing" * 999]
    df = spark.createDataFrame([(i % 2, i, t) for i, t in enumerate(texts)], "lang int, doc_id long, text string")
    got = char_statistics(df, keep=("doc_id", "lang"))
    assert got.columns == ["doc_id", "lang", *feature_names()]
    for i, lang, *values in got.collect():
        text, want = texts[i], [None] * len(feature_names())
        assert lang == i % 2
        if text is not None:
            n = float(max(1, len(text)))
            want = [log1p(len(text)), *[sum(map(text.count, chars)) / n for chars in CHAR_CLASSES.values()],
                    sum(c > "\x7f" for c in text) / n, *[text.count(p) / n * 1000.0 for p in CHAR_PROBES]]
        assert values[1:] == want[1:] and values[0] == pytest.approx(want[0])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and not any(f"{f}(text" in plan for f in ("translate", "replace", "regexp_replace")), plan
    assert char_statistics(df.filter("false")).collect() == []
