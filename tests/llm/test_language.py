import random
import zlib

from sparkclassify.llm.language import (LanguageConfig, fit_language_model, held_out, op1_language,
                                        predict_language)

from . import cases


def test_held_out_accuracy(spark):
    from tests.conftest import SF_MEDIUM
    rows = op1_language(spark, SF_MEDIUM).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.98 * len(tested)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    model = fit_language_model(docs, "doc_id", "text", "lang", LanguageConfig(landmarks=4, training_rows=8))
    got = predict_language(docs, model, "text", ("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "xx")


def test_without_training_rows(spark):
    docs = cases.documents(spark)
    assert fit_language_model(cases.empty(docs), "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in predict_language(docs, None, "text", ("doc_id",)).collect()} == {"und"}
    assert predict_language(cases.empty(docs), None, "text", ("doc_id",)).collect() == []


def _words(rng, words, count):
    return " ".join(rng.choice(words) for _ in range(count))


GERMAN, ENGLISH = "der hund und die katze schläft nicht über wasser".split(), "the dog and this cat sleeps with water then".split()


def test_one_row_repeated_under_one_id(spark):
    rng = random.Random(2)
    english = [(1000 + i, _words(rng, ENGLISH, 30), "en") for i in range(300)]
    config = LanguageConfig(landmarks=8, training_rows=20)
    for id in (1, 2, 3):
        rows = english + [(id, _words(rng, GERMAN, 30), "de")] * 300
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = fit_language_model(df, "doc_id", "text", "lang", config)
        assert model["langs"] == ["de", "en"]
        got = predict_language(df, model, "text", ("lang",)).collect()
        assert len(got) == 600 and all(r.lang == r.lang_pred for r in got)


def test_language_of_long_texts_only(spark):
    rng = random.Random(3)
    rows = [(i, _words(rng, GERMAN, 12_000), "de") for i in range(10)]
    rows += [(100 + i, _words(rng, ENGLISH, 30), "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(df, "doc_id", "text", "lang", LanguageConfig(landmarks=4, training_rows=20))
    assert model["langs"] == ["de", "en"]
    assert all(r.lang == r.lang_pred for r in predict_language(df, model, "text", ("lang",)).collect())


def test_null_id_is_held_out(spark):
    assert [r[0] for r in cases.documents(spark).filter("doc_id IS NULL").select(held_out()).collect()] == [True, True]
