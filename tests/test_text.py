"""Text functions: golden values, Java semantics, edge cases."""

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from sparkclassify.functions.hashing import term_bucket
from sparkclassify.functions.stopwords import ENGLISH_STOP_WORDS
from sparkclassify.functions.text import (ALNUM_STRIP_PATTERN, ALPHA_STRIP_PATTERN,
                                          clean_text, java_trim, strip_punctuation)
from sparkclassify.operators.text import remove_stop_words, term_counts, tokenize

from .fixtures import mail


def test_stop_words_equal_spark_default(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_golden(spark):
    df = spark.createDataFrame([(" hello  World ",), ("",), ("a b",), ("  ",)], "t string")
    got = [r.w for r in tokenize(df, "t", "w").collect()]
    assert got[0] == ["", "hello", "", "world"]
    assert got[1] == [""]
    assert got[2] == ["a", "b"]
    assert got[3] == []


def test_tokens_equal_ml_tokenizer(spark):
    texts = [(" hello  World ",), ("",), ("a\tb\nc",), ("x  ",), ("  y",), ("Mixed CASE\fz",)]
    df = spark.createDataFrame(texts, "t string")
    ours = [r.w for r in tokenize(df, "t", "w").orderBy("t").collect()]
    ml = [r.w for r in Tokenizer(inputCol="t", outputCol="w").transform(df).orderBy("t").collect()]
    assert ours == ml


def test_tokenize_null_fails(spark):
    df = spark.createDataFrame([(None,)], "t string")
    with pytest.raises(Exception):
        tokenize(df, "t", "w").collect()


def test_stop_words_golden(spark):
    df = spark.createDataFrame([("we are having issue",), ("re your message click",),
                                ("don't stop",), ("dont stop",)], "t string")
    out = remove_stop_words(tokenize(df, "t", "w"), "w", "f").select("f").collect()
    assert out[0].f == ["issue"]
    assert out[1].f == ["re", "message", "click"]
    assert out[2].f == ["stop"]          # "don't" is a stop word
    assert out[3].f == ["dont", "stop"]  # without the apostrophe it is not


def test_stop_words_equal_ml_remover(spark):
    df = tokenize(mail(spark).select(clean_text("text").alias("t")), "t", "w")
    ours = [r.f for r in remove_stop_words(df, "w", "f").collect()]
    ml = [r.f for r in StopWordsRemover(inputCol="w", outputCol="f").transform(df).collect()]
    assert ours == ml


def test_clean_text_order_and_values(spark):
    df = spark.createDataFrame([("  Don't call 0800, NOW!  ",), ("Réunion à Genève",),
                                ("\t\x01x\x02 ",)], "t string")
    got = [r.c for r in df.select(clean_text("t").alias("c")).collect()]
    assert got == ["dont call 0800 now", "runion  genve", "x"]
    alpha = df.select(clean_text("t", keep_digits=False).alias("c")).first().c
    assert alpha == "dont call  now"


def test_two_step_strip_equals_single_pattern(spark):
    text = "".join(chr(i) for i in range(0, 400)) + " Ünïcødé – “quotes”   end"
    df = spark.createDataFrame([(text,), ("plain words, 123.",)], "t string")
    for keep, pattern in ((True, ALNUM_STRIP_PATTERN), (False, ALPHA_STRIP_PATTERN)):
        rows = df.select(strip_punctuation("t", keep).alias("a"),
                         F.regexp_replace("t", pattern, "").alias("b")).collect()
        assert all(r.a == r.b for r in rows)


def test_java_trim(spark):
    df = spark.createDataFrame([("\x00\x1f a b \t\n",), (" x ",)], "t string")
    got = [r.t2 for r in df.select(java_trim("t").alias("t2")).collect()]
    assert got == ["a b", " x "]  # no-break space is above U+0020


def test_murmur3_buckets_golden(spark):
    df = spark.createDataFrame([("thankskat",), ("issue",), ("hello",), ("rileystl",)], "t string")
    got = {r.t: r.b for r in df.select("t", term_bucket("t", 10000, "murmur3").alias("b")).collect()}
    assert got == {"thankskat": 5652, "issue": 6748, "hello": 5048, "rileystl": 1672}


def test_md5_bucket_in_range(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("t"))
    b = df.select(term_bucket("t", 97, "md5").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert 0 <= b[0] and b[1] < 97


def test_empty_line_is_a_feature(spark):
    """An empty line tokenises to [""], which is no stop word."""
    df = spark.createDataFrame([(0.0, ""), (0.0, "hello")], "label double, t string")
    counts = term_counts(remove_stop_words(tokenize(df, "t", "w"), "w", "f"), "f")
    got = {r.term: r.n_occurrences for r in counts.collect()}
    assert got == {"": 1, "hello": 1}
