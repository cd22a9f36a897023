"""Small tables with awkward rows, shared by the operator tests."""
import random

from pyspark.sql import functions as F

LONG = 3_000_000
# names that the operators use inside, or return
CLASHING = ("id", "key", "h", "k", "row", "copy", "cls", "label", "text_", "__text", "__h", "shingle_class",
            "spans", "shard", "slot", "rate", "n_tokens", "kept", "ids", "score", "lang_pred", "keep_id")


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(words))


def documents(spark, extra=(), seed=5):
    """(doc_id, text, lang, source, n_chars) and columns of clashing names."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", None), (4, None, "en", "b"),
        (5, "", "de", "b"), (6, " \n\t ", None, "b"), (7, "one two", "en", "c"), (8, "One  two", "en", "c"),
        (9, "".join(rng.choice("abc \n") for _ in range(LONG)), "xx", "c"), (None, prose(rng, 70), "en", "d"),
        (11, "é\U0001f600漢字 " * 30, None, None), (12, "#" * 500, "en", "a"),
        (13, "same line of words here\n" * 40, "en", "a"), (7, "one two", "en", "c"), (None, None, None, None),
        (14, "\0 nul \0 bytes", "en", "a"), (15, "write to a@b.example now", "en", "a"),
        *extra]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def empty(df):
    return df.filter("false")


def thue_morse(k):
    """Two different strings of ``2 ** k`` letters that sums of powers modulo
    a power of two take for one."""
    bits = [bin(i).count("1") & 1 for i in range(1 << k)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
