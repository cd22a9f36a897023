import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkclassify.llm.collocations import CollocationConfig, collocations
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, empty


def brute(rows, least, top, inside=80, scale=2_000_000):
    """Every n-gram of every text counted, every rule as it is stated."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    cand = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    held = set()
    for (lang, ws), a in cand.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                if 100 * a >= inside * counts[lang, ws[i:i + k]]:
                    held.add((lang, ws[i:i + k]))
    out = []
    for lang in total:
        mine = []
        for (of, ws), a in cand.items():
            if of == lang and (of, ws) not in held:
                score, k = min((scale * a // (counts[lang, ws[:k]] + counts[lang, ws[k:]]), k) for k in range(1, len(ws)))
                mine.append((-score, -a, " ".join(ws).encode(), counts[lang, ws[:k]], counts[lang, ws[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def zipf(seed, docs=150):
    """Skewed words with set phrases, ties and several languages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "Zed", "ß"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [["once", "upon", "a", "time"], ["new", "york"], ["once", "upon", "it"], ["a", "a", "a", "a", "a"]]
    rows = []
    for _ in range(docs):
        text = []
        for _ in range(rng.randint(0, 30)):
            text += rng.choice(fixed) if rng.random() < .2 else rng.choices(words, weights)
            text.append(rng.choice(["", "", "", ".", "\t", "\n", " ,"]))
        rows.append((" ".join(text), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("seed, config", [
    (1, CollocationConfig(least=3, top=7, batch=8, bits=64, block_bytes=500)),       # many false hits, several rounds
    (3, CollocationConfig(least=3, top=100_000, batch=1 << 10, bits=1 << 14))])       # everything is grown
def test_against_brute_force(spark, seed, config):
    rows = zipf(seed)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert got(collocations(df, config=config)) == brute(rows, config.least, config.top)


def test_awkward_rows(spark):
    df = documents(spark, extra=[(20, "Same HERE same here", None, "a")] * 3)
    rows = [tuple(r) for r in df.filter("doc_id IS NULL OR doc_id <> 9").select("text", "lang").collect()]
    config = CollocationConfig(least=2, top=50, bits=1 << 12)
    assert got(collocations(df.filter("doc_id IS NULL OR doc_id <> 9"), config=config)) == brute(rows, 2, 50)
    assert collocations(empty(df), config=config).count() == 0
    assert collocations(df.filter("doc_id = 9"), config=CollocationConfig(least=10 ** 7)).count() == 0


def test_very_long_and_repeated_text(spark):
    text = "big apple pie. " * 60_000
    df = spark.createDataFrame([(text, "en"), (text, "en"), ("big apple", "en")], "text string, lang string")
    assert got(collocations(df)) == brute([(text, "en"), (text, "en"), ("big apple", "en")], 30, 2000)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in df.select("text", "lang").collect()]
    config = CollocationConfig(least=5, top=60, batch=256)
    assert got(collocations(df.withColumn("a", F.lit(1)).withColumn("phrase", F.lit("x")), config=config)) == brute(rows, 5, 60)
