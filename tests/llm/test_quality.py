import re
from collections import Counter

from sparkclassify.llm.quality import QualityRules, quality_filter, quality_profile

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=QualityRules()):
    text = text or ""
    words = WORD.findall(text)
    chars = [len(w) for w in words]

    def covered(n, later):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count, seen, hit = Counter(grams), set(), [False] * len(words)
        for i, g in enumerate(grams):
            if (g in seen) if later else count[g] > 1:
                hit[i:i + n] = [True] * n
            seen.add(g)
        return hit

    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    repeat = sum(covered(3, False))
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    kept = not failed and 100 * dup_chars <= rules.later_line_percent * sum(chars) and all(
        100 * sum(c for c, h in zip(chars, covered(n, True)) if h) <= p * sum(chars)
        for n, p in rules.later_ngram_percent)
    return (len(words), sum(chars), sum(text.count(c) for c in "#*$%&|<>"), dup, repeat, failed, kept)


def test_awkward_rows(spark):
    docs = cases.documents(spark, extra=[
        (20, "a b c d e f g h i j k " * 8 + cases.prose(__import__("random").Random(1), 300), "en", "a"),
        (21, "x y z\n\nx y z\r\nx y z\n x y z", "en", "a")])
    got = sorted((r[0] is None, r[0] or 0, *r[1:]) for r in quality_profile(docs).collect())
    want = sorted((i is None, i or 0, *brute(t)) for i, t in docs.select("doc_id", "text").collect())
    assert got == want


def test_filter_keeps_rows_whole(spark):
    docs = cases.documents(spark)
    kept = quality_filter(docs)
    assert kept.schema == docs.schema
    want = [r for r in docs.collect() if brute(r["text"])[-1]]
    key = lambda r: str(r["doc_id"]) + str(r["text"])
    assert sorted(kept.collect(), key=key) == sorted(want, key=key) and want


def test_empty_table(spark):
    docs = cases.empty(cases.documents(spark))
    assert quality_profile(docs).collect() == [] and quality_filter(docs).collect() == []


def test_lines_that_sums_of_powers_confuse(spark):
    text = "\n".join(line for k in (8, 9, 10, 11, 12) for line in cases.thue_morse(k))
    docs = spark.createDataFrame([(1, text), (2, text + "\n" + text)], "doc_id long, text string")
    got = sorted(tuple(r) for r in quality_profile(docs).collect())
    assert got == [(i, *brute(t)) for i, t in sorted(tuple(r) for r in docs.collect())]
    assert [r[4] for r in got] == [0, 10]
