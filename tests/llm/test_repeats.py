import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sparkclassify.llm.repeats import RepeatConfig, op10_repeats, remove_repeats

from . import cases


def brute(rows, length=400):
    seen = Counter(data[p:p + length] for _, data in rows for p in range(len(data) - length + 1))
    out = []
    for i, data in rows:
        edge = np.zeros(len(data) + 1, np.int64)
        for p in range(len(data) - length + 1):
            if seen[data[p:p + length]] > 1:
                edge[p] += 1
                edge[p + length] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append(str((i, len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())))
    return sorted(out)


def result(df):
    return sorted(str(tuple(r)) for r in df.collect())


def passages(rng, count):
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.randint(300, 900), "abcd \n") for _ in range(6)] + ["a" * 700, "ab" * 400, "\0" * 500]
    rows = []
    for i in range(count):
        s = text(rng.randint(0, 500), "abcdefgh ")
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            s = s[:rng.randint(0, len(s))] + p[rng.randint(0, len(p) // 3):len(p) - rng.randint(0, 200)]
            s += text(rng.randint(0, 30), "xyz\0é")
        rows.append((100 + i, s, "en", "a"))
    return rows + [(999, rows[3][1], "en", "a")]


@pytest.mark.parametrize("config", [RepeatConfig(), RepeatConfig(order_limit=3)])
def test_against_brute_force(spark, config):
    docs = cases.documents(spark, extra=passages(random.Random(4), 90)).filter("doc_id IS NULL OR doc_id <> 9")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert result(remove_repeats(docs, config=config, digest=True)) == brute(rows)


def test_long_text_is_parsed_in_pieces(spark):
    rng = random.Random(5)
    copied = "".join(rng.choice("abcdefghij ") for _ in range(5000))
    long = lambda: "".join(rng.choices("abcdefghij ", k=5_000_000))
    a = long()
    a = a[:2_097_152 - 2500] + copied + a[2_097_152 - 2500:]       # across a seam
    df = spark.createDataFrame([(1, a), (2, "x" + copied + "y")], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (5000, 1)
    assert bytes(got[1].kept) == (a[:2_097_152 - 2500] + a[2_097_152 + 2500:]).encode()
    assert bytes(got[2].kept) == b"xy"


def test_given_documents(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert result(op10_repeats(spark, SF_SMALL)) == brute(rows)


def test_empty_table(spark):
    assert remove_repeats(cases.empty(cases.documents(spark))).collect() == []
