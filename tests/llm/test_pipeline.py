import hashlib
import random

import numpy as np

import __spark_entry__
import corpus_pipeline

from sparkclassify.llm.pii import KINDS

from . import cases
from .test_bpe import library  # noqa: F401
from .test_near_duplicates import brute
from .test_pii import base
from .test_quality import brute as quality

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, library, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        text = {r.doc_id: r.text for r in before}
        if name != "byte-level BPE":
            assert docs.columns == columns
        if name == "quality rules":
            assert {r.doc_id for r in after} == {i for i, t in text.items() if quality(t)[-1]}
        elif name == "n-gram Jaccard join":
            rows = sorted(text.items())
            _, component = brute(rows)
            assert {r.doc_id for r in after} == {min(i for (i, _), d in zip(rows, component) if d == c) for c in set(component)}
        elif name == "PII":
            assert sorted(r.doc_id for r in after) == sorted(text)
            for r in after:
                assert not base(r.text)
                assert base(text[r.doc_id]) or r.text == text[r.doc_id]
        elif name.startswith("mixing"):
            assert all(r.text == text[r.doc_id] for r in after) and after
        else:
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
            for r in after:
                assert r.ids == library.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
                assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
                assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def hidden(text):
    """``text`` with the base kinds in brackets (they do not overlap here)."""
    for start, kind, end in reversed(base(text)):
        text = f"{text[:start]}[{KINDS[kind]}]{text[end:]}"
    return text


def test_awkward_rows(spark, tmp_path):
    """Null, empty, very long, repeated and clashing rows through all stages,
    against brute force; without labels all rates are 1."""
    rng = random.Random(8)
    words = cases.prose(rng, 90).split()
    copy, changed = " ".join(words), " ".join(words[:40] + ["changed"] + words[41:])
    docs = cases.documents(spark, extra=[
        (20, copy, "en", "a"), (20, copy, "en", "a"), (21, changed, None, None), (None, copy, "en", "b"),
        (22, cases.prose(rng, 80) + " p.q@mail.example", "en", "a"),
        (None, cases.prose(rng, 80) + " at 10.1.2.3 now", None, "a")])
    docs.write.parquet(f"{tmp_path}/full/documents.parquet")
    cases.empty(docs).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("full", "none"):
        cases.empty(spark.read.parquet(f"{SF}/labels.parquet")).write.parquet(f"{tmp_path}/{name}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if quality(r.text)[-1]]
    _, component = brute(rows)
    keepers = {min((i is None, i or 0, t) for (i, t), d in zip(rows, component) if d == c) for c in set(component)}
    want = [(None if absent else i, hashlib.sha256(hidden(t).encode()).hexdigest()) for absent, i, t in keepers]
    got = [(r.doc_id, r.decoded_sha256) for r in corpus_pipeline.run(spark, f"{tmp_path}/full").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {1, 20, 22, None} <= {i for i, _ in got} and not {2, 3, 21} & {i for i, _ in got}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
