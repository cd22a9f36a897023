import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from sparkclassify.llm.bpe import (RANKS_FILE, BytePairEncoder, decode_column, encode_column, read_ranks,
                                   share_vocabulary, token_digests, token_halves)

from . import cases


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(RANKS_FILE), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    tokens = read_ranks(public_tokenizers.path(RANKS_FILE))
    return BytePairEncoder(tokens, token_halves(tokens), public_tokenizers.PATTERN, memo_pieces=50, memo_pairs=50)


def test_same_ids_as_the_library(encoder, library):
    rng = random.Random(7)
    parts = ["a", "the", "ing", " ", "'s", "'re", " -", "==", "0", "12", "é", "漢", "\n", "\t", "　",
             "\U0001f600", "_", "ſ", "́", "aaaa", "\0", "<|endoftext|>", "THE", "ble"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["ab" * 20_000, "=" * 30_001, "".join(rng.choice("abcde") for _ in range(50_000))]
    for text in texts:
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_awkward_rows(spark, library):
    docs = cases.documents(spark)
    got = sorted((str(r[0]), *r[1:]) for r in token_digests(docs, "doc_id", "text", share_vocabulary(spark)).collect())
    want = []
    for i, text in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_columns_round_trip(spark):
    docs = cases.documents(spark)
    vocabulary = share_vocabulary(spark)
    rows = decode_column(encode_column(docs, "text", vocabulary), "ids", vocabulary).collect()
    assert len(rows) == docs.count() and all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert encode_column(cases.empty(docs), "text", vocabulary).collect() == []
