import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkclassify.llm.simhash import links, op12_simhash, simhash_components
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, empty


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out, votes = 0, [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            votes[i] += h >> i & 1
    for i in range(64):
        out |= (2 * votes[i] > len(shingles)) << i
    return out


def components(prints, radius=2):
    """All pairs of a numpy column, then a union-find."""
    values = np.array(sorted(set(prints)), np.uint64)
    root = list(range(values.size))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {int(v): find(i) for i, v in enumerate(values)}


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return sorted(((i, f"{p:016x}", least.get(label[p])) for (i, _), p in zip(rows, prints)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = op12_simhash(spark, SF_SMALL)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert got(found) == expected(rows)


def test_awkward_rows(spark):
    df = documents(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(simhash_components(df)) == expected(rows)
    assert simhash_components(empty(df)).count() == 0


def test_hash_is_the_engines(spark):
    text = "Ünï one TWO"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = one.select(F.lower(F.lpad(F.hex(F.xxhash64(F.lit("Ünï one two"))), 16, "0"))).first()[0]
    assert simhash_components(one).first().fingerprint == want


def test_a_third_of_all_rows_equal(spark):
    rng = random.Random(3)
    rows = [(i, "all the same words here" if i % 3 == 0 else " ".join(rng.choice("abcdefgh") for _ in range(9)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(simhash_components(df)) == expected(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_no_component(spark, seed):
    rng = random.Random(seed)
    values = {0, 1, 3, 1 << 63, (1 << 64) - 1}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(4):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = {tuple(x % (1 << 64) for x in r) for r in
             links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    assert all(a != b and bin(a ^ b).count("1") <= 2 for a, b in pairs)
    want = components(values)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = lambda of: sorted(sorted(x for x in values if of(x) == g) for g in {of(v) for v in values})
    assert groups(find) == groups(want.get)
