import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sparkclassify.llm.components import connected_components
from sparkclassify.llm.near_duplicates import (JaccardConfig, _block_sets, _by_shingle,
                                               keep_one_per_component, near_duplicate_components, pack_hashes,
                                               search_unit, shingle_hashes, unpack_hashes)

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Component number of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def near_copies(rng, groups=12, copies=9):
    """Chains of edited copies, around the threshold, with shared passages."""
    out, passage = [], cases.prose(rng, 40)
    for g in range(groups):
        words = cases.prose(rng, rng.randint(20, 90)).split()
        for c in range(copies):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "w%d" % rng.randint(0, 99)
            text = " ".join(words)
            out.append((1000 + g * copies + c, text + (" " + passage if g % 3 == 0 else ""), "en", "a"))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("config", [JaccardConfig(), JaccardConfig(unit_postings=300, block_bytes=2000)])
def test_against_brute_force(spark, config):
    docs = cases.documents(spark, extra=near_copies(random.Random(11)))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sets, component = brute(rows)
    least = {}
    for (i, _), c in zip(rows, component):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(str((i, len(s), least.get(c) if s else i)) for (i, _), s, c in zip(rows, sets, component))
    got = near_duplicate_components(docs, config=config).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert len({r.component_id for r in got}) < len(got)


@pytest.mark.parametrize("copies", [1, 2, 3])
def test_blocks_of_the_same_classes_count_once(spark, copies):
    words = [f"w{i}" for i in range(54)]            # 50 shingles, 40 of them in common: Jaccard 0.67
    near = " ".join(words[:44] + [f"x{i}" for i in range(10)])
    rows = [(i, " ".join(words)) for i in range(copies)] + [(10 + i, near) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, component = brute(rows)
    assert len(sets[0] & sets[-1]) == 40 and len(set(component)) == 2
    got = near_duplicate_components(docs, config=JaccardConfig(block_bytes=64)).collect()
    assert sorted(map(tuple, got)) == [(i, 50, 10 * (i // 10)) for i, _ in sorted(rows)]
    assert keep_one_per_component(docs, config=JaccardConfig(block_bytes=64)).count() == 2


def test_one_of_each_component_stays(spark):
    docs = cases.documents(spark, extra=near_copies(random.Random(12), 5, 5))
    kept = keep_one_per_component(docs)
    assert kept.schema == docs.schema
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sets, component = brute(rows)
    got = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert sorted(map(str, (r for r in got if not shingles(r[1])))) == sorted(map(str, (r for r, s in zip(rows, sets) if not s)))
    full = [r for r in got if shingles(r[1])]
    of = {r: c for r, c, s in zip(rows, component, sets) if s}
    assert sorted(of[r] for r in full) == sorted({c for c, s in zip(component, sets) if s})
    for r in full:
        ids = [i for (i, _), c, s in zip(rows, component, sets) if s and c == of[r] and i is not None]
        assert r[0] == min(ids, default=None)


def test_search_unit_links_what_is_linked():
    rng = np.random.default_rng(3)
    for _ in range(40):
        pool = rng.integers(1, 2 ** 62, 60).astype(np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(5, 50))) for _ in range(25)]
        sets += [np.unique(np.concatenate([s[:-1], rng.choice(pool, 1)])) for s in sets[:10]]
        links = search_unit(np.array([s.size for s in sets]), sets, JaccardConfig())
        label = list(range(len(sets)))
        want = list(range(len(sets)))

        def join(labels, a, b):
            old = labels[b]
            labels[:] = [labels[a] if x == old else x for x in labels]

        for a, b in links:
            join(label, a, b)
        for i in range(len(sets)):
            for j in range(i):
                o = np.intersect1d(sets[i], sets[j]).size
                if 100 * o >= 75 * (sets[i].size + sets[j].size - o):
                    join(want, i, j)
        canon = lambda x: [x.index(v) for v in x]
        assert canon(label) == canon(want)
        assert len(links) < len(sets)


def test_packed_ids_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 5000):
        ids = rng.integers(0, 2 ** 48, n).astype(np.uint64)
        for x in (ids, np.sort(ids), np.sort(ids >> np.uint64(14))):
            assert (unpack_hashes(pack_hashes(x)) == x).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (103, 103), (None, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_empty_table(spark):
    docs = cases.empty(cases.documents(spark))
    assert near_duplicate_components(docs).collect() == []
    assert keep_one_per_component(docs).collect() == []


def test_words_that_sums_of_powers_confuse(spark):
    texts = [t for k in (9, 10, 11, 12) for t in cases.thue_morse(k)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[2]])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicate_components(docs).collect()}
    assert got == {**{i: i for i in range(8)}, 8: 2}


def test_work_arrays_are_of_a_part_not_of_the_block():
    texts = pa.array([cases.prose(random.Random(i), 180) for i in range(3000)])
    config = JaccardConfig()
    whole = np.frombuffer(texts.buffers()[2], np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int32).astype(np.int64)
    want = shingle_hashes(whole[:offsets[-1]], offsets, config.words)
    tracemalloc.start()
    try:
        found = [s for part in _block_sets(texts, config) for s in part]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == len(want) and all((a == b).all() for a, b in zip(found, want))
    assert peak < 6 * texts.nbytes


@pytest.mark.parametrize("sets", [40, (1 << 16) + 3])
def test_by_shingle(sets):
    rng = np.random.default_rng(5)
    arrays = [np.unique(rng.integers(0, 1 << 20, 4, np.uint64) << np.uint64(16) | np.uint64(k % 7)) for k in range(sets)]
    sizes = np.array([a.size for a in arrays])
    ids, idx = _by_shingle(arrays, sizes)
    want = sorted((int(h) >> 16, k) for k, a in enumerate(arrays) for h in a)
    assert list(zip(ids.tolist(), idx.tolist())) == want
