"""Near-duplicate documents by an exact n-gram Jaccard join (T-occurrence).

A document is the set of its distinct word shingles.  Two link when their
Jaccard similarity reaches the threshold; linked documents form components.

1. ``shingle_sets`` gives every row its set size and a 128-bit digest of the
   set.  Equal sets are one class from here on, however many copies there
   are; each block of documents sends a class once.
2. ``shared_shingles`` finds which shingles occur in two sets or more.  A
   block sends every distinct shingle once, to a hash range, with the number
   of its sets that hold it; a passage in a third of all documents costs one
   entry per block.  A set can only link if at least the needed overlap of its
   shingles is shared; others end here.
3. The rarest shared shingles of a set, as many as any partner must meet, give
   star edges; their components are the units of the search.  A very large
   unit is cut into blocks and searched block against block.
4. ``search_unit`` answers T-occurrence queries by DivideSkip inside a unit.
   A query that joins the largest component needs no query of its own: two
   members of it are connected already.  So links come out as a spanning
   forest, never as all pairs of a group, and none between different
   components is missed.
5. Components of the links give each class its smallest document id.

Shingles are compared by 64-bit hashes inside a document and by 48 of those
bits between two documents, sets by 128-bit digests.

Defined results: null text, empty text and text without a word have an empty
set, size 0, and are linked with nothing (``component_id`` is their own id).
Fewer words than a shingle are one shingle.  Repeated rows are copies of each
other.  A null id counts only where its component has no other.  Empty tables
give empty results.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import fresh_name, settle, tidy, with_field
from .components import connected_components
from .textblocks import (LOWER, _U, blocks, mix, text_array, window_hashes, word_bounds, word_hashes)


@dataclass(frozen=True)
class JaccardConfig:
    words: int = 5
    percent: int = 75
    block_bytes: int = 4 << 20
    unit_postings: int = 1_000_000   # larger units are searched in blocks
    mu: float = 0.0085               # DivideSkip's weight of a long list


PART_BYTES = 1 << 19


def needed_overlap(n, percent: int):
    """Least overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block."""
    data = LOWER[data]
    starts, ends, doc = word_bounds(data, offsets)
    hashed = word_hashes(data, starts, ends)
    windows = window_hashes(hashed, words)
    count = np.bincount(doc, minlength=offsets.size - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    out = []
    for i, n in enumerate(count):
        if n >= words:
            out.append(np.unique(windows[first[i]:first[i + 1] - words + 1]))
        elif n:
            out.append(mix(window_hashes(hashed[first[i]:first[i + 1]], int(n)) + _U(n)))
        else:
            out.append(np.zeros(0, _U))
    return out


def _digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.md5(hashes.tobytes()).digest() if hashes.size else None


def _block_sets(texts: pa.Array, config: JaccardConfig):
    """The sets of each block, from a part of its documents at a time: work
    arrays are of the part's size."""
    for row, last, _, _ in blocks(texts, config.block_bytes):
        part = texts.slice(row, last - row)
        yield [s for _, _, data, offsets in blocks(part, PART_BYTES)
               for s in shingle_hashes(data, offsets, config.words)]


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, config: JaccardConfig) -> DataFrame:
    """``(id, n_shingles, cls)`` of every row; ``cls`` is null for an empty set."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            found = [(s.size, _digest(s)) for part in _block_sets(text_array(batch, "text"), config) for s in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([d for _, d in found], pa.binary())], ["id", "n_shingles", "cls"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(tidy(run), f"id {kind}, n_shingles long, cls binary")


# -- which shingles do sets share ------------------------------------------
#
# Shingle ids on the wire are the upper 48 bits of the hashes.

_PIECES = "part int, block binary, table binary, sizes binary, idx binary, hashes binary, counts binary"


def pack_hashes(ids: np.ndarray) -> bytes:
    """48-bit ids in six bytes each; ascending ones with small gaps as the
    first id and four-byte gaps."""
    if ids.size and (ids[1:] >= ids[:-1]).all():
        gaps = np.diff(ids)
        if not gaps.size or gaps.max() < 1 << 32:
            return b"g" + ids[:1].tobytes() + gaps.astype("<u4").tobytes()
    return b"w" + np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack_hashes(raw: bytes) -> np.ndarray:
    if raw[:1] == b"g":
        gaps = np.frombuffer(raw, "<u4", offset=9)
        return np.cumsum(np.concatenate([np.frombuffer(raw, _U, 1, 1), gaps.astype(_U)]), dtype=_U)
    wide = np.zeros(((len(raw) - 1) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(_U)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
        ["part", "block", "table", "sizes", "idx", "hashes", "counts"])


def _by_shingle(arrays: list[np.ndarray], sizes: np.ndarray):
    """Shingle ids in ascending order and the numbers of their sets."""
    if len(arrays) > 1 << 16:
        ids = np.concatenate([a >> _U(16) for a in arrays])
        order = np.argsort(ids, kind="stable")
        return ids[order], np.repeat(np.arange(len(arrays), dtype=np.uint32), sizes)[order]
    keys, at = np.empty(sizes.sum(), _U), 0     # id and number in one word, sorted in place
    for i, a in enumerate(arrays):
        keys[at:at + a.size] = a & ~_U(0xFFFF) | _U(i)
        at += a.size
    keys.sort()
    return keys >> _U(16), (keys & _U(0xFFFF)).astype(np.uint16)


def _split_block(sets: list[np.ndarray], parts: int):
    """One table row of the block's distinct sets, with the places of what
    they share inside the block, and one row per hash range with each distinct
    shingle once and the number of sets that hold it."""
    own = {}
    for s in sets:
        if s.size:
            own.setdefault(_digest(s), s)
    if not own:
        return
    classes = sorted(own)
    sizes = np.array([own[c].size for c in classes], np.int64)
    ids, idx = _by_shingle([own.pop(c) for c in classes], sizes)
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    counts = np.diff(np.append(first, ids.size))
    several = np.repeat(counts > 1, counts)
    block = hashlib.md5(b"".join(classes)).digest()
    home = int.from_bytes(block[:4], "little") % parts
    yield (home, block, b"".join(classes), sizes.tobytes(),
           idx[several].tobytes(), pack_hashes(ids[several]), None)
    ids, idx, counts = ids[first], idx[first], np.minimum(counts, 255).astype(np.uint8)
    part = ((ids >> _U(16)) * _U(parts)) >> _U(32)
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    for lo, hi in zip(cuts, [*cuts[1:], ids.size]):
        yield (int(part[lo]), block, None, None, idx[lo:hi].tobytes(), pack_hashes(ids[lo:hi]),
               counts[lo:hi].tobytes())


def _groups(batches, key: int):
    """Lists of rows (tuples) with equal ``key``, from sorted batches."""
    held: list = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _indices(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * count else np.uint32)


def _shared_of_part(rows: list[tuple]):
    """Of one hash range: per block, the shingles that two sets or more hold,
    with the (capped) power of two of how many; table rows pass through.
    Blocks of the same classes have one name and equal rows; one of each counts."""
    yield from {r[1]: r for r in rows if r[2] is not None}.values()
    rows = list({r[1]: r for r in rows if r[2] is None}.values())
    if not rows:
        return
    ids = np.concatenate([unpack_hashes(r[5]) for r in rows])
    order = np.argsort(ids, kind="stable")
    ranked = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.concatenate([np.frombuffer(r[6], np.uint8) for r in rows])
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    rarity = np.zeros(ids.size, np.uint8)
    rarity[order] = np.repeat(np.log2(total).astype(np.uint8), np.diff(np.append(first, ids.size)))
    at = 0
    for r in rows:
        n = len(r[6])
        mine = rarity[at:at + n]
        hit = mine > 0
        if hit.any():
            yield (r[0], r[1], None, None, _indices(r[4], n)[hit].tobytes(),
                   pack_hashes(ids[at:at + n][hit]), mine[hit].tobytes())
        at += n


def _sets_of_block(rows: list[tuple], percent: int):
    """``(cls, n, shared ids, rarest first)`` of the sets that share enough."""
    table = next(r for r in rows if r[2] is not None)
    rows = [r for r in rows if r[2] is None]
    if not rows:
        return
    sizes = np.frombuffer(table[3], np.int64)
    known = np.concatenate([unpack_hashes(r[5]) for r in rows])
    rarity = np.concatenate([np.frombuffer(r[6], np.uint8) for r in rows])
    idx = np.concatenate([_indices(r[4], len(r[6])) for r in rows])
    order = np.argsort(known)
    known, rarity, idx = known[order], rarity[order], idx[order]
    local = unpack_hashes(table[5]) if len(table[4]) else np.zeros(0, _U)
    places = np.searchsorted(known, local)
    alone = np.ones(known.size, bool)
    alone[places] = False                       # listed by the block itself, for each of its sets
    ids = np.concatenate([known[alone], local])
    rare = np.concatenate([rarity[alone], rarity[places]])
    idx = np.concatenate([idx[alone], _indices(table[4], local.size)]).astype(np.int64)
    order = np.lexsort((ids, rare, idx))
    idx, ids = idx[order], ids[order]
    cuts = np.searchsorted(idx, np.arange(sizes.size + 1))
    enough = np.diff(cuts) >= needed_overlap(sizes, percent)
    for i in np.flatnonzero(enough):
        yield table[2][16 * i:16 * i + 16], int(sizes[i]), pack_hashes(ids[cuts[i]:cuts[i + 1]])


def shared_shingles(docs: DataFrame, text_col: str, config: JaccardConfig) -> DataFrame:
    """``(cls, n, shared)`` of the classes that share enough shingles with
    others: ``shared`` packs the shared ids, the rarest first."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 2 * tasks                  # a task reads its hash ranges one after the other

    def split(batches):
        for batch in batches:
            for sets in _block_sets(text_array(batch, "text"), config):
                rows = list(_split_block(sets, parts))
                if rows:
                    yield _piece_batch(rows)

    def by_part(batches):
        for rows in _groups(batches, 0):
            for at in range(0, len(out := list(_shared_of_part(rows))), 256):
                yield _piece_batch(out[at:at + 256])

    def by_block(batches):
        for rows in _groups(batches, 1):
            out = list(_sets_of_block(rows, config.percent))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.binary())], ["cls", "n", "shared"])

    pieces = docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(split), _PIECES)
    found = (pieces.repartition(tasks, "part").sortWithinPartitions("part")
             .mapInArrow(tidy(by_part), _PIECES))
    sets = (found.repartition(tasks, "block").sortWithinPartitions("block")
            .mapInArrow(tidy(by_block), "cls binary, n long, shared binary"))
    return settle(sets.dropDuplicates(["cls"]))


# -- units and the search inside them ----------------------------------------

def candidate_units(sets: DataFrame, config: JaccardConfig) -> DataFrame:
    """``sets`` with the unit keys ``(label, i, j)`` they are searched in."""
    percent = config.percent

    def prefixes(batches):
        for batch in batches:
            for cls, n, shared in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack_hashes(shared)
                head = ids[:ids.size - int(needed_overlap(n, percent)) + 1].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head), pa.array([cls] * head.size, pa.binary())], ["h", "cls"])

    postings = sets.mapInArrow(tidy(prefixes), "h long, cls binary")
    roots = (postings.groupBy("h").agg(F.min("cls").alias("root"), F.count("*").alias("c"))
             .filter("c > 1"))
    edges = postings.join(roots, "h").filter("cls <> root").select(
        F.col("root").alias("a"), F.col("cls").alias("b")).distinct()
    label = settle(connected_components(edges).withColumnRenamed("component", "label"))
    member = sets.join(label, sets["cls"] == label["node"]).select(
        "cls", "n", "shared", "label", (F.octet_length("shared") / 6).alias("m"))
    blocks_of = (member.groupBy("label").agg(F.ceil(F.sum("m") / config.unit_postings).cast("int").alias("nb")))
    member = member.join(blocks_of, "label").withColumn("b", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    return member.withColumn("o", other).select(
        "label", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "cls", "n", "shared")


def search_unit(sizes: np.ndarray, sets: list[np.ndarray], config: JaccardConfig):
    """Linked pairs ``(q, c)`` that connect the unit's components.

    Lists of a query are divided: the longest are only probed by binary
    search, the short ones are merged (numpy's run-merging sort stands in for
    the heap) and must bring a document ``T`` minus the number of long lists
    times.
    """
    docs, percent = len(sets), config.percent
    owner = np.repeat(np.arange(docs), [s.size for s in sets])
    distinct, hid, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(hid, kind="stable")
    posting, start = owner[order], np.concatenate([[0], np.cumsum(df)])
    cells = hid[order].astype(np.int64) * docs + posting
    cut = np.concatenate([[0], np.cumsum([s.size for s in sets])])
    component = np.arange(docs)
    asked = np.zeros(docs, bool)
    links = []
    hub = 0
    while True:
        todo = np.flatnonzero(~asked & (component != hub))
        if not todo.size:
            return links
        for q in todo:
            if component[q] == hub:
                continue
            asked[q] = True
            lists = hid[cut[q]:cut[q + 1]]
            lists = lists[df[lists] > 1]
            need = int(needed_overlap(sizes[q], percent))
            if lists.size < need:
                continue
            lists = lists[np.argsort(df[lists], kind="stable")]
            longest = int(df[lists[-1]])
            skip = min(need - 1, int(need / (config.mu * np.log2(longest) + 1)))
            short, probed = lists[:lists.size - skip], lists[lists.size - skip:]
            merged = np.sort(np.concatenate([posting[start[h]:start[h + 1]] for h in short]), kind="stable")
            first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
            found, times = merged[first], np.diff(np.append(first, merged.size))
            good = ((times >= need - skip) & (component[found] != component[q])
                    & (100 * np.minimum(sizes[found], sizes[q]) >= percent * np.maximum(sizes[found], sizes[q])))
            found, times = found[good], times[good]
            for at in range(0, found.size, 4096):
                part = found[at:at + 4096]
                want = probed[:, None] * docs + part[None, :]
                place = np.minimum(np.searchsorted(cells, want), cells.size - 1)
                times[at:at + 4096] += (cells[place] == want).sum(0)
            linked = found[100 * times >= percent * (sizes[q] + sizes[found] - times)]
            for c in linked:
                if component[c] != component[q]:
                    links.append((int(q), int(c)))
                    component[component == component[c]] = component[q]
            if linked.size:
                hub = np.bincount(component, minlength=docs).argmax()


def links_of_units(units: DataFrame, config: JaccardConfig) -> DataFrame:
    """Links ``(a, b)`` between classes that connect all that is linked."""
    keys = ["label", "i", "j"]

    def run(batches):
        held: list = []

        def answer():
            sets = [unpack_hashes(r[5]) for r in held]
            pairs = search_unit(np.array([r[4] for r in held]), sets, config) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([held[x][3] for x, _ in pairs], pa.binary()),
                 pa.array([held[y][3] for _, y in pairs], pa.binary())], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:3] != row[:3]:
                    yield answer()
                    held = []
                held.append(row)
        if held:
            yield answer()

    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (units.repartition(parts, *keys).sortWithinPartitions(*keys, "cls")
            .mapInArrow(tidy(run), "a binary, b binary"))


def _classes(docs: DataFrame, id_col: str, text_col: str, config: JaccardConfig):
    """(rows with class, class -> component label) as settled tables."""
    rows = settle(shingle_sets(docs, id_col, text_col, config))
    sets = shared_shingles(docs, text_col, config)
    links = links_of_units(candidate_units(sets, config), config)
    label = connected_components(links).select(F.col("node").alias("cls"), F.col("component").alias("label"))
    return rows, label


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row."""
    rows, label = _classes(docs, id_col, text_col, config)
    least = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("id").alias("first"))
    named = least.join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    whole = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = named.join(whole, "label").select("cls", "component_id")
    return rows.join(of_class, "cls", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """The rows of ``docs``, one of each component: the one with its smallest
    id (of several, the smallest digest).  Rows with an empty set all stay."""
    rows, label = _classes(docs, id_col, text_col, config)
    full = rows.filter("cls IS NOT NULL")
    candidate = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "cls")).alias("k")
    of_class = full.groupBy("cls").agg(candidate).join(label, "cls", "left")
    keeper = (of_class.groupBy(F.coalesce("label", "cls")).agg(F.min("k").alias("k"))
              .select(F.col("k.id").alias("keep_id"), F.col("k.cls").alias("keep_cls")))
    cls = fresh_name(docs, "shingle_class")
    place = docs.columns.index(text_col)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):      # small batches back to the JVM
                batch = whole.slice(at, 1024)
                texts = text_array(pa.RecordBatch.from_arrays([batch.column(place)], ["text"]), "text")
                found = [_digest(s) for part in _block_sets(texts, config) for s in part]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())],
                                                 [*batch.schema.names, cls])

    marked = docs.mapInArrow(tidy(run), with_field(docs.schema, cls, BinaryType()))
    stay = marked.join(keeper, marked[cls].eqNullSafe(keeper["keep_cls"])
                       & marked[id_col].eqNullSafe(keeper["keep_id"]), "left_semi")
    one = stay.dropDuplicates([id_col, cls])
    return one.unionByName(marked.filter(F.col(cls).isNull())).drop(cls)


def op3_jaccard_join(spark, sf_dir):
    """Set size and component of every row of ``documents``."""
    return near_duplicate_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5
      THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
      ELSE [array_to_string(ws, ' ')] END) AS g FROM d WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT s.doc_id, s.g, n FROM s JOIN common USING (g) JOIN size USING (doc_id)),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = d.doc_id), d.doc_id)) AS component_id
FROM d LEFT JOIN size USING (doc_id)"""
