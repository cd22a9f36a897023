"""Repeated byte strings across a corpus by prefix-free parsing.

Every byte covered by a ``length``-byte string that starts anywhere else is
found, over all documents, without one corpus-wide suffix array.

* Parsing.  A rolling hash of ``gram`` bytes picks, for each window start,
  the trigger position with the smallest hash among the first ``span``
  positions of the window.  Consecutive windows with one trigger are a phrase.
  The trigger depends on the window's own bytes only, so equal windows have
  equal triggers at equal offsets, wherever they stand, and every window has
  one (a plain modulus trigger may leave long stretches without any).
* Dictionary.  Phrases are counted by the bytes that all their windows share
  (``k``) and by all their bytes (``f``).  A ``k`` seen once has no repeated
  window; an ``f`` seen twice is repeated as a whole.  Only what lies between,
  the ends of copied passages, needs an order.
* Order.  For those, the phrases of one ``k`` are sorted twice, by the text
  after the trigger (the parse side) and by the text before it, reversed (the
  dictionary side), with longest common prefixes.  Windows at offset ``d`` are
  equal when they are in one class of the first order at length ``length - d``
  and in one class of the second at ``d``; so the two suffix orders combine
  into the order of all windows.  A ``k`` with more than ``order_limit``
  distinct phrases (a passage in very many documents) is not gathered in one
  task: its windows are counted one by one by hash, which combines in each
  task before the exchange.

Equal texts are one entry (``key``); a text that occurs twice is repeated as
a whole.  A block of documents settles the phrases it holds several times by
itself and sends each phrase once, so periodic text, copies and frequent
passages cost one row per block.
Equality is by 64-bit hashes of the bytes, by the bytes themselves inside the
orders.

Defined results: null is the empty text; a text shorter than ``length`` loses
nothing; repeated rows are copies of each other; null ids stay null; an empty
table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .textblocks import BLOCK_BYTES, _U, blocks, mix, segment_hashes, text_array


@dataclass(frozen=True)
class RepeatConfig:
    length: int = 400
    span: int = 200
    gram: int = 8
    order_limit: int = 20_000


# -- parsing -------------------------------------------------------------------

def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i + width]`` for every full window."""
    count = values.size - width + 1
    padded = np.full(-(-values.size // width) * width, np.iinfo(np.uint64).max, _U)
    padded[:values.size] = values
    tiles = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def _triggers(data: np.ndarray, config: RepeatConfig) -> np.ndarray:
    """Trigger position of every window start of ``data``."""
    grams = data.size - config.gram + 1
    rolled = np.zeros(grams, _U)
    for i in range(config.gram):
        rolled = (rolled << _U(8)) | data[i:i + grams].astype(_U)
    # ties of the upper half go to the first position
    ranked = (mix(rolled) & _U(0xFFFFFFFF00000000)) | np.arange(grams, dtype=_U)
    least = _sliding_minimum(ranked, config.span)
    return (least & _U(0xFFFFFFFF)).astype(np.int64)[:max(0, data.size - config.length + 1)]


def _phrases(data: np.ndarray, offsets: np.ndarray, config: RepeatConfig):
    """``(document, first window, last window, trigger, k, f)`` arrays of all
    phrases of a block, positions within the block."""
    if data.size < config.length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, _U)] * 2
    trigger = _triggers(data, config)
    inside = np.zeros(trigger.size + 1, np.int8)
    for lo, hi in zip(offsets[:-1], offsets[1:] - config.length + 1):
        if hi > lo:
            inside[lo] += 1
            inside[hi] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= (trigger[1:] != trigger[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= (trigger[1:] != trigger[:-1]) | ~inside[1:]
    last = np.flatnonzero(stop)
    at = trigger[first]
    doc = np.searchsorted(offsets, first, "right") - 1
    k = segment_hashes(data, at, at + config.length - config.span + 1, rolling=True)
    f = segment_hashes(data, first, last + config.length, rolling=True)
    f = mix(f + (at - first).astype(_U) * _U(0x9E3779B97F4A7C15) + (last - first).astype(_U))
    return doc, first, last, at, k, f


def _pack(first, last, at):
    return (first << 20) | ((at - first) << 10) | (last - first)


def _block_phrases(texts: pa.Array, config: RepeatConfig, step: int = BLOCK_BYTES):
    """``(rows, k, f, position)`` over an Arrow text column; a longer text is
    parsed in overlapping pieces (a phrase may end early at a seam)."""
    for row, stop, data, offsets in blocks(texts, step):
        if stop - row == 1 and data.size > 2 * step:
            for base in range(0, max(1, data.size - config.length + 1), step):
                piece = data[base:base + step + config.length - 1]
                doc, first, last, at, k, f = _phrases(piece, np.array([0, piece.size]), config)
                yield doc + row, k, f, _pack(first + base, last + base, at + base)
        else:
            doc, first, last, at, k, f = _phrases(data, offsets, config)
            base = offsets[doc]
            yield doc + row, k, f, _pack(first - base, last - base, at - base)


def _keyed(docs: DataFrame, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*more, text.alias("text")).withColumn("key", F.xxhash64("text"))


def _settled_here(row, k, f, pos, config: RepeatConfig):
    """Phrases that a block holds several times are repeated whatever the
    rest of the corpus says: ``(index of the first of each phrase, its times
    (1, or 2 for more), merged spans (row, a, b) of those with more)``."""
    order = np.lexsort((f, k))
    new = np.ones(k.size, bool)
    new[1:] = (k[order][1:] != k[order][:-1]) | (f[order][1:] != f[order][:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, k.size))
    several = np.sort(order[np.repeat(count > 1, count)])        # in text order
    row, begin = row[several], pos[several] >> 20
    end = begin + (pos[several] & 1023) + config.length
    reach = np.maximum.accumulate(end + (row << 32)) if row.size else end
    opens = np.ones(row.size, bool)
    opens[1:] = begin[1:] + (row[1:] << 32) > reach[:-1]
    opens = np.flatnonzero(opens)
    last = np.append(opens[1:], row.size)[:opens.size] - 1
    return order[first], np.minimum(count, 2), (row[opens], begin[opens], reach[last] - (row[last] << 32))


def phrases(docs: DataFrame, text_col: str, config: RepeatConfig) -> DataFrame:
    """``(k, f, key, pos, times, a, b)``: each phrase once per block, ``pos``
    packing first window, trigger and last window; and, with ``a`` set, the
    spans of phrases the block itself holds several times (``k`` only spreads
    them).  A block sends equal texts once."""
    def run(batches):
        for batch in batches:
            keys = batch.column(1).to_numpy()
            _, one = np.unique(keys, return_index=True)
            batch = batch.take(pa.array(np.sort(one)))
            keys = batch.column(1).to_numpy()
            for row, k, f, pos in _block_phrases(text_array(batch, "text"), config):
                if not row.size:
                    continue
                at, times, (held, a, b) = _settled_here(row, k, f, pos, config)
                none, gone = pa.nulls(at.size, pa.int64()), pa.nulls(held.size, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[at].view(np.int64)), pa.array(f[at].view(np.int64)), pa.array(keys[row[at]]),
                     pa.array(pos[at]), pa.array(times.astype(np.int64)), none, none], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[held]), gone, pa.array(keys[held]), gone, gone, pa.array(a), pa.array(b)], names)

    names = ["k", "f", "key", "pos", "times", "a", "b"]
    return _keyed(docs, text_col).mapInArrow(run, ", ".join(f"{n} long" for n in names))


# -- order -------------------------------------------------------------------

def _common_prefixes(rows: np.ndarray, sizes: np.ndarray, group: np.ndarray):
    """(order by group and bytes, common prefix with the row before)."""
    by_size = np.argsort(sizes, kind="stable")
    flat = np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()
    order = by_size[np.argsort(flat[by_size], kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    a, b = order[:-1], order[1:]
    common = np.zeros(order.size, np.int64)
    for at in range(0, a.size, 4096):
        x, y = a[at:at + 4096], b[at:at + 4096]
        differ = rows[x] != rows[y]
        length = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        length = np.minimum(length, np.minimum(sizes[x], sizes[y]))
        common[at + 1:at + 1 + x.size] = np.where(group[x] == group[y], length, -1)
    common[:1] = -1
    return order, common


def repeated_windows(texts: list[bytes], trigger: np.ndarray, group: np.ndarray,
                     whole: np.ndarray, config: RepeatConfig) -> list[np.ndarray]:
    """For phrases ``texts`` (all bytes of their windows), the mask over each
    one's windows that some other phrase of its group repeats; ``whole``:
    the phrase is known to occur twice."""
    n, length = len(texts), config.length
    size = np.array([len(t) for t in texts])
    before, after = trigger, size - trigger
    least = length - after                        # offsets d of its windows: least..before
    parse = np.zeros((n, int(after.max())), np.uint8)
    dictionary = np.zeros((n, max(1, int(before.max()))), np.uint8)
    for i, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        parse[i, :after[i]] = raw[before[i]:]
        dictionary[i, :before[i]] = raw[:before[i]][::-1]
    parse_order, parse_common = _common_prefixes(parse, after, group)
    word_order, word_common = _common_prefixes(dictionary, before, group)
    masks = [np.zeros(size[i] - length + 1, bool) for i in range(n)]
    of_parse, of_word = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in range(int(least.min()), int(before.max()) + 1):
        of_parse[parse_order] = np.cumsum(parse_common < length - d)
        of_word[word_order] = np.cumsum(word_common < d)
        active = np.flatnonzero((least <= d) & (d <= before))
        if not active.size:
            continue
        _, inverse, count = np.unique(of_parse[active] * (n + 1) + of_word[active],
                                      return_inverse=True, return_counts=True)
        again = np.bincount(inverse, whole[active]) > 0
        for i in active[(count > 1)[inverse] | again[inverse]]:
            masks[i][before[i] - d] = True
    return masks


def _runs(mask: np.ndarray):
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


_CONTEXT = "k long, f long, key long, pos long, whole boolean, text binary"


def _ordered_spans(contexts: DataFrame, config: RepeatConfig, parts: int) -> DataFrame:
    """``(key, a, b)``: byte spans of the windows that repeat, for phrases
    that are not repeated as a whole."""
    def run(batches):
        held: list = []

        def answer():
            group = np.unique([r[0] for r in held], return_inverse=True)[1]
            first, at = [r[3] >> 20 for r in held], np.array([(r[3] >> 10) & 1023 for r in held])
            masks = repeated_windows([r[5] for r in held], at, group,
                                     np.array([r[4] for r in held], np.int64), config)
            out = [(r[2], start + int(lo), start + int(hi) - 1 + config.length)
                   for r, start, mask in zip(held, first, masks) if not r[4]
                   for lo, hi in zip(*_runs(mask))]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["key", "a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] == held[-1][:2]:
                    continue                       # one text of equal phrases is enough
                if len(held) >= config.order_limit and row[0] != held[-1][0]:
                    yield answer()
                    held = []
                held.append(row)
        if held:
            yield answer()

    return (contexts.repartition(parts, "k").sortWithinPartitions("k", "f")
            .mapInArrow(run, "key long, a long, b long"))


def _counted_spans(contexts: DataFrame, config: RepeatConfig) -> DataFrame:
    """The same for very frequent ``k``: every window by its hash."""
    def run(batches):
        for batch in batches:
            for k, f, key, pos, whole, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(text, np.uint8)
                lo = np.arange(data.size - config.length + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment_hashes(data, lo, lo + config.length, rolling=True).view(np.int64)),
                     pa.array([f] * lo.size, pa.int64()), pa.array([key] * lo.size, pa.int64()),
                     pa.array(lo + (pos >> 20)), pa.array([whole] * lo.size)],
                    ["h", "f", "key", "p", "whole"])

    windows = contexts.mapInArrow(run, "h long, f long, key long, p long, whole boolean")
    # of one hash, two different phrases or one that is known to occur twice
    twice = windows.groupBy("h").agg(F.min("f").alias("x"), F.max("f").alias("y"), F.max("whole").alias("w"))
    twice = twice.filter("x <> y OR w").select("h")
    return windows.filter(~F.col("whole")).join(twice, "h").select(
        "key", F.col("p").alias("a"), (F.col("p") + config.length).alias("b"))


def repeat_spans(docs: DataFrame, text_col: str = "text",
                 config: RepeatConfig = RepeatConfig()) -> DataFrame:
    """``(key, spans)``: for each text that shares something, by its 64-bit
    hash, the byte spans (possibly overlapping) covered by repeated strings."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = phrases(docs, text_col, config)
    groups = (found.filter("a IS NULL").groupBy("k")
              .agg(F.sum("times").alias("c"), F.min("f").alias("x"), F.max("f").alias("y"))
              .filter("c > 1").select("k", (F.col("x") == F.col("y")).alias("same")))
    kept = settle(found.join(groups, "k", "left").filter("a IS NOT NULL OR same IS NOT NULL"))
    shared = kept.filter("a IS NULL")
    first = F.shiftright("pos", 20)
    span = ["key", first.alias("a"), (first + F.col("pos").bitwiseAND(1023) + config.length).alias("b")]
    mixed = shared.filter("NOT same")
    copies = settle(mixed.groupBy("k", "f").agg(
        F.sum("times").alias("c"), F.min(F.struct("key", "pos")).alias("one")))
    whole = mixed.join(copies.filter("c > 1").select("k", "f"), ["k", "f"], "left_semi")
    wide = copies.groupBy("k").agg(F.count("*").alias("d"))
    wanted = (copies.join(wide, "k").select(
        F.col("one.key").alias("key"),
        F.struct("k", "f", F.col("one.pos").alias("pos"), (F.col("c") > 1).alias("whole"),
                 (F.col("d") > config.order_limit).alias("frequent")).alias("p"))
        .groupBy("key").agg(F.collect_list("p").alias("want")))
    needed = _keyed(docs, text_col).join(wanted, "key")

    def cut(batches):
        for batch in batches:
            for key, text, want in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8")
                at = [(p["pos"] >> 20, (p["pos"] & 1023) + config.length) for p in want]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["k"] for p in want], pa.int64()), pa.array([p["f"] for p in want], pa.int64()),
                     pa.array([key] * len(want), pa.int64()), pa.array([p["pos"] for p in want], pa.int64()),
                     pa.array([p["whole"] for p in want]), pa.array([raw[a:a + n] for a, n in at], pa.binary()),
                     pa.array([p["frequent"] for p in want])],
                    ["k", "f", "key", "pos", "whole", "text", "frequent"])

    contexts = settle(needed.select("key", "text", "want").mapInArrow(cut, _CONTEXT + ", frequent boolean"))
    spans = (kept.filter("a IS NOT NULL").select("key", "a", "b")
             .unionByName(shared.filter("same").select(*span))
             .unionByName(whole.select(*span))
             .unionByName(_ordered_spans(contexts.filter("NOT frequent").drop("frequent"), config, parts))
             .unionByName(_counted_spans(contexts.filter("frequent").drop("frequent"), config)))
    return spans.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _kept(data: bytes, spans, every: bool, config: RepeatConfig):
    """(remaining bytes, removed spans) of one text."""
    if every and len(data) >= config.length:
        return b"", [(0, len(data))]
    merged: list = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]), merged


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   config: RepeatConfig = RepeatConfig(), digest: bool = False) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and the remaining
    bytes (``kept``, or with ``digest`` their sha256) of every row."""
    keyed = _keyed(docs, text_col, F.col(id_col).alias("id"))
    twice = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key", F.lit(True).alias("copied"))
    joined = (keyed.join(repeat_spans(docs, text_col, config), "key", "left").join(twice, "key", "left")
              .select("id", "text", "spans", "copied"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes, removed, count, kept = [], [], [], []
                for text, spans, copied in zip(*(c.to_pylist() for c in batch.columns[1:])):
                    data = text.encode("utf-8")
                    left, cut = _kept(data, spans, bool(copied), config)
                    sizes.append(len(data))
                    removed.append(len(data) - len(left))
                    count.append(len(cut))
                    kept.append(hashlib.sha256(left).hexdigest() if digest else left)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(count, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = keyed.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, "
                                 f"kept {'string' if digest else 'binary'}")
    return out.withColumnsRenamed({"id": id_col, **({"kept": "kept_sha256"} if digest else {})})


def op10_repeats(spark, sf_dir):
    """Removed repeats of every row of ``documents``."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)


OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (
  SELECT r, unnest(range(octet_length(b) - 399)) AS p,
    unnest([md5(hex(b[i + 1:i + 400])) FOR i IN range(octet_length(b) - 399)]) AS h
  FROM d WHERE octet_length(b) >= 400),
hit AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY h) AS c FROM starts) WHERE c > 1),
edge AS (
  SELECT r, p, CASE WHEN p > coalesce(max(p) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 400, -1)
    THEN 1 ELSE 0 END AS opens FROM hit),
numbered AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS g FROM edge),
span AS (SELECT r, g, min(p) AS x, max(p) + 400 AS y FROM numbered GROUP BY r, g),
cut AS (
  SELECT r, g, coalesce(lag(y) OVER (PARTITION BY r ORDER BY x), 0) AS x, x AS y FROM span
  UNION ALL SELECT r, 1000000000, coalesce(max(y), 0), max(octet_length(b)) FROM d LEFT JOIN span USING (r) GROUP BY r),
kept AS (
  SELECT r, sha256(unhex(string_agg(hex(b[x + 1:y]), '' ORDER BY x))) AS kept_sha256, sum(y - x) AS n_kept FROM cut JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(octet_length(b) - n_kept AS BIGINT) AS n_removed,
  (SELECT count(*) FROM span WHERE span.r = d.r) AS n_spans, kept_sha256
FROM d JOIN kept USING (r)"""
