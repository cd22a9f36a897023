"""Phrase collocations by best-first branch-and-bound growth.

Words are grown into phrases of up to four.  A phrase's count bounds that of
all its extensions, so with ``l`` the count of a leading part and ``a`` the
phrase's own, no extension scores more than ``floor(scale * a / (l + a))`` at
that cut: an admissible bound, which never rises by growing.  Every pass over
the texts grows, per language, the unexpanded phrases of highest bound (a batch
that grows fourfold), counting their extensions to the right (which may score) and to
the left (which decide whether a phrase lies inside a longer one).  A phrase is
settled once it has been grown; growth ends when no unexpanded phrase's bound
reaches its language's 2000th surviving score, so ties at that score are
settled too.

A pass counts only n-grams that some grown phrase begins or ends and whose
word pairs are all frequent.  Tasks look that up in bit tables of a fixed size
(``bits``), where a false hit costs a count and never a result: what is
returned is joined exactly.  Counts are combined per block of texts, then per
task, then exchanged by phrase, so a frequent phrase or language is no hot key.

Defined results: a null text is empty; a null language is ``und``; pieces and
words are cut by the fixed sets below and never cross documents; repeated rows
count as often as they stand; ties go by count, then by phrase in byte order;
a very long text is a block of its own (some arrays of its bytes and words are
held); an empty table, or one without candidates, gives no rows; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_unique, settle, tidy
from .textblocks import LOWER, blocks, mix, segment_hashes, text_array, window_factors

LONGEST = 4
BREAK = np.zeros(256, bool)              # ends a piece
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
GAP = BREAK.copy()                       # ends a word
GAP[[0x20, 0x09]] = True


@dataclass(frozen=True)
class CollocationConfig:
    least: int = 30                      # occurrences of a candidate
    top: int = 2000                      # phrases reported per language
    scale: int = 2_000_000
    inside: int = 80                     # percent of a phrase's count
    batch: int = 1 << 14                 # phrases grown per language in the first round
    bits: int = 1 << 24                  # of each broadcast bit table (2 MB)
    block_bytes: int = 3 << 20


# -- blocks of texts to counted phrases -----------------------------------------

def _words(data, offsets):
    """``(start, end, document)`` of a block's words, and whether each one is
    followed by the next in the same piece."""
    inside = ~GAP[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(BREAK[data]), starts)
    follows = np.zeros(starts.size, bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
    return starts, ends, doc, follows


def _hash_words(values: pa.Array) -> np.ndarray:
    """Hashes of distinct binary values, for the bit tables only."""
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    if not len(values) or offsets[0] == offsets[-1]:
        return np.zeros(len(values), np.uint64)
    data = np.frombuffer(values.buffers()[2], np.uint8)
    return segment_hashes(data, offsets[:-1], offsets[1:])


def _phrase_hash(word_hashes: list[np.ndarray], lang_hash: np.ndarray) -> np.ndarray:
    total = lang_hash.copy()
    for h, factor in zip(word_hashes, window_factors(len(word_hashes))):
        total += h * factor
    return mix(total)


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes % np.uint64(bits)).astype(np.int64)


def _in(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slot = _slots(hashes, bits)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _distinct(first, limit, more, vocabulary):
    """Distinct sequences of numbers, exact: one place of each, and counts.
    ``first`` is below ``limit``, each of ``more`` below ``vocabulary``; what
    would pass 62 bits is numbered anew on the way."""
    key = first
    for column in more:
        if limit * vocabulary >= 1 << 62:
            kinds, key = np.unique(key, return_inverse=True)
            limit = kinds.size
        key, limit = key * vocabulary + column, limit * vocabulary
    _, place, count = np.unique(key, return_index=True, return_counts=True)
    return place, count


def _wanted(size, at, hash_at, tables, bits):
    """Which of the phrases of ``size`` words at ``at`` this pass counts."""
    if size == 1:
        return np.ones(at.size, bool)
    if size == 2:
        return _in(tables["word"], hash_at(at, 1), bits) & _in(tables["word"], hash_at(at + 1, 1), bits)
    grow = tables.get(f"grow{size - 1}")
    if grow is None:
        return np.zeros(at.size, bool)
    keep = _in(grow, hash_at(at, size - 1), bits) | _in(grow, hash_at(at + 1, size - 1), bits)
    for k in range(size - 1):
        keep &= _in(tables["pair"], hash_at(at + k, 2), bits)
    return keep


def block_counts(data, offsets, lang, lang_hash, sizes, tables, bits):
    """``(size, languages, phrases, counts)`` of a block, exact: words are
    numbered by their bytes, phrases by the numbers of their words."""
    starts, ends, doc, follows = _words(data, offsets)
    if not starts.size:
        return
    bounds = np.zeros(starts.size + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    letters = data[~GAP[data]]
    words = pa.Array.from_buffers(pa.large_binary(), starts.size,
                                  [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
    word, vocabulary = words.indices.to_numpy().astype(np.int64), words.dictionary
    of_word, lang_of, lang_key = _hash_words(vocabulary), lang[doc], lang_hash[doc]

    def hash_at(at, size):
        return _phrase_hash([of_word[word[at + j]] for j in range(size)], lang_key[at])

    at = np.arange(starts.size)
    for size in range(1, LONGEST + 1):
        if size > 1:                       # positions with `size` words in one piece
            at = at[at + size - 1 < starts.size]
            at = at[follows[at + size - 2]]
        if size not in sizes:
            continue
        here = at[_wanted(size, at, hash_at, tables, bits)]
        if not here.size:
            continue
        kinds = max(len(vocabulary), 1)
        place, count = _distinct(lang_of[here] * kinds + word[here], (int(lang.max()) + 1) * kinds,
                                 [word[here + j] for j in range(1, size)], kinds)
        firsts = here[place]
        parts = [vocabulary.take(pa.array(word[firsts + j])) for j in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(
            *parts, pa.scalar(b" ", pa.large_binary()))
        yield size, lang_of[firsts], phrase.cast(pa.binary()), count


def count_phrases(docs: DataFrame, sizes, tables: dict, config: CollocationConfig) -> DataFrame:
    """One pass over ``docs(lang, text)``: ``(lang, phrase, size, a)``, exact
    counts of all phrases of ``sizes`` words that the tables let through."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for batch in batches:
            texts = text_array(batch, "text")
            coded = pc.fill_null(batch.column(0), "und").dictionary_encode()
            langs = coded.dictionary
            lang = coded.indices.to_numpy().astype(np.int64)
            lang_hash = _hash_words(langs.cast(pa.large_binary()))[lang] if len(langs) else None
            for row, last, data, offsets in blocks(texts, config.block_bytes):
                for size, of, phrase, count in block_counts(LOWER[data], offsets, lang[row:last], lang_hash[row:last],
                                                            sizes, shared.value, config.bits):
                    for k in range(0, count.size, 1 << 16):
                        part = slice(k, k + (1 << 16))
                        yield pa.RecordBatch.from_arrays(
                            [langs.take(pa.array(of[part])).cast(pa.string()),
                             phrase.slice(k, 1 << 16).cast(pa.string()),
                             pa.array(np.full(count[part].size, size, np.int32)), pa.array(count[part].astype(np.int64))],
                            ["lang", "phrase", "size", "a"])

    found = docs.mapInArrow(tidy(run), "lang string, phrase string, size int, a long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))


def bit_table(phrases: DataFrame, config: CollocationConfig) -> np.ndarray:
    """Bit table of ``phrases(lang, phrase)``; at most ``bits / 63`` rows of
    it reach the driver, whatever their number."""
    bits = config.bits

    def run(batches):
        for batch in batches:
            split = [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            if not split:
                continue
            langs = _hash_words(batch.column(0).cast(pa.large_binary()))
            columns = [_hash_words(pa.array(column, pa.large_binary())) for column in zip(*split)]
            slot = _slots(_phrase_hash(columns, langs), bits)
            yield pa.RecordBatch.from_arrays([pa.array(slot // 63), pa.array(np.int64(1) << slot % 63)], ["at", "bit"])

    rows = (phrases.select("lang", "phrase").mapInArrow(tidy(run), "at long, bit long")
            .groupBy("at").agg(F.bit_or("bit").alias("bit")).toPandas())
    table = np.zeros(bits + 63, bool)
    for j in range(63):
        table[rows["at"].to_numpy() * 63 + j] = rows["bit"].to_numpy() >> j & 1
    return np.packbits(table[:bits], bitorder="little")


# -- scores, bounds, survivors ---------------------------------------------------

def _part(first, last):
    return F.array_join(F.slice(F.split("phrase", " "), first, last), " ")


def scored(found: DataFrame, known: DataFrame, config: CollocationConfig) -> DataFrame:
    """``found`` with the cut ``k`` of the lowest score, its ``l``, ``r`` and
    ``score``, and the ``bound`` of all extensions.  ``known(lang, phrase, a)``
    has the counts of all parts."""
    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = F.array(F.struct(_part(F.lit(1), F.col("k")).alias("part"), F.lit(True).alias("head")),
                    F.struct(_part(F.col("k") + 1, F.col("size")).alias("part"), F.lit(False).alias("head")))
    sides = settle(cut.select("*", F.explode(sides).alias("s")).select("lang", "phrase", "size", "a", "k", "s.*"))
    counts = known.select("lang", F.col("phrase").alias("part"), F.col("a").alias("of_part"))
    both = join_unique(sides, counts, ["lang", "part"]).groupBy("lang", "phrase", "size", "a", "k").agg(
        F.max(F.when(F.col("head"), F.col("of_part"))).alias("l"), F.max(F.when(~F.col("head"), F.col("of_part"))).alias("r"))
    of = lambda low: F.expr(f"(CAST({config.scale} AS DECIMAL(18, 0)) * CAST(a AS DECIMAL(20, 0))) "  # noqa: E731
                            f"div (CAST(l AS DECIMAL(20, 0)) + {low})")
    best = F.min(F.struct(of("r").alias("score"), "k", "l", "r")).alias("c")
    return both.groupBy("lang", "phrase", "size", "a").agg(best, F.min(of("a")).alias("bound")).select(
        "lang", "phrase", "size", "a", "bound", "c.*")


def survivors(cand: DataFrame, config: CollocationConfig) -> DataFrame:
    """Candidates that no longer candidate found so far holds with ``inside``
    percent of their count.  One word more is enough to look at: what holds a
    phrase with two more words holds one that does with one more."""
    tail, body = _part(F.lit(2), F.col("size")), _part(F.lit(1), F.col("size") - 1)
    longer = (cand.filter("size > 2").select("lang", "a", F.explode(F.array(tail, body)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    whole = F.expr(f"CAST(100 AS DECIMAL(18, 0)) * longer >= CAST({config.inside} AS DECIMAL(18, 0)) * a")
    return cand.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | ~whole).drop("longer")


def _frontier(cand, grown, config, batch):
    """Phrases to grow next: of those not grown whose bound reaches the
    language's ``top``-th settled surviving score, the ``batch`` of highest
    bound (all that share the last one's step of a thousandth)."""
    settled = survivors(cand, config).join(grown.withColumn("done", F.lit(True)), ["lang", "phrase"], "left")
    settled = settled.filter("size = 4 OR done")
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    goal = (settled.select("lang", "score", F.row_number().over(order).alias("n")).filter(F.col("n") <= config.top)
            .filter(F.col("n") == config.top).select("lang", F.col("score").alias("goal")))
    open_ = (cand.filter("size < 4").join(grown, ["lang", "phrase"], "left_anti").join(goal, "lang", "left")
             .filter(F.col("goal").isNull() | (F.col("bound") >= F.col("goal")))
             .withColumn("step", F.expr(f"bound div {max(config.scale // 2000, 1)}")))
    open_ = settle(open_.select("lang", "phrase", "size", "step"))
    steps = open_.groupBy("lang", "step").count()
    above = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    take = (steps.withColumn("above", F.coalesce(F.sum("count").over(above), F.lit(0)))
            .filter(F.col("above") < batch).select("lang", "step"))
    return open_.join(take, ["lang", "step"], "left_semi").select("lang", "phrase", "size")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 config: CollocationConfig = CollocationConfig()) -> DataFrame:
    """Each language's first ``top`` surviving phrases: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    texts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    words = settle(count_phrases(texts, {1}, {}, config))
    total = words.groupBy("lang").agg(F.sum("a").alias("n"))
    enough = F.col("a") >= config.least
    known = words.filter(enough).select("lang", "phrase", "a")
    tables = {"word": bit_table(known, config)}
    # Every word is grown first: a word's bound is the highest there is.
    pairs = settle(count_phrases(texts, {2}, tables, config).filter(enough))
    tables["pair"] = bit_table(pairs, config)
    cand = settle(scored(pairs, known, config))
    known = known.unionByName(pairs.select("lang", "phrase", "a"))
    grown = cand.select("lang", "phrase").filter("false")
    batch = config.batch
    while True:
        nxt = settle(_frontier(cand, grown, config, batch))
        by_size = {r.size: r["count"] for r in nxt.groupBy("size").count().collect()}
        if not by_size:
            break
        # The score of a phrase of four needs the counts of its inner three:
        # both word pairs of a grown phrase of three are grown with it.
        three = nxt.filter("size = 3")
        inner = three.select("lang", F.explode(F.array(_part(F.lit(1), F.lit(2)), _part(F.lit(2), F.lit(2)))).alias("phrase"))
        grow2 = settle(nxt.filter("size = 2").select("lang", "phrase").unionByName(inner).distinct()
                       .join(grown, ["lang", "phrase"], "left_anti"))
        now = {**{k: tables[k] for k in ("word", "pair")}, "grow2": bit_table(grow2, config)}
        sizes = {3}
        if 3 in by_size:
            now["grow3"] = bit_table(three, config)
            sizes.add(4)
        counted = settle(count_phrases(texts, sizes, now, config).filter(enough))
        # A false hit of the tables may have let in a phrase that nothing
        # grown begins or ends; its count is right, its parts may be unknown.
        ends = counted.select("*", F.explode(F.array(_part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size")))).alias("end"))
        grew = grow2.unionByName(three.select("lang", "phrase")).withColumnRenamed("phrase", "end")
        real = ends.join(grew, ["lang", "end"], "left_semi").select("lang", "phrase", "size", "a").distinct()
        new = settle(real.join(cand, ["lang", "phrase"], "left_anti"))
        known = known.unionByName(new.filter("size = 3").select("lang", "phrase", "a"))
        cand = settle(cand.unionByName(scored(new, known, config)))
        grown = settle(grown.unionByName(grow2).unionByName(three.select("lang", "phrase")))
        batch *= 4
    settled = survivors(cand, config).join(grown.withColumn("done", F.lit(True)), ["lang", "phrase"], "left")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (settled.filter("size = 4 OR done").withColumn("rank", F.row_number().over(order).cast("long"))
              .filter(F.col("rank") <= config.top))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    """The first 2000 collocations of every language of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = """
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, size, list_slice(w, i, i + size - 1) AS ws FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM p, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, ws, count(*) AS a FROM g GROUP BY lang, size, ws),
total AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE size > 1 AND a >= 30),
cuts AS (
  SELECT c.lang, c.ws, c.size, c.a, k, l.a AS l, r.a AS r,
    (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.ws = list_slice(c.ws, 1, k)
  JOIN f r ON r.lang = c.lang AND r.ws = list_slice(c.ws, k + 1, c.size)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
held AS (
  SELECT DISTINCT lang, ws, a FROM (
    SELECT b.lang, list_slice(b.ws, i, i + size - 1) AS ws, b.a FROM (
      SELECT *, unnest(range(1, longer - size + 2)) AS i FROM (
        SELECT lang, ws, a, size AS longer, unnest(range(2, size)) AS size FROM cand)) b)),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM held h WHERE h.lang = b.lang AND h.ws = b.ws AND 100::HUGEINT * h.a >= 80::HUGEINT * b.a)),
named AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
  a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM named JOIN total USING (lang)
QUALIFY rank <= 2000"""
