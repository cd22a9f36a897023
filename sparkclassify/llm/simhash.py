"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint holds, bit by bit, what most of its 3-word shingles' XXH64
hashes say.  Two fingerprints at most two bits apart (``RADIUS``) have a common
value at most half the radius from each, so every *distinct* fingerprint emits
its ball of 65 variants (itself and each single flip), the variants are
exchanged, and fingerprints that meet on one are candidates.

What meets on a variant is known by which bit was flipped, so a variant's
group is two numbers (the union of the flips and whether the variant itself
is a fingerprint): a fixed-size aggregate, however many documents share a
fingerprint.  Members of one group are within two bits of each other; its
smallest member is paired with each other one (at most 64 pairs), pairs are
deduplicated and verified, and their components taken.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer than three words are one shingle; a
very long text is hashed in pieces (its words' bounds and one piece are held);
repeated rows and copies have one fingerprint, joined to its component without
a hot key (``join_unique``); a null id is no component's smallest while another
id is there; an empty table gives an empty one; other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_unique, settle, tidy
from .components import connected_components
from .textblocks import BLOCK_BYTES, LOWER, blocks, text_array, word_bounds

WORDS = 3                    # words of a shingle
SEED = 42                    # of XXH64
RADIUS = 2                   # bits; balls of half of it
PIECE = 1 << 15              # shingles hashed at once
MASKS = [0, *(1 << i for i in range(63)), -(1 << 63)]      # a ball of radius 1


def _joined(data, starts, ends):
    """The words' bytes with a space after each, and where each begins."""
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    take = np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes)
    after = at + sizes - 1
    take[after] = 0
    out = data[take]
    out[after] = 0x20
    return out.tobytes(), at


def block_fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of a block's documents as signed 64-bit numbers."""
    docs = offsets.size - 1
    starts, ends, doc = word_bounds(data, offsets)
    votes, total = np.zeros((docs, 64), np.int64), np.zeros(docs, np.int64)
    if starts.size:
        n_words = np.bincount(doc, minlength=docs)
        past = np.cumsum(n_words)                      # one past a document's last word
        first = np.arange(starts.size)
        last = np.minimum(first + WORDS - 1, past[doc] - 1)
        whole = (last == first + WORDS - 1) | (first == (past - n_words)[doc])
        first, last = first[whole], last[whole]
        total = np.bincount(doc[first], minlength=docs)
        digest = xxhash.xxh64_intdigest
        for k in range(0, first.size, PIECE):
            a, b = first[k:k + PIECE], last[k:k + PIECE]
            lo, hi = int(a[0]), int(b[-1]) + 1
            text, at = _joined(data, starts[lo:hi], ends[lo:hi])
            stop = at[b - lo] + (ends - starts)[b]
            hashes = np.array([digest(text[i:j], SEED) for i, j in zip(at[a - lo].tolist(), stop.tolist())],
                              dtype="<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            of = doc[a]
            cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            votes[of[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(set_bits).view("<i8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, fp)`` of every row; map-only."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = text_array(batch, "text")
            for row, last, data, offsets in blocks(texts, block_bytes):
                found = block_fingerprints(LOWER[data], offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, last - row), pa.array(found, pa.int64())],
                                                 ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, fp long")


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` of distinct fingerprints ``prints(fp)`` that meet on a
    variant: per variant its smallest member with each other one, each pair
    once, verified to be within ``RADIUS`` bits.  (All members of one variant
    are, so the pairs left out join nothing that these do not.)"""
    ball = F.explode(F.array(*[F.lit(m).cast("long") for m in MASKS])).alias("mask")
    met = (prints.select("fp", ball).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("v"), "mask")
           .groupBy("v").agg(F.bit_or("mask").alias("flips"), F.max(F.col("mask") == 0).alias("own"))
           .filter(F.bit_count("flips") + F.col("own").cast("int") >= 2))
    masks = F.array(*[F.lit(m).cast("long") for m in MASKS])
    there = F.filter(masks, lambda m: F.when(m == 0, F.col("own")).otherwise(F.col("flips").bitwiseAND(m) != 0))
    members = F.array_sort(F.transform(there, lambda m: F.col("v").bitwiseXOR(m)))
    pairs = met.select(members.alias("m")).select(
        F.col("m")[0].alias("a"), F.explode(F.slice("m", 2, len(MASKS))).alias("b"))
    return pairs.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id that links reach, of every row."""
    rows = settle(fingerprints(docs, id_col, text_col))
    prints = settle(rows.groupBy("fp").agg(F.min("id").alias("first")))
    label = connected_components(links(prints)).select(F.col("node").alias("fp"), F.col("component").alias("label"))
    named = settle(prints.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = join_unique(named, least, ["label"]).select("fp", "component_id")
    return join_unique(rows, of_print, ["fp"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash(spark, sf_dir):
    """Fingerprint and component of every row of ``documents``."""
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
