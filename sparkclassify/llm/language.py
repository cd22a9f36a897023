"""Language identification with string kernels.

Kernel: a text is the set of its character 1- to 3-grams (blended spectrum,
presence), ``k(x, y) = |x & y| / sqrt(|x| |y|)``.  Texts are lower-cased, runs
of non-letters become one boundary symbol, and letters outside the landmarks'
``alphabet`` most frequent ones are one symbol.  Nystroem landmarks turn the
kernel into bounded features, one-versus-rest kernel ridge regression is
solved on them, and every text is scored by two matrix products per batch:
presence x landmarks, then kernel row x class weights.

The model is fitted on a bounded sample (``landmarks`` and ``training_rows``
per language, distinct rows of any length), drawn by a hash of id and text.
Of a language's sample the texts of up to ``landmark_chars`` characters are
its first landmarks; longer ones serve where there are too few.  Tasks read the
texts; what reaches the driver are the landmarks' letter counts and n-gram
sets (at most 2^21 numbers each, however long the text) and the kernel rows.
Scoring covers every whole text in one map-only pass: no exchange, so a hot
source or group of copies changes nothing, and a lost task is run again.

Defined results: a null text, one without a letter, or a table without a
labelled training row gives ``und`` with score 0.  A null ``doc_id`` counts
as the empty text in the fold rule.  Ties go to the language first in
alphabetical order.  Repeated rows are learned once, whatever share of the
table they are; very long texts are learned and scored whole, in pieces.
Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

UNKNOWN = "und"
_BITS = 7
_TABLE = 1 << (3 * _BITS)
_PIECE = 1 << 20


@dataclass(frozen=True)
class LanguageConfig:
    landmarks: int = 32
    training_rows: int = 400
    landmark_chars: int = 50_000       # preferred, no limit
    ridge: float = 1e-3
    alphabet: int = (1 << _BITS) - 3   # symbol 2^bits - 1 marks shorter n-grams
    batch: int = 256


def _letter_counts(text: str) -> np.ndarray:
    """(code point, occurrences) of the lower-cased text, as two rows."""
    counts = np.zeros(0x110000, np.int64)
    for i in range(0, len(text), _PIECE):
        found = np.bincount(_code_points(text[i:i + _PIECE].lower()))
        counts[:found.size] += found
    points = np.flatnonzero(counts)
    return np.stack([points, counts[points]])


def _letter_table(counted, size: int) -> np.ndarray:
    """Symbol of each code point: 0 no letter, 1 other letter, 2.. the
    ``size`` most frequent letters of the ``counted`` texts."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    counts = np.zeros(0x110000, np.int64)
    for points, times in counted:
        counts[points] += times
    counts[table == 0] = 0
    order = np.lexsort((np.arange(0x110000), -counts))[:size]
    order = order[counts[order] > 0]
    table[order] = 2 + np.arange(order.size, dtype=np.uint8)
    return table


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Boundary-padded symbols with runs of boundaries merged."""
    parts = [table[_code_points(text[i:i + _PIECE].lower())] for i in range(0, len(text), _PIECE)]
    s = np.concatenate([np.zeros(1, np.uint8), *parts, np.zeros(1, np.uint8)])
    keep = np.ones(s.size, bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    return s[keep]


def _marks(symbols: np.ndarray):
    """Cells of the presence table, in pieces: 3-grams as they are; 2- and
    1-grams as 3-grams whose missing places hold the boundary in a form no
    real 3-gram has (two boundaries never meet)."""
    for i in range(0, symbols.size, _PIECE):
        s = symbols[i:i + _PIECE + 2].astype(np.int64)
        yield s                                   # (0, 0, a)
        yield (s[:-1] << (2 * _BITS)) | (s[1:] << _BITS) | ((1 << _BITS) - 1)
        if s.size > 2:
            yield (s[:-2] << (2 * _BITS)) | (s[1:-1] << _BITS) | s[2:]


class _Presence:
    """A reused presence table."""

    def __init__(self):
        self.flags = np.zeros(_TABLE, bool)

    def row(self, symbols, cells):
        """(presence of ``cells``, number of distinct n-grams)."""
        used = list(_marks(symbols))
        for u in used:
            self.flags[u] = True
        here, total = self.flags[cells], int(np.count_nonzero(self.flags))
        for u in used:
            self.flags[u] = False
        return here, total


def _kernel_rows(texts, model) -> tuple[np.ndarray, np.ndarray]:
    """(kernel values against the landmarks, has a letter) of ``texts``."""
    presence, cells = _Presence(), model["cells"]
    batch = model["batch"]
    kernel = np.zeros((len(texts), model["landmarks"].shape[1]), np.float32)
    lettered = np.zeros(len(texts), bool)
    for at in range(0, len(texts), batch):
        part = texts[at:at + batch]
        x = np.zeros((len(part), cells.size), np.float32)
        size = np.ones(len(part), np.float32)
        for i, text in enumerate(part):
            symbols = _symbols(text, model["table"]) if text else np.zeros(0, np.uint8)
            if symbols.any():
                lettered[at + i] = True
                x[i], size[i] = presence.row(symbols, cells)
        kernel[at:at + batch] = (x @ model["landmarks"]) / np.sqrt(size)[:, None]
    return kernel, lettered


def _grams(text: str, table: np.ndarray) -> np.ndarray:
    """The sorted distinct n-grams of a text."""
    flags = np.zeros(_TABLE, bool)
    for cells in _marks(_symbols(text, table)):
        flags[cells] = True
    return np.flatnonzero(flags)


def _landmark_model(found: list, table: np.ndarray, config: LanguageConfig) -> dict:
    """The landmarks' unit vectors over the n-grams that any of them has."""
    seen = np.zeros(_TABLE, bool)
    for grams in found:
        seen[grams] = True
    cells = np.flatnonzero(seen)
    rows = np.zeros((cells.size, len(found)), np.float32)
    for i, grams in enumerate(found):
        rows[np.searchsorted(cells, grams), i] = 1 / np.sqrt(grams.size)
    return {"table": table, "cells": cells, "landmarks": rows, "batch": config.batch}


def _solve(kernel_mm: np.ndarray, kernel_xm: np.ndarray, target: np.ndarray, ridge: float):
    """Class weights on the kernel row, and intercepts."""
    values, vectors = np.linalg.eigh(kernel_mm.astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    z = kernel_xm.astype(np.float64) @ whiten
    mean_z, mean_y = z.mean(0), target.mean(0)
    z, y = z - mean_z, target - mean_y
    w = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ y)
    return (whiten @ w).astype(np.float32), (mean_y - mean_z @ w).astype(np.float32)


def _hash_sample(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """Up to ``most`` rows of each ``key`` value, those with the smallest
    hash ``order``, one row per hash.  A threshold from the number of distinct
    hashes keeps what meets in a window near ``most`` rows however frequent a
    value is (three times what is needed, so an estimated number is enough);
    rows that share a hash combine in each task."""
    counts = rows.groupBy(key).agg(F.approx_count_distinct(order, 0.03).alias("__n"))
    unit = F.pmod(F.col(order), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = rows.join(F.broadcast(counts), key).filter(unit * F.col("__n") < 3.0 * most + 30)
    near = near.drop("__n").dropDuplicates([key, order])
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return near.withColumn("__r", rank).filter(F.col("__r") <= most).drop("__r")


def _of_texts(rows: DataFrame, function, kind: str) -> list:
    """``(lang, h, function(text) as long arrays)`` of a bounded sample, in
    the order of language and hash."""
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                lang, h, text = (c[at].as_py() for c in batch.columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([h], pa.int64()), pa.array([function(text)], pa.list_(pa.int64()))],
                    ["lang", "h", kind])

    got = rows.select("lang", "h", "text").mapInArrow(run, f"lang string, h long, {kind} array<long>").collect()
    return sorted(got, key=lambda r: (r["lang"], r["h"]))


def fit_language_model(rows: DataFrame, id_col: str, text_col: str, lang_col: str,
                       config: LanguageConfig = LanguageConfig()) -> dict | None:
    """The model as arrays; None without a usable labelled row."""
    usable = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit("language sample"), F.col(id_col), F.col(text_col)).alias("h")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = settle(_hash_sample(usable, "lang", "h", config.training_rows))
    short_first = Window.partitionBy("lang").orderBy(F.length("text") > config.landmark_chars, "h")
    marks = (sample.withColumn("__r", F.row_number().over(short_first))
             .filter(F.col("__r") <= config.landmarks).drop("__r"))
    counted = _of_texts(marks, lambda text: _letter_counts(text).ravel(), "letters")
    if not counted:
        return None
    table = _letter_table((np.array(r["letters"]).reshape(2, -1) for r in counted), config.alphabet)
    context = rows.sparkSession.sparkContext
    letters = context.broadcast(table)
    found = [np.array(r["grams"]) for r in _of_texts(marks, lambda text: _grams(text, letters.value), "grams")]
    model = _landmark_model(found, table, config)
    shared = context.broadcast(model)

    def kernel(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, config.batch):
                batch = whole.slice(at, config.batch)
                values, _ = _kernel_rows(batch.column(1).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(list(values.astype(np.float64)), pa.list_(pa.float64()))],
                    ["lang", "k"])

    got = sample.select("lang", "text").mapInArrow(kernel, "lang string, k array<double>").collect()
    got.sort(key=lambda r: (r["lang"], r["k"]))
    kernel_xm = np.array([r["k"] for r in got])
    langs = sorted({r["lang"] for r in got})
    target = (np.array([r["lang"] for r in got])[:, None] == np.array(langs)[None, :]).astype(float)
    kernel_mm = model["landmarks"].T @ model["landmarks"]
    weights, intercept = _solve(kernel_mm, kernel_xm, target, config.ridge)
    letters.unpersist()
    shared.unpersist()
    return {**model, "langs": langs, "weights": weights, "intercept": intercept}


def predict_language(rows: DataFrame, model: dict | None, text_col: str, keep) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row."""
    narrow = rows.select(*keep, F.col(text_col).alias("__text"))
    if model is None:
        return narrow.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = np.array([*model["langs"], UNKNOWN], object)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                kernel, lettered = _kernel_rows(batch.column(len(keep)).to_pylist(), shared.value)
                fit = kernel @ shared.value["weights"] + shared.value["intercept"]
                best = np.where(lettered, fit.argmax(1), len(names) - 1)
                score = np.where(lettered, np.clip(fit.max(1), 0, 1), 0).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(names[best], pa.string()), pa.array(score)],
                    [*keep, "lang_pred", "score"])

    kept = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep)
    return narrow.mapInArrow(run, f"{kept}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """The fold rule: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1_language(spark, sf_dir, config: LanguageConfig = LanguageConfig()):
    """Predicted language of every row of ``documents``; learned from the
    rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit_language_model(docs.filter(~F.col("held_out")), "doc_id", "text", "lang", config)
    return predict_language(docs, model, "text", ("doc_id", "held_out"))
