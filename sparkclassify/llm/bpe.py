"""Byte-level BPE encoding and decoding in linear time.

A piece of text (one match of the split pattern) is not merged pair by pair.
Its bytes, read as Latin-1 characters, run through an Aho-Corasick automaton
of all tokens, which gives the longest token at every position.  Encoding
walks from the left, takes the longest token that is compatible with the one
before it, and backtracks to shorter ones, never trying a refuted position
twice.  Two adjacent tokens are compatible when merging their joined bytes by
rank gives them back; a sequence whose neighbours are all compatible is the
one the merges would make.  Compatibility is memoised per worker, and so are
whole short pieces; both memos have a fixed size and only save time.

Map-only over Arrow batches, no exchange: the vocabulary (its file's size) is
broadcast.  Defined results: null is the empty text, which has 0 tokens and
the digests of nothing; ids that no token has raise on decoding; repeated
rows and other columns play no part.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from contextlib import contextmanager

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from .common import tidy, with_field

RANKS_FILE = "byte_bpe_50k.tiktoken"
_NEVER = 1 << 62


def read_ranks(path: str) -> list[bytes]:
    """The tokens by rank of a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _merge(piece: bytes, rank_of: dict, below: int) -> list[bytes]:
    """Plain merging of one short byte string with ranks under ``below``."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        ranks = [rank_of.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        best = min(ranks)
        if best >= below:
            break
        i = ranks.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def token_halves(tokens: list[bytes]) -> list[tuple[int, int] | None]:
    """The two tokens whose merge makes each token; None for single bytes
    and for tokens that merging cannot reach."""
    rank_of = {t: r for r, t in enumerate(tokens) if t}
    halves: list = []
    for rank, token in enumerate(tokens):
        parts = _merge(token, rank_of, rank) if len(token) > 1 else ()
        halves.append((rank_of[parts[0]], rank_of[parts[1]]) if len(parts) == 2 else None)
    return halves


class BytePairEncoder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], halves, pattern: str,
                 memo_pieces: int = 1 << 17, memo_pairs: int = 1 << 17, memo_length: int = 48):
        self.tokens, self.halves = tokens, halves
        self.rank_of = {t: r for r, t in enumerate(tokens) if t}
        self.find = regex.compile(pattern).findall
        self.memo_length, self.memo_pieces, self.memo_pairs = memo_length, memo_pieces, memo_pairs
        self._pieces: dict[str, bytes] = {}
        self._pairs: dict[int, bool] = {}
        self._shorter: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            if len(token) == 1 or halves[rank] is not None:
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()

    def _made(self, token: int) -> int:
        """When merging makes the token; single bytes are there at first."""
        return -1 if self.halves[token] is None else token

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            known = self._check(left, right)
            if len(self._pairs) < self.memo_pairs:
                self._pairs[key] = known
        return known

    def _check(self, left: int, right: int) -> bool:
        """Undo the merges on both sides of the boundary, latest first; the
        pair fails if some join across it would have come before them.  Of
        equal ranks the left merge comes first."""
        left_gone = right_gone = _NEVER
        while True:
            across = self.rank_of.get(self.tokens[left] + self.tokens[right], _NEVER)
            if across < left_gone and across <= right_gone:
                return False
            made_left, made_right = self._made(left), self._made(right)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left_gone, left = left, self.halves[left][1]
            else:
                right_gone, right = right, self.halves[right][0]

    def _next_shorter(self, token: int) -> int:
        """The longest other token that starts this one; -1 if none."""
        found = self._shorter.get(token)
        if found is None:
            text, found = self.tokens[token], -1
            for size in range(len(text) - 1, 0, -1):
                rank = self.rank_of.get(text[:size])
                if rank is not None and (size == 1 or self.halves[rank] is not None):
                    found = rank
                    break
            self._shorter[token] = found
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank_of.get(piece)
        if whole is not None:
            return [whole]
        size, tokens = len(piece), self.tokens
        longest = [-1] * size
        for last, rank in self.automaton.iter(piece.decode("latin-1")):
            # matches of one start come in growing length
            longest[last + 1 - len(tokens[rank])] = rank
        open_end = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(tokens[token])
            if open_end[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                if end == size:
                    return out
                at, token = end, longest[end]
                continue
            token = self._next_shorter(token)
            if token < 0:
                open_end[at] = 0
                token = out.pop()
                at -= len(tokens[token])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pieces, known = self.find(text), self._pieces
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            return b"".join([known.get(p) or self._encode_new(p) for p in pieces])

    def _encode_new(self, piece: str) -> bytes:
        ids = np.array(self.encode_piece(piece.encode("utf-8")), "<u4").tobytes()
        if len(self._pieces) < self.memo_pieces and len(piece) <= self.memo_length:
            self._pieces[piece] = ids
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@contextmanager
def worker_encoder(shared):
    """The encoder of a task.  It and its memos go with the task: a Python
    worker lives on for other stages, which need the memory."""
    encoder = BytePairEncoder(shared.value["tokens"], shared.value["halves"], shared.value["pattern"])
    try:
        yield encoder
    finally:
        encoder.__dict__.clear()
        gc.collect()


def share_vocabulary(spark, path: str | None = None, pattern: str = public_tokenizers.PATTERN):
    """The vocabulary as a broadcast variable."""
    tokens = read_ranks(path or public_tokenizers.path(RANKS_FILE))
    return spark.sparkContext.broadcast(
        {"tokens": tokens, "halves": token_halves(tokens), "pattern": pattern})


def texts_of(column: pa.Array, step: int = 256):
    """The values as strings, null as empty, a few at a time."""
    for at in range(0, len(column), step):
        yield [t or "" for t in column.slice(at, step).to_pylist()]


def encode_column(rows: DataFrame, text_col: str, vocabulary, out_col: str = "ids") -> DataFrame:
    """All columns and ``out_col``: the text's token ids as array<long>; it
    replaces an input column of that name."""
    rows = rows.drop(out_col)
    place = rows.columns.index(text_col)

    def run(batches):
        with worker_encoder(vocabulary) as encoder:
            for batch in batches:
                ids = [np.frombuffer(encoder.encode(t), "<u4").astype(np.int64)
                       for part in texts_of(batch.column(place)) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ids, pa.list_(pa.int64()))], [*batch.schema.names, out_col])

    return rows.mapInArrow(tidy(run), with_field(rows.schema, out_col, ArrayType(LongType())))


def decode_column(rows: DataFrame, ids_col: str, vocabulary, out_col: str = "decoded") -> DataFrame:
    """All columns and ``out_col``: the bytes of the token ids (null: none)."""
    rows = rows.drop(out_col)
    place = rows.columns.index(ids_col)

    def run(batches):
        with worker_encoder(vocabulary) as encoder:
            for batch in batches:
                texts = [b"".join(encoder.tokens[i] for i in ids or ())
                         for ids in batch.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, out_col])

    return rows.mapInArrow(tidy(run), with_field(rows.schema, out_col, BinaryType()))


def token_digests(rows: DataFrame, id_col: str, text_col: str, vocabulary, with_ids: bool = False) -> DataFrame:
    """Encode, then decode the ids: per row the number of tokens, digests of
    the ids and of the decoded bytes, and the ids themselves on demand."""
    narrow = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        with worker_encoder(vocabulary) as encoder:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    encoded = [encoder.encode(t) for part in texts_of(batch.column(1)) for t in part]
                    columns = [
                        batch.column(0), pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                        pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded], pa.string()),
                        pa.array([hashlib.sha256(encoder.decode(ids)).hexdigest() for ids in encoded], pa.string())]
                    if with_ids:
                        columns.append(pa.array([np.frombuffer(ids, "<i4") for ids in encoded], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(tidy(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                            + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("id", id_col)


def op8_bpe(spark, sf_dir):
    """Token count and digests of every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(docs, "doc_id", "text", share_vocabulary(spark))
