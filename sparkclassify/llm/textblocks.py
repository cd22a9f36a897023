"""Whole texts as numpy blocks inside Arrow tasks.

An Arrow batch is cut into blocks of whole documents of about ``limit``
bytes, so a task holds one block's work arrays at a time.  A longer document
is a block of its own; its words are still hashed in pieces of ``PIECE_BYTES``,
so what grows with it is its bytes and one number per word.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``.  UTF-8
keeps those byte values for the characters themselves, so byte words are
character words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20
PIECE_BYTES = 1 << 17         # hashed at once, with some 40 bytes of work arrays for each
LONG_SEGMENT = 256

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64
_PRIME = _U(0x9E3779B97F4A7C15)          # odd, hence invertible modulo 2^64
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240817).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int):
    if _powers[0].size < n:
        size = -(-n // (1 << 16)) * (1 << 16)
        for k, base in ((0, _PRIME), (1, _INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rolling: bool = False) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` from one prefix sum.  Sums modulo
    2^64 can be made to agree for long texts of a certain build (Thue-Morse),
    so segments beyond ``LONG_SEGMENT`` bytes are hashed one by one, unless
    they are ``rolling`` (one at about every byte)."""
    up, down = _power_tables(data.size + 1)
    sums = np.zeros(data.size + 1, _U)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    lengths = (ends - starts).astype(_U)
    out = mix((sums[ends] - sums[starts]) * down[starts] + lengths * _U(0xD6E8FEB86659FD93))
    for i in [] if rolling else np.flatnonzero(lengths > LONG_SEGMENT):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def text_array(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column, null as empty; not copied unless it has nulls."""
    texts = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(texts, "") if texts.null_count else texts


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """``(first_row, last_row, bytes, offsets)`` of consecutive documents;
    ``offsets`` has one entry more than the block has documents."""
    _, offset_buffer, data_buffer = texts.buffers()
    n = len(texts)
    kind = np.dtype(np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = (np.frombuffer(offset_buffer, kind, n + 1, texts.offset * kind.itemsize).astype(np.int64)
               if n else np.zeros(1, np.int64))
    raw = (np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size
           else np.zeros(0, np.uint8))
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), n)
        lo, hi = offsets[row], offsets[last]
        yield row, last, raw[lo:hi], offsets[row:last + 1] - lo
        row = last


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """``(start, end, document)`` of every word of a block."""
    if not data.size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~SPACE[data]
    cut = np.zeros(data.size + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                limit: int = PIECE_BYTES) -> np.ndarray:
    """Hashes of the words, over pieces of about ``limit`` bytes that end
    at word ends."""
    if not starts.size:
        return np.zeros(0, _U)
    out, at = [], 0
    while at < starts.size:
        to = int(np.searchsorted(ends, starts[at] + limit, "right"))
        to = max(to, at + 1)
        base = starts[at]
        out.append(segment_hashes(data[base:ends[to - 1]], starts[at:to] - base, ends[at:to] - base))
        at = to
    return np.concatenate(out)


def window_factors(n: int) -> np.ndarray:
    """Fixed odd multipliers of the entries of an ``n``-entry window."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _PRIME + _U(n)) | _U(1)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive entries (also across
    documents; the caller drops those)."""
    count = words.size - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    total = np.zeros(count, _U)
    for j, factor in enumerate(window_factors(n)):
        total += words[j:j + count] * factor
    return mix(total)
