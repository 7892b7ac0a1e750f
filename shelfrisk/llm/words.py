"""Vectorised word scanning and hashing over Arrow text columns.

A word is a maximal run of ``[0-9A-Za-z]`` and non-ASCII characters, compared
with A-Z lower-cased.  All functions work on the UTF-8 bytes of many texts at
once; nothing here depends on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
CHUNK_BYTES = 1 << 20        # text bytes handled at once (a longer text is a chunk of its own)
SEGMENT = 1 << 16            # text bytes hashed at once
CHUNK_ROWS = 4000            # fits the 12 bits that `distinct_shingles` gives to the row number

_code = np.arange(256)
WORD_BYTE = (_code >= 0x80) | ((_code >= 48) & (_code <= 57)) | ((_code >= 97) & (_code <= 122)) \
    | ((_code >= 65) & (_code <= 90))
LOWER_BYTE = np.where((_code >= 65) & (_code <= 90), _code + 32, _code).astype(np.uint8)
SPACE_BYTE = (_code == 32) | ((_code >= 9) & (_code <= 13))
del _code


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift, multiply), a bijection."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODE = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=U)
    out[0] = 1
    return np.cumprod(out)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(off, width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def join_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pa.array(texts, pa.large_string()))


def row_chunks(batch: pa.RecordBatch, text_col: str, max_bytes: int = CHUNK_BYTES,
               max_rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``max_bytes`` of text each (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    start, held = 0, 0
    for i, s in enumerate(size):
        if i > start and (held + s > max_bytes or i - start >= max_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += s
    if start < len(size):
        yield batch.slice(start)


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True that stays inside one row."""
    if member.size == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = offsets[:-1][np.diff(offsets) > 0]
    begins = member.copy()
    begins[1:] &= ~member[:-1]
    begins[edge] = member[edge]
    ends = member.copy()
    ends[:-1] &= ~member[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = member[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


@lru_cache(8)
def power_table(base: int, size: int) -> np.ndarray:
    return powers(base, size)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hash of ``data[start:end]`` for each span, in
    segments: spans are ordered and do not overlap, so memory follows their
    number and the longest one, not the text."""
    out, i = np.empty(starts.size, U), 0
    while i < starts.size:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        first, n = int(starts[i]), int(ends[j - 1] - starts[i])
        power, inverse = (power_table(b, SEGMENT) if n <= SEGMENT else powers(b, n) for b in (BASE, BASE_INVERSE))
        total = np.zeros(n + 1, dtype=U)
        np.cumsum(BYTE_CODE[data[first:first + n]] * power[:n], out=total[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((total[e] - total[s]) * inverse[s])
        i = j
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row where its words begin
    (``len(rows) + 1`` entries)."""
    low = LOWER_BYTE[data]
    starts, ends = runs(WORD_BYTE[low], offsets)
    return hash_spans(low, starts, ends), np.searchsorted(starts, offsets)


def run_counts(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of runs in each row."""
    starts, _ = runs(member, offsets)
    return np.diff(np.searchsorted(starts, offsets))


def shingles(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words and its row.  A row with fewer words,
    but not none, has one shingle of all its words."""
    n = words.size
    count = np.diff(first)
    row = np.repeat(np.arange(count.size), count)
    left = np.repeat(first[1:], count) - np.arange(n)   # words from here to the row's end
    total = np.zeros(n, dtype=U)
    weight = powers(BASE, k)
    for j in range(min(k, n)):
        part = words[j:] * weight[j + 1]
        total[:n - j] += np.where(left[:n - j] > j, part, U(0))
    keep = (left >= k) | ((left == np.repeat(count, count)) & (np.repeat(count, count) < k))
    return mix(total[keep]), row[keep]


def distinct_shingles(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 52-bit hash, count) of the distinct shingles of each row, ordered."""
    if hashes.size == 0:
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)
    key = np.sort((row.astype(U) << U(52)) | (hashes >> U(12)))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(at, key.size))
    return (key[at] >> U(52)).astype(np.int64), key[at] & U((1 << 52) - 1), count


def packed(values: np.ndarray, ends: np.ndarray, kind=pa.binary()) -> pa.Array:
    """Binary array whose row i holds the bytes of ``values[ends[i-1]:ends[i]]``."""
    width = values.dtype.itemsize
    off = np.concatenate(([0], np.asarray(ends))) * width
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                 [None, pa.py_buffer(off.astype(np.int64).tobytes()),
                                  pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(kind)
