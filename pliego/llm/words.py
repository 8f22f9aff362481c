"""Words of Arrow text columns as numpy arrays, without a Python object per word.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``. In UTF-8 these
six bytes never occur inside another code point, so byte runs and code-point runs agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for every byte, so that the polynomial below hashes well.
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
BASE = int(_rng.integers(1 << 60, 1 << 63)) | 1
INVERSE = pow(BASE, -1, 1 << 64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {b: np.ones(1, U64) for b in (BASE, INVERSE)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the worker's next batch."""
    have = _powers[base]
    while len(have) < n:
        step = U64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, null as empty, and where each row starts and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


@dataclass
class Words:
    """start, end: byte positions of each word; first: index of each row's first word, and the total."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split_words(body: np.ndarray, at: np.ndarray) -> Words:
    inside = ~IS_SPACE[body]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(body)]
    begins[edges] = inside[edges]  # a row's first byte starts a word even after a letter of the last row
    start = np.flatnonzero(begins)
    stops = ~inside
    stops[edges] = True
    # The end is the next space or the next row's start after the word's first byte.
    ends = inside.copy()
    ends[:-1] &= stops[1:]
    end = np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, at))


def word_hashes(body: np.ndarray, words: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes: equal words agree wherever they stand."""
    if not len(words.start):
        return np.zeros(0, U64)
    code = BYTE_CODE[LOWER[body]] if lower else BYTE_CODE[body]
    total = np.empty(len(body) + 1, U64)
    total[0] = 0
    np.cumsum(code * powers(BASE, len(body)), out=total[1:])
    value = (total[words.end] - total[words.start]) * powers(INVERSE, len(body) + 1)[words.start]
    return mix(value + (words.end - words.start).astype(U64) * U64(0x9E3779B97F4A7C15))


def text_hashes(body: np.ndarray, at: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each row's whole bytes."""
    return word_hashes(body, Words(at[:-1], at[1:], np.arange(len(at))), lower) if len(body) else np.full(len(at) - 1, mix(np.zeros(1, U64))[0], U64)


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows inside rows, and the index of each row's first window."""
    count = np.diff(first)
    if len(hashes) < n:
        return np.zeros(0, U64), np.zeros(len(first), np.int64)
    value = np.zeros(len(hashes) - n + 1, U64)
    for j in range(n):
        value = value * U64(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - n + 1 + j]
    whole = np.maximum(count - n + 1, 0)
    keep = np.ones(len(value) + n, bool)
    for j in range(1, n):  # the last n-1 words of each row start no window
        keep[(first[1:] - j)[count >= j]] = False
    return mix(value[keep[: len(value)]]), np.concatenate([[0], np.cumsum(whole)])
