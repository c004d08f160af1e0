"""Numpy pieces that work on a batch of texts at once, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BATCH_BYTES = 1 << 20


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after another, and where each text starts; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def in_pieces(offsets: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts [first, end) with about ``most`` bytes; a longer text is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_starts(is_word: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes start a word; words do not run from one text into the next."""
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(is_word)]
    starts[edges] = is_word[edges]
    return starts


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked until the result is below ``n``."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = U64((1 << half) - 1)
    x = index.astype(U64)
    todo = np.arange(len(x))
    with np.errstate(over="ignore"):
        keys = mix(np.array([key & 0xFFFFFFFFFFFFFFFF], U64) + np.arange(1, 5, dtype=U64) * U64(0x9E3779B97F4A7C15))
        while len(todo):
            left, right = x[todo] >> U64(half), x[todo] & mask
            for k in keys:
                left, right = right, left ^ (mix(right + k) & mask)
            x[todo] = (left << U64(half)) | right
            todo = todo[x[todo] >= U64(n)]
    return x.astype(np.int64)
