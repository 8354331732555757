"""Words and their hashes in numpy, for the operators that run on Arrow batches.

A word is a run of bytes other than space and 0x09-0x0D, which is what
``bytes.split()`` yields.  UTF-8 never puts those bytes inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multiplier of the polynomial (Rabin-Karp) window hash.
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word; bounded, since a vocabulary is not."""

    LIMIT = 1 << 19

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(cache: WordHashes, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents in a row, and each one's length."""
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    return np.fromiter(map(cache.__getitem__, chain.from_iterable(docs)), np.uint64, int(lens.sum())), lens


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every ``size`` consecutive words, by start."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, size):
        out *= BASE
        out += words[j:j + n]
    return mix(out)


def window_starts(lens: np.ndarray, size: int) -> np.ndarray:
    """Starts, in the row of all words, of the windows inside one document."""
    ends = np.cumsum(lens)
    left = np.repeat(ends, lens) - np.arange(int(lens.sum()))
    return np.flatnonzero(left >= size)


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of a text column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``most`` text bytes, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column).cast(pa.large_binary()))
        total = np.cumsum(np.asarray(sizes.fill_null(0)))
        at = 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to
