"""Words and hashes of an Arrow text column, as NumPy arrays inside a task.

A column is cut into blocks of a few megabytes (a longer text is one block), so
a task's memory follows the block and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def byte_table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


# words of `[^\x20\x09-\x0D]+`
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in a text with A-Z lower-cased
LETTERS_DIGITS = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


@dataclass
class Block:
    """Rows ``low`` to ``high`` of a column: their bytes and where each text begins."""

    low: int
    high: int
    data: np.ndarray
    bounds: np.ndarray


@dataclass
class Words:
    """Words of a block: byte ranges, the first word of each text, and the word bytes alone."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    letters: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks; null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, where, data = column.buffers()
    bounds = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Block(low, high, data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
        low = high


def words(block: Block, table: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of word bytes; a run never reaches over the end of a text."""
    data = LOWER[block.data] if lower else block.data
    size = len(data)
    inside = table[data]
    before = np.zeros(size, dtype=bool)
    after = np.zeros(size, dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = block.bounds[1:-1]
    before[edges[edges < size]] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return Words(starts, np.flatnonzero(inside & ~after) + 1,
                 np.searchsorted(starts, block.bounds), data[inside])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int, base: np.uint64 = MULTIPLIER) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(found: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    lengths = found.ends - found.starts
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(found.letters))
    terms = powers(int(lengths.max()) + 1)[left] * (found.letters.astype(np.uint64) + np.uint64(1))
    return mixed(np.add.reduceat(terms, ends - lengths) + lengths.astype(np.uint64))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position; the last ones run over the end of the array."""
    out = hashes.copy()
    for k in range(1, size):
        out = out * STEP
        out[:-k or None] += hashes[k:]
    return mixed(out)


def gram_positions(first: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Positions where ``size`` words of one text begin, and how many each text has.

    With ``short``, a text of fewer words (but one) has one position, its first.
    """
    count = np.diff(first)
    n = np.maximum(count - size + 1, 0)
    if short:
        n = np.where((count > 0) & (count < size), 1, n)
    ends = np.cumsum(n)
    return np.repeat(first[:-1] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0), n
