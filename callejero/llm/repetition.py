"""Repeated passages inside a text, by suffix arrays over its words.

All texts of a block share one suffix array: the first sort key of a word holds
its text, so suffixes of different texts never agree. Ranks are doubled (2, 4, 8
words, ...) and only suffixes that are still tied are sorted again. The ranks of
all lengths give the common prefix of neighbours by binary lifting; a position's
longest repeat is the larger of its two, and it is maximal if the position before
it doesn't hold it. The union of the maximal spans of at least ``n`` words is the
set of words in ``n``-word windows found twice or more.

Null is an empty text without words. Repeated rows are judged alike. Columns of
the input with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero.llm import texts

SYMBOLS = texts.byte_table(lambda b: b in b"#*$%&|<>")
WINDOW = 8


def longest_repeats(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the longest repeat that begins at each word.

    ``keys`` are equal for equal words of one text only; ``ends`` is where the
    text of each word ends.
    """
    size = len(keys)
    if not size:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    new = np.ones(size, dtype=bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    levels = [rank.astype(np.int32)]
    tied = _tied(rank, np.arange(size))
    step = 1
    while len(tied):
        ahead = tied + step
        inside = ahead < ends[tied]
        second = np.zeros(len(tied), dtype=np.int64)
        second[inside] = rank[ahead[inside]] + 1
        pair = rank[tied] * (size + 1) + second
        order = np.argsort(pair, kind="stable")
        tied, pair = tied[order], pair[order]
        group = rank[tied]
        at = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], at, 0))
        part = np.maximum.accumulate(np.where(np.r_[True, pair[1:] != pair[:-1]], at, 0))
        rank = rank.copy()
        rank[tied] = group + part - first
        tied = _tied(rank, tied)
        step *= 2
        levels.append(rank.astype(np.int32))
    suffixes = np.empty(size, dtype=np.int64)
    suffixes[rank] = np.arange(size)
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(size - 1, dtype=np.int64)
    live = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b, c = left[live], right[live], common[live]
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + c, b + c
        inside = (x < ends[a]) & (y < ends[b])
        same = np.zeros(len(c), dtype=bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        c = c + (same.astype(np.int64) << k)
    common[live] = c
    out = np.zeros(size, dtype=np.int64)
    out[left] = common
    out[right] = np.maximum(out[right], common)
    return out


def _tied(rank: np.ndarray, among: np.ndarray) -> np.ndarray:
    counts = np.bincount(rank[among], minlength=len(rank))
    return among[counts[rank[among]] > 1]


def maximal(repeats: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions whose repeat isn't the tail of the one before."""
    out = repeats > 0
    out[1:] &= ~(repeats[:-1] == repeats[1:] + 1)
    begins = first[:-1][first[:-1] < len(repeats)]
    out[begins] = repeats[begins] > 0
    return out


def covered(repeats: np.ndarray, begins: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a maximal repeat of at least ``least`` words."""
    at = begins[repeats[begins] >= least]
    change = np.zeros(len(repeats) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + repeats[at], -1)
    return np.cumsum(change[:-1]) > 0


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def _repeated_lines(text: str) -> int:
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            repeated += line in seen
            seen.add(line)
    return repeated


@dataclass(frozen=True)
class Limits:
    """``least`` words make a repeat; limits of its share of a text (%) and of the longest one (words)."""

    least: int = 5
    share: int = 40
    longest: int = 64


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def measures(df: DataFrame, text: str = "text", least: int = Limits.least) -> DataFrame:
    """Add the counts of words, symbols, repeated lines and repeated words, and the longest repeat."""
    kept = [f for f in df.schema.fields if f.name.lower() not in MEASURES or f.name == text]
    out = [f for f in kept if f.name.lower() not in MEASURES]
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            for block in texts.blocks(column):
                part = batch.slice(block.low, block.high - block.low)
                found = texts.words(block, texts.NOT_SPACE)
                number = found.text
                hashes = texts.word_hashes(found)
                keys = texts.mixed(hashes + (number.astype(np.uint64) + np.uint64(1)) * texts.STEP)
                repeats = longest_repeats(keys, found.first[1:][number])
                begins = np.flatnonzero(maximal(repeats, found.first))
                letters = np.concatenate([[0], np.cumsum((found.letters & 0xC0) != 0x80)])
                length = found.ends - found.starts
                ends = np.cumsum(length)
                longest = np.zeros(block.high - block.low, dtype=np.int64)
                np.maximum.at(longest, number, repeats)
                values = [
                    found.count, _per_text(letters[ends] - letters[ends - length], found.first),
                    _per_text(SYMBOLS[block.data], block.bounds),
                    np.array([_repeated_lines(t or "") for t in part.column(text).to_pylist()]),
                    _per_text(covered(repeats, begins, WINDOW), found.first),
                    _per_text(covered(repeats, begins, least), found.first), longest]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(v, pa.int64()) for v in values],
                    names=names + MEASURES)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out] + [f"{m} bigint" for m in MEASURES])
    return df.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)


def judge(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Measures, ``base_failed`` (too short, or over 30 % in repeated windows) and ``kept``."""
    measured = measures(df, text, limits.least)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    fine = (F.col("covered_words") * 100 <= F.col("n_words") * limits.share) & (
        F.col("longest_repeat") <= limits.longest)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
