"""Byte-level BPE: encode texts by a rank file and decode the ids again.

Each match of the pattern is merged on its own: among its neighbouring byte
pieces the pair of the lowest rank is joined, the leftmost first, until no pair
has a rank. A task keeps the ids of the distinct words it has met, so the fold
runs once per distinct word; a table of bounded size, emptied when it is full.
Decoding looks up the bytes of every id and concatenates them.

The fold is also given as a Spark higher-order function over a literal rank map
(``fold_words``), for tables of distinct words.

Null is an empty text, which has no ids. Rows are independent, so repeated rows,
ties and empty tables need no rule. Columns of the input with the names of the
results are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS_KEPT = 200_000
SHORT = 48
#: maps that the literal rank table is dealt to
SLOTS = 8192
IDS = ("array<int>", pa.list_(pa.int32()))


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of each byte piece, from a file of base64 pieces and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT:
        return _fold_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap, for words whose length must not count twice."""
    size = len(word)
    end = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    alive = [True] * size

    def pair(i: int) -> int | None:
        j = end[i]
        return ranks.get(word[i:end[j]]) if j < size else None

    heap = [(r, i, end[i + 1]) for i in range(size - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= size or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j], end[i] = False, stop
        if stop < size:
            before[stop] = i
        for k in (before[i], i):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, end[end[k]]))
    out, i = [], 0
    while i < size:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class _Memo(dict):
    """Word to its ids as little-endian bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        ids = np.array(fold(word.encode(), self.ranks), dtype="<u4").tobytes()
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.memo = _Memo(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _each_text(df: DataFrame, text: str, ranks: dict[bytes, int], pattern: str, added: dict, make) -> DataFrame:
    """Add columns made from each text and the codec, built once per task."""
    kept = [c for c in df.columns if c.lower() not in {a.lower() for a in added} or c == text]
    source = df.select(*kept)
    out = [f for f in source.schema.fields if f.name.lower() not in {a.lower() for a in added}]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out]
                       + [f"`{name}` {kind}" for name, (kind, _) in added.items()])
    table = df.sparkSession.sparkContext.broadcast(ranks)
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(table.value, pattern)
        for batch in batches:
            rows = [make(codec, t or "") for t in batch.column(text).to_pylist()]
            new = [pa.array([r[i] for r in rows], type=kind)
                   for i, (_, kind) in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + new,
                                             names=names + list(added))

    return source.mapInArrow(run, fields)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int)."""
    def make(codec: Codec, value: str):
        return (np.frombuffer(codec.encode(value), dtype="<i4"),)

    return _each_text(df, text, ranks, pattern, {"ids": IDS}, make)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes of an array of ids; null ids give null."""
    pieces = {rank: piece for piece, rank in ranks.items()}
    table = df.sparkSession.sparkContext.broadcast([pieces.get(i, b"") for i in range(max(pieces, default=-1) + 1)])

    @F.pandas_udf("binary")
    def joined(values):
        get = table.value.__getitem__
        return values.map(lambda v: None if v is None else b"".join(map(get, v)))

    return df.withColumn(out, joined(F.col(ids)))


def digests(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
            with_ids: bool = False) -> DataFrame:
    """Add ``n_tokens``, the digest of the ids and the digest of what they decode to; and ``ids`` if asked for."""
    def make(codec: Codec, value: str):
        ids = codec.encode(value)
        made = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest())
        return made + (np.frombuffer(ids, dtype="<i4"),) if with_ids else made

    added = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
             "decoded_sha256": ("string", pa.string())}
    return _each_text(df, text, ranks, pattern, added | ({"ids": IDS} if with_ids else {}), make)


# -- the fold as a higher-order function --------------------------------------

def byte_text(piece: bytes) -> str:
    """A character for each byte, as maps and concatenation of text need it."""
    return piece.decode("latin-1")


def rank_map(ranks: dict[bytes, int], buckets: int = SLOTS) -> Column:
    """The rank table as one literal: an array of small maps, found by the CRC of the piece.

    A map is searched from its start, so one map of all pieces would cost its
    whole length for every pair. The text is folded into a literal once per plan.
    """
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        maps[zlib.crc32(byte_text(piece).encode()) % buckets][byte_text(piece)] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def fold_words(words: DataFrame, table: Column, word: str = "word", buckets: int = SLOTS) -> DataFrame:
    """Add ``ids`` to a table of distinct binary words, by a fold of ranked merges."""
    def rank(piece: Column) -> Column:
        slot = (F.crc32(piece.cast("binary")) % buckets).cast("int") + 1
        return F.try_element_at(F.element_at(table, slot), piece)

    def merge(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.struct(
            rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))).alias("r"), i.alias("i")))
        best = F.when(F.size(parts) > 1, F.array_min(F.filter(pairs, lambda p: p["r"].isNotNull()))["i"])

        def joined(i: Column) -> Column:
            return F.concat(F.slice(parts, F.lit(1), i - 1),
                            F.array(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))),
                            F.slice(parts, i + 2, F.size(parts)))

        # an array of one place or none, so that the place is found once
        return F.coalesce(F.get(F.transform(F.filter(F.array(best), lambda i: i.isNotNull()), joined), F.lit(0)), parts)

    text = F.decode(F.col(word), "ISO-8859-1")
    size = F.char_length(text)
    letters = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(text, i, F.lit(1)))
    whole = rank(text)   # most words are pieces
    parts = F.aggregate(F.sequence(F.lit(2), size), letters, merge)
    ids = F.when(size == 0, F.array().cast("array<int>")).when(whole.isNotNull(), F.array(whole)).when(
        size == 1, F.transform(letters, rank)).otherwise(F.transform(parts, rank))
    return words.withColumn("ids", ids)
