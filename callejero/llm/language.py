"""Language of a text by error-correcting output codes over character trigrams.

Each language has a codeword; for each bit a naive Bayes classifier over hashed
trigrams tells the languages with a one from those with a zero. Its output is the
mean log-odds of the text's trigrams, placed and scaled by what texts of each
language give on average. Decoding chooses the codeword of the least logistic
loss, each bit weighted by how far apart its two sides are; the softmax of the
losses is the score, and a small lead over the second best marks ambiguity.

Trigrams are of lower-cased letters, with any run of other characters as one
space. The model is languages x ``SLOTS`` counts (at most ``MAX_LANGUAGES``
languages, more is an error), counted over all training rows.

A null text or one without a letter is ``und`` with score 0, as is every text if
there was nothing to learn from; with one language learned every other text is of
that language, with score 1. Equal losses take the first language by name.
Columns of the input with the names of the results are replaced; repeated rows
are judged alike, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 13
MAX_LANGUAGES = 256
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"
MARGIN = 4.0


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray       # languages x bits, 1 or -1
    weights: np.ndarray     # bits x slots
    middle: np.ndarray
    scale: np.ndarray
    importance: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded length; a longer text is a run of its own."""
    low, held, size = 0, [], 0
    for i, text in enumerate(column.to_pylist()):
        text = text or ""
        if held and size + len(text) > CHUNK_CHARS:
            yield low, held
            low, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield low, held


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the trigrams of each text, the text of each, and which texts have a letter."""
    lowered = [t.lower() for t in texts]
    lengths = np.array([len(t) for t in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    number = np.repeat(np.arange(len(texts)), lengths)
    is_letter = _letters()[codes]
    # a text is written as space, text, space; what is no letter is a space; runs of spaces are one
    total = len(codes) + 2 * len(texts)
    at = np.arange(len(codes)) + 2 * number + 1
    line = np.full(total, 32, dtype=np.uint32)
    line[at] = np.where(is_letter, codes, 32)
    owner = np.repeat(np.arange(len(texts)), lengths + 2)
    keep = np.ones(total, dtype=bool)
    keep[1:] = (line[1:] != 32) | (line[:-1] != 32) | (owner[1:] != owner[:-1])
    line, owner = line[keep], owner[keep]
    if len(line) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    whole = owner[2:] == owner[:-2]
    mixed = (line[:-2] * np.uint32(0x9E3779B1) ^ line[1:-1]) * np.uint32(0x85EBCA77)
    mixed = (mixed ^ (mixed >> np.uint32(15)) ^ line[2:]) * np.uint32(0xC2B2AE3D)
    slots = (mixed >> np.uint32(32 - SLOTS.bit_length() + 1)).astype(np.int64)
    has = np.zeros(len(texts), dtype=bool)
    has[number[is_letter]] = True
    return slots[whole], owner[2:][whole], has


def codewords(count: int, seed: int = 7) -> np.ndarray:
    """All splits of up to five languages; beyond, ten times log2 even splits at random, all different, or all even ones."""
    if count < 2:
        return np.ones((count, 0), dtype=np.int8)
    if count <= 5:
        splits = [[1] + [1 if (s >> i) & 1 else -1 for i in range(count - 1)] for s in range(2 ** (count - 1) - 1)]
        return np.array(splits, dtype=np.int8).T
    rng = np.random.default_rng(seed)
    bits = 10 * int(np.ceil(np.log2(count)))
    half = count // 2
    if comb(count, half) // (1 if count % 2 else 2) <= bits:   # six languages have ten even splits
        sides = [c for c in combinations(range(count), half) if count % 2 or 0 in c]
        return np.array([[1 if i in c else -1 for c in sides] for i in range(count)], dtype=np.int8)
    columns: dict[bytes, np.ndarray] = {}
    while len(columns) < bits or len(np.unique(np.array(list(columns.values())).T, axis=0)) < count:
        column = np.where(rng.permutation(count) < count // 2, 1, -1).astype(np.int8)
        columns.setdefault((column * column[0]).tobytes(), column)
    return np.array(list(columns.values())).T


def train(rows: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Count trigrams by language over all rows that have both; the sums go to the driver, never the rows."""
    source = rows.filter(F.col(text).isNotNull() & F.col(language).isNotNull()).select(
        F.col(text).alias("text"), F.col(language).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for low, held in _chunks(batch.column(0)):
                slots, owner, _ = _trigrams(held)
                here = names[low:low + len(held)]
                known = sorted(set(here))
                code = np.array([known.index(n) for n in here])
                sums = np.bincount(code[owner] * SLOTS + slots, minlength=len(known) * SLOTS).reshape(-1, SLOTS)
                for name, one in zip(known, sums):
                    counts[name] = counts.get(name, 0) + one
        for name, one in counts.items():
            at = np.flatnonzero(one)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(one[at], pa.int64())],
                names=["lang", "slot", "n"])

    sums = source.mapInArrow(run, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    got = sums.limit(MAX_LANGUAGES * SLOTS + 1).toPandas()
    languages = sorted(got["lang"].unique().tolist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    counts = np.zeros((len(languages), SLOTS))
    place = {name: i for i, name in enumerate(languages)}
    counts[got["lang"].map(place).to_numpy(dtype=int), got["slot"].to_numpy(dtype=int)] = got["n"].to_numpy(dtype=float)
    return fit(languages, counts)


def fit(languages: list[str], counts: np.ndarray) -> Model:
    """Classifiers of all bits from trigram counts by language."""
    codes = codewords(len(languages))
    shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if len(languages) else counts
    weights, middle, scale, importance = [], [], [], []
    for bit in range(codes.shape[1]):
        ones, zeros = shares[codes[:, bit] > 0], shares[codes[:, bit] < 0]
        odds = np.log(ones.mean(axis=0)) - np.log(zeros.mean(axis=0))
        low, high = (ones @ odds).min(), (zeros @ odds).max()
        gap = max(low - high, 1e-6)
        weights.append(odds)
        middle.append((low + high) / 2)
        scale.append(2 * MARGIN / gap)
        importance.append(gap)
    importance = np.array(importance)
    return Model(languages, codes, np.array(weights, dtype=np.float32).reshape(codes.shape[1], SLOTS),
                 np.array(middle), np.array(scale), importance / importance.mean() if len(importance) else importance)


def _decode(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    slots, owner, has = _trigrams(texts)
    size = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
    loss = np.zeros((len(texts), len(model.languages)))
    for bit in range(model.codes.shape[1]):
        mean = np.bincount(owner, weights=model.weights[bit][slots], minlength=len(texts)) / size
        out = np.clip((mean - model.middle[bit]) * model.scale[bit], -30, 30)
        loss += model.importance[bit] * np.log1p(np.exp(-out[:, None] * model.codes[None, :, bit]))
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    best = loss.argmin(axis=1)
    chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
    chance /= chance.sum(axis=1, keepdims=True)
    ordered = np.sort(loss, axis=1)
    lead = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(texts), np.inf)
    names = [model.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
    return names, np.where(has, chance.max(axis=1), 0.0), np.where(has, lead, 0.0)


def predict(df: DataFrame, model: Model, text: str = "text", ambiguous_below: float = 0.5, prefix: str = "") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` (the lead in loss over the second best is small), with ``prefix``."""
    added = [f"{prefix}{name}" for name in ("lang_pred", "score", "ambiguous")]
    kept = [f for f in df.schema.fields if f.name.lower() not in added or f.name == text]
    source = df.select(*[f"`{f.name}`" for f in kept])
    out = [f for f in kept if f.name.lower() not in added]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out]
                       + [f"`{name}` {kind}" for name, kind in zip(added, ("string", "double", "boolean"))])
    names = [f.name for f in out]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score, lead = [], [], []
            for _, held in _chunks(batch.column(text)):
                a, b, c = _decode(shared.value, held)
                found += a
                score.append(b)
                lead.append(c)
            score = np.concatenate(score) if score else np.zeros(0)
            lead = np.concatenate(lead) if lead else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(found, pa.string()), pa.array(score), pa.array(lead < ambiguous_below)],
                names=names + added)

    return source.mapInArrow(run, schema)
