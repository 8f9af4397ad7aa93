"""Toxic passages as maximum-scoring segments over token log-odds.

Tokens are words of letters and digits, A-Z lower-cased. The share of toxic
documents behind a token has a Dirichlet prior whose mean is the share of its
prefix of one byte less, from 9 bytes down to 3 and the share of all tokens, so
an unseen word of a known family is judged by its family. A token's score is the
log-odds of its share against all tokens; tokens that say little cost ``DRIFT``.

A linear scan finds all maximal segments of a text. Scores of clean texts follow
an extreme-value law, P(best >= s) = 1 - exp(-K n exp(-lambda s)): lambda comes
from the token scores of clean training texts, K from the best segments of clean
calibration texts. A segment with an expectation of at most ``EXPECTED`` in a
clean text of that length is significant; the normalised scores of all of them
are added up, and a logistic curve fitted on the calibration texts turns the sum
into a probability.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` of either
class, by the hash of the id), for learning and for calibration each; the lexicon is
as large as what that sample says. Rows with a null label are not learned from; of several labels of one id the
highest counts. Null and empty texts have no segments and get the score of a text
without any. Without rows to learn from, every score is the share of toxic labels
(0 without labels). Repeated rows are judged alike; columns of the input with the
names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero.llm import texts
from callejero.session import scratch_dir

SAMPLE = 16_000
DEPTHS = (3, 4, 5, 6, 7, 8, 9)
WHOLE = 99
PRIOR = 6.0
DRIFT = 0.25
LEAST = 1.0
EXPECTED = 0.05
#: no share is nearer to 0 or 1 than this
SURE = 1e-9


@dataclass
class Model:
    keys: list[np.ndarray] = field(default_factory=list)     # by level, sorted
    odds: list[np.ndarray] = field(default_factory=list)
    lam: float = 1.0
    k: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0


def _levels(found: texts.Words) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each level: the positions that have it, and their keys; the last level is the whole word."""
    lengths = found.ends - found.starts
    offsets = np.cumsum(lengths) - lengths
    state = np.zeros(len(lengths), dtype=np.uint64)
    places, keys = [], []
    for depth in range(1, DEPTHS[-1] + 1):
        longer = np.flatnonzero(lengths >= depth)
        state[longer] = state[longer] * texts.MULTIPLIER + found.letters[offsets[longer] + depth - 1] + np.uint64(1)
        if depth in DEPTHS:
            own = np.flatnonzero(lengths > depth)
            places.append(own)
            keys.append(texts.mixed(state[own] + np.uint64(depth)))
    places.append(np.arange(len(lengths)))
    keys.append(texts.mixed(texts.word_hashes(found) + np.uint64(WHOLE)))
    return places, keys


def _counts(rows: DataFrame) -> DataFrame:
    """level, key, parent, n1, n0 of labelled texts, summed over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for block in texts.blocks(batch.column(0)):
                found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
                toxic = label[block.low:block.high][found.text]
                parent = np.zeros(len(toxic), dtype=np.uint64)
                for level, (at, key) in enumerate(zip(*_levels(found))):
                    own, where, inverse = np.unique(key, return_index=True, return_inverse=True)
                    n1 = np.bincount(inverse, weights=toxic[at], minlength=len(own)).astype(np.int64)
                    n = np.bincount(inverse, minlength=len(own))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), level), pa.int32()), pa.array(own.view(np.int64)),
                         pa.array(parent[at][where].view(np.int64)), pa.array(n1), pa.array(n - n1, pa.int64())],
                        names=["level", "key", "parent", "n1", "n0"])
                    parent[at] = key

    schema = "level int, key bigint, parent bigint, n1 bigint, n0 bigint"
    return rows.mapInArrow(run, schema).groupBy("level", "key").agg(
        F.min("parent").alias("parent"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _lexicon(counts: DataFrame, toxic: int, clean: int, folder: str) -> DataFrame:
    """Prefixes and words that speak for toxicity, or against a prefix of theirs that does.

    Each level is written, and the next one is joined with what was written, so that
    no plan holds more than one level.
    """
    spark = counts.sparkSession
    root = toxic / (toxic + clean)
    for level in range(len(DEPTHS) + 1):
        own = counts.filter(F.col("level") == level).drop("level")
        if level:
            # a prefix's parent is on the level before; a word's is its longest prefix
            above = spark.read.parquet(f"{folder}/level={level - 1}" if level < len(DEPTHS) else folder)
            own = own.join(above.select(F.col("key").alias("parent"), F.col("share").alias("before")), "parent", "left")
        else:
            own = own.withColumn("before", F.lit(None).cast("double"))
        before = F.coalesce("before", F.lit(root))
        share = F.least(F.greatest((F.col("n1") + PRIOR * before) / (F.col("n1") + F.col("n0") + PRIOR), F.lit(SURE)), F.lit(1 - SURE))
        own.select("key", "n1", "n0", before.alias("before"), share.alias("share")).write.parquet(f"{folder}/level={level}")
    base = float(np.log(root / (1 - root)))

    def odds(of: str) -> Column:
        return F.log(F.col(of) / (1 - F.col(of))) - base

    rows = spark.read.parquet(folder).withColumn("odds", odds("share")).withColumn("before", odds("before"))
    speaks = (F.col("odds") >= LEAST) & (F.col("n1") >= 2) & (F.col("odds") - F.col("before") >= 0.5)
    against = (F.col("before") >= LEAST) & (F.col("before") - F.col("odds") >= 0.5)
    return rows.filter(speaks | against).select("level", "key", "odds", "n0")


def segments(at: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of words with the given scores, others at -drift."""
    held: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, -1
    for place, value in zip(at, score):
        left = total - drift * (place - last - 1)
        right = total = left + value
        last = place
        if value <= 0:
            continue
        start, j = place, len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= left:
                j = held[j][4]
            if j < 0 or held[j][1] >= right:
                held.append((left, right, start, place, j))
                break
            left, start, before = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = before
    return [(h[2], h[3], h[1] - h[0]) for h in held]


def _token_scores(model: Model, found: texts.Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words that are in the lexicon, and their scores."""
    score = np.full(len(found.starts), np.nan)
    for level, (at, key) in enumerate(zip(*_levels(found))):
        known = model.keys[level] if level < len(model.keys) else np.zeros(0, np.uint64)
        if not len(known) or not len(key):
            continue
        maybe = np.zeros(1 << 18, dtype=bool)
        maybe[(known >> np.uint64(46)).astype(np.int64)] = True
        could = maybe[(key >> np.uint64(46)).astype(np.int64)]
        at, key = at[could], key[could]
        where = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit = known[where] == key
        score[at[hit]] = model.odds[level][where[hit]]
    at = np.flatnonzero(~np.isnan(score))
    return at, score[at]


def _passages(model: Model, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Number of words and all maximal segments of each text."""
    for block in texts.blocks(column):
        found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
        at, score = _token_scores(model, found)
        cut = np.searchsorted(at, found.first)
        for i, n in enumerate(found.count.tolist()):
            a, b = cut[i], cut[i + 1]
            yield n, segments((at[a:b] - found.first[i]).tolist(), score[a:b].tolist(), DRIFT) if b > a else []


def _sum(model: Model, n: int, found: list[tuple[int, int, float]]) -> tuple[float, list[tuple[int, int, float]]]:
    """Sum of the normalised scores of the significant segments, and these segments."""
    bound = -np.log(EXPECTED)
    good = [(a, b, v) for a, b, s in found if (v := model.lam * s - np.log(model.k * max(n, 1))) >= bound]
    return sum(v for _, _, v in good), good


def _lambda(odds: np.ndarray, n0: np.ndarray, clean: int) -> float:
    """The positive root of E[exp(lambda score)] = 1 over tokens of clean texts."""
    share = (n0 + 0.5) / (clean + 0.5 * len(n0) + 1)
    rest = max(1 - share.sum(), 1e-9)
    if share @ odds - rest * DRIFT >= 0 or not (odds > 0).any():
        return 0.1 if (odds > 0).any() else 1.0
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        over = share @ np.exp(np.minimum(middle * odds, 700)) + rest * np.exp(-middle * DRIFT) > 1
        low, high = (low, middle) if over else (middle, high)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    design = np.c_[np.ones(len(x)), x]
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta * [0, 1]
        hessian = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + np.diag([1e-9, 1e-2])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -4, 4)
        if abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _bounded(labels: DataFrame, key: str, size: int) -> DataFrame:
    order = [F.xxhash64(key), F.col(key)]
    return labels.filter("label = 1").orderBy(*order).limit(size).unionByName(
        labels.filter("label = 0").orderBy(*order).limit(size))


def train(docs: DataFrame, labels: DataFrame, calibration: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows; those for which ``calibration`` (of the key) holds calibrate the score."""
    given = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.max((F.col(label) > 0).cast("int")).alias("label")).withColumn("held", calibration)
    sizes = {(r["held"], r["label"]): r["n"] for r in given.groupBy("held", "label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    toxic_share = sum(n for (_, one), n in sizes.items() if one) / total if total else 0.0
    model = Model(intercept=float(np.log(toxic_share / (1 - toxic_share))) if 0 < toxic_share < 1 else 40.0 * (2 * toxic_share - 1))
    if not sizes.get((False, 1)) or not sizes.get((False, 0)):
        return model
    spark, folder = docs.sparkSession, scratch_dir(docs.sparkSession, "toxicity")
    # at most four times the sample: its ids and labels are what is broadcast, its texts are written once
    chosen = _bounded(given.filter("NOT held"), key, sample).unionByName(_bounded(given.filter("held"), key, sample))
    docs.select(F.col(key), F.col(text).alias("text")).join(
        F.broadcast(chosen.select(key, "label", "held")), key).select("text", "label", "held").write.parquet(f"{folder}/sample")
    rows = spark.read.parquet(f"{folder}/sample")
    calibrating = rows.filter("held").select("text", "label")
    _counts(rows.filter("NOT held").select("text", "label")).withColumn("held", F.lit(False)).unionByName(
        _counts(calibrating).withColumn("held", F.lit(True))).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    if not _learn(model, counts.filter("NOT held").drop("held"), f"{folder}/learned"):
        return model
    quiet = passages(calibrating, model, kept=["label"]).filter("label = 0").select("best", "n_words").toPandas()
    if len(quiet):
        # K from how often a clean text holds a segment of at least the least score
        over = (quiet["best"] >= LEAST).sum()
        chance = (over + 0.5) / (len(quiet) + 1)
        model.k = float(-np.log1p(-chance) * np.exp(model.lam * LEAST) / max(quiet["n_words"].mean(), 1.0))
    held = passages(calibrating, model, kept=["label"]).select("label", "sum").toPandas()
    if held["label"].nunique() == 2:
        y = held["label"].to_numpy(dtype=float)
        share = {one: sizes[(True, one)] / (y == one).sum() for one in (0, 1)}
        weight = np.where(y == 1, share[1], share[0])
        model.intercept, model.slope = _logistic(np.log1p(held["sum"].to_numpy()), y, weight / weight.mean())
    else:
        model.slope = 3.0
    # the calibration holds for texts that were not learned from; the tokens are then learned from all
    calibrated = model.lam
    _learn(model, counts.groupBy("level", "key").agg(
        F.min("parent").alias("parent"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), f"{folder}/learned-from-all")
    model.lam = calibrated
    return model


def _learn(model: Model, counts: DataFrame, folder: str) -> bool:
    """Put the lexicon of some counts and its lambda into the model, if both kinds of text have tokens."""
    sums = counts.filter(F.col("level") == len(DEPTHS)).agg(F.sum("n1"), F.sum("n0")).first()
    toxic, clean = sums[0] or 0, sums[1] or 0
    if not toxic or not clean:
        return False
    got = _lexicon(counts, toxic, clean, folder).toPandas()   # bounded by the sample
    model.keys, model.odds = [], []
    for level in range(len(DEPTHS) + 1):
        own = got[got["level"] == level]
        keys = own["key"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(keys)
        model.keys.append(keys[order])
        model.odds.append(own["odds"].to_numpy(dtype=float)[order])
    model.lam = _lambda(got["odds"].to_numpy(dtype=float), got["n0"].to_numpy(dtype=float), clean)
    return True


def passages(df: DataFrame, model: Model, text: str = "text", kept: list[str] | None = None) -> DataFrame:
    """Words, significant segments, best segment, and the probability of toxicity of each text."""
    added = {"n_words": ("bigint", pa.int64()), "best": ("double", pa.float64()), "sum": ("double", pa.float64()),
             "segments": ("array<struct<low:bigint,high:bigint,score:double>>",
                          pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("score", pa.float64())]))),
             "score": ("double", pa.float64())}
    fields = [f for f in df.schema.fields if (kept is None or f.name in kept) and f.name.lower() not in added]
    names = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{n}` {k}" for n, (k, _) in added.items()])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for n, found in _passages(model, batch.column(batch.schema.get_field_index(text))):
                total, good = _sum(model, n, found)
                chance = 1 / (1 + np.exp(-np.clip(model.intercept + model.slope * np.log1p(total), -40, 40)))
                rows.append((n, max((s for _, _, s in found), default=0.0), total,
                             [{"low": a, "high": b + 1, "score": v} for a, b, v in good], chance))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array([r[i] for r in rows], type=kind) for i, (_, kind) in enumerate(added.values())],
                names=names + list(added))

    needed = [f"`{n}`" for n in dict.fromkeys([*names, text])]
    return df.select(*needed).mapInArrow(run, schema)
