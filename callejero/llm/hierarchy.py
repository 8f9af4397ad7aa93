"""Document quality by hierarchical empirical Bayes.

A logistic classifier over measures of a text (symbols, case, word lengths,
repetition, lines) and over its words (their mean log-odds in good against bad
texts, by hash) gives each document a probability of being good. Sites and the
sections of a site (host and path) are judged by the sum of these probabilities
over all their documents but the one in question: the site's share is shrunk
towards the share of all documents, the section's towards its site's. How strongly
is estimated from the spread between sites and between sections (moments of the
beta-binomial law), in grouped aggregates. The log-odds of the section against all
documents are added to those of the document.

The classifier is fitted on at most ``SAMPLE`` labelled rows (by the hash of the
id), where a text's own words are judged by the other half of the sample; everything
else covers all rows. Groups that hold much of the rows are joined by broadcast. Rows with a null label or id are not learned
from; of several labels of one id the highest counts. A null text is an empty one.
A null host or path is a site or section of its own. Without labels, or with one
kind only, all documents get the share of good labels (one if there are none).
Repeated rows count and are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero.llm import texts
from callejero.llm.hot import join_groups
from callejero.session import scratch_dir

SAMPLE = 20_000
CLASSES = {
    "symbols": b"#*$%&|<>", "bars": b"|", "shouts": b"!", "stops": b".,;:?", "digits": b"0123456789",
    "capitals": bytes(range(65, 91)), "lines": b"\n",
}
NAMES = [*CLASSES, "word_length", "length_spread", "log_words", "distinct", "repeats", "same_as_before", "same_line_start"]
LIMIT = 1e4
#: slots that words are hashed to, and how many texts of either kind stand behind a slot beforehand
SLOTS = 1 << 14
PRIOR = 5.0


@dataclass
class Classifier:
    mean: np.ndarray
    spread: np.ndarray
    beta: np.ndarray
    words: np.ndarray       # log-odds of each slot

    def logit(self, block: texts.Block) -> np.ndarray:
        owner, slots = word_slots(block)
        x = np.c_[features(block), word_odds(self.words, owner, slots, block.high - block.low)]
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.clip(_terms(z) @ self.beta, -12, 12)


def _terms(z: np.ndarray) -> np.ndarray:
    """An intercept, each measure and its distance from the usual."""
    return np.c_[np.ones(len(z)), z, np.abs(z)]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(values: np.ndarray, number: np.ndarray, size: int) -> np.ndarray:
    """Number of different values of each text."""
    keys = texts.mixed(values + (number.astype(np.uint64) + np.uint64(1)) * texts.STEP)
    order = np.argsort(keys, kind="stable")
    first = np.r_[True, keys[order[1:]] != keys[order[:-1]]] if len(keys) else np.zeros(0, bool)
    return np.bincount(number[order[first]], minlength=size)


def features(block: texts.Block) -> np.ndarray:
    """Measures of each text of a block, one row each."""
    size = block.high - block.low
    found = texts.words(block, texts.NOT_SPACE)
    number, count = found.text, found.count
    length = np.diff(block.bounds)

    def total(values: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0.0], np.cumsum(values)])[first])

    columns = [_share(total(texts.byte_table(lambda b, c=chars: b in c)[block.data], block.bounds), length)
               for chars in CLASSES.values()]
    span = (found.ends - found.starts).astype(float)
    mean = _share(total(span, found.first), count)
    square = _share(total(span * span, found.first), count)
    hashes = texts.word_hashes(found)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (number[1:] == number[:-1])
    at, n = texts.gram_positions(found.first, 4)
    owner = np.repeat(np.arange(size), n)
    different = _distinct(texts.grams(hashes, 4)[at], owner, size)
    columns += [
        np.minimum(mean, 50), np.minimum(np.sqrt(np.maximum(square - mean * mean, 0)), 50), np.log1p(count),
        np.where(count > 0, np.log1p(_distinct(hashes, number, size)) / np.log1p(np.maximum(count, 1)), 1.0),
        1 - np.where(n > 0, different / np.maximum(n, 1), 1.0), _share(total(same, found.first), count),
        np.minimum(_share(length, np.maximum(columns[-1] * length, 1)), 5000) / 1000]
    return np.array(columns, dtype=float).T


def word_slots(block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of the words of each text: text number and slot."""
    found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
    slots = (texts.word_hashes(found) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
    both = np.unique(found.text * SLOTS + slots)
    return both // SLOTS, both % SLOTS


def word_odds(words: np.ndarray, owner: np.ndarray, slots: np.ndarray, size: int) -> np.ndarray:
    """Mean log-odds of the slots of each text, 0 without words."""
    return _share(np.bincount(owner, weights=words[slots], minlength=size), np.bincount(owner, minlength=size))


def learn_words(owner: np.ndarray, slots: np.ndarray, y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log-odds of each slot: texts of the chosen rows that have it, good against bad."""
    chosen = rows[owner]
    good = np.bincount(slots[chosen], weights=y[owner[chosen]], minlength=SLOTS)
    every = np.bincount(slots[chosen], minlength=SLOTS)
    share = (y[rows].sum() + 0.5) / (rows.sum() + 1)
    own = (good + PRIOR * share) / (every + PRIOR)
    return np.log(own / (1 - own)) - np.log(share / (1 - share))


def fit(x: np.ndarray, y: np.ndarray, owner: np.ndarray, slots: np.ndarray) -> Classifier | None:
    """Logistic regression with a small ridge; None if only one kind is there."""
    if len(y) == 0 or y.min() == y.max():
        return None
    half = np.arange(len(y)) % 2 == 0
    odds = np.zeros(len(y))
    for own in (half, ~half):
        odds[own] = word_odds(learn_words(owner, slots, y, ~own), owner, slots, len(y))[own]
    x = np.c_[x, odds]
    mean, spread = np.median(x, axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    design = _terms(np.clip((x - mean) / spread, -6, 6))
    beta, ridge = np.zeros(design.shape[1]), np.full(design.shape[1], 0.5)
    ridge[0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return Classifier(mean, spread, beta, learn_words(owner, slots, y, np.ones(len(y), dtype=bool)))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE):
    """The classifier, or the share of good labels where it can't be fitted."""
    given = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.max((F.col(label) > 0).cast("int")).alias("label"))
    # ids and labels of the bounded sample are all that is broadcast
    chosen = given.orderBy(F.xxhash64(key), F.col(key)).limit(sample)
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(chosen), key).select(
        "text", "label", F.xxhash64(key).alias("order"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch.column(0)):
                size = block.high - block.low
                owner, slots = word_slots(block)
                ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=size))].tolist()
                raw = slots.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(block.low, size), batch.column(2).slice(block.low, size),
                     pa.array([row.tobytes() for row in features(block).astype("<f8")], pa.binary()),
                     pa.array([raw[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())],
                    names=["label", "order", "x", "slots"])

    # as bytes, a sample of that size takes some 15 MB
    got = rows.mapInArrow(run, "label int, order bigint, x binary, slots binary").collect()
    got.sort(key=lambda r: (r["order"], r["label"]))
    y = np.array([r["label"] for r in got], dtype=float)
    owner = np.repeat(np.arange(len(y)), [len(r["slots"]) // 2 for r in got])
    slots = np.frombuffer(b"".join(r["slots"] for r in got), dtype="<u2").astype(np.int64)
    x = np.frombuffer(b"".join(r["x"] for r in got), dtype="<f8").reshape(len(y), len(NAMES))
    model = fit(x, y, owner, slots)
    return model if model is not None else float(y.mean()) if len(y) else 1.0


def _strength(groups: DataFrame, n: str, k: str, centre: Column) -> float:
    """Prior strength from the spread of group shares about their centre (moments of the beta-binomial)."""
    n, k = F.col(n), F.col(k)
    sums = groups.filter(n > 1).agg(
        F.sum((k - n * centre) * (k - n * centre) / n).alias("between"),
        F.sum(centre * (1 - centre)).alias("within"),
        F.sum((n - 1) * centre * (1 - centre)).alias("room")).first()
    return strength_of(sums["between"], sums["within"], sums["room"])


def strength_of(between: float | None, within: float | None, room: float | None) -> float:
    """E[between] = sum of within * (1 + (n - 1) rho), and the strength is 1 / rho - 1."""
    if not room:
        return LIMIT
    rho = max((between - within) / room, 1 / (LIMIT + 1))
    return min(max(1 / min(rho, 0.5) - 1, 1.0), LIMIT)


def assess(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
           path: str = "lang", label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """One row per document: key, evidence, site and section (probabilities), score, kept."""
    model = train(docs, labels, key, text, label)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias("host"),
                         F.coalesce(F.concat(F.lit("="), F.col(path)), F.lit("")).alias("path"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(shared.value, Classifier):
                logits = [shared.value.logit(block) for block in texts.blocks(batch.column(3))]
                p = 1 / (1 + np.exp(-np.concatenate([*logits, np.zeros(0)])))
            else:
                p = np.full(batch.num_rows, shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p, pa.float64())],
                                             names=["key", "host", "path", "p"])

    folder = scratch_dir(spark, "hierarchy")
    source.mapInArrow(run, f"key {kind}, host string, path string, p double").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("k")).write.parquet(f"{folder}/sections")
    sections = spark.read.parquet(f"{folder}/sections")
    sections.groupBy("host").agg(F.sum("n").alias("site_n"), F.sum("k").alias("site_k")).write.parquet(f"{folder}/sites")
    sites = spark.read.parquet(f"{folder}/sites")
    # three numbers reach the driver: the mean of all rows and the two strengths
    total, whole = sites.agg(F.coalesce(F.sum("site_n"), F.lit(0)), F.coalesce(F.sum("site_k"), F.lit(0.0))).first()
    mean = min(max(whole / total, 1e-4), 1 - 1e-4) if total else 0.5
    site_strength = _strength(sites, "site_n", "site_k", F.lit(mean))
    site_share = (F.col("site_k") + site_strength * mean) / (F.col("site_n") + site_strength)
    sections.join(sites, "host").withColumn("centre", site_share).write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")
    strength = _strength(groups, "n", "k", F.col("centre"))
    both = join_groups(rows, groups.select("host", "path", "n", "k", "site_n", "site_k"), ["host", "path"], "n", total)
    # a document's own evidence is not counted twice
    others = both.withColumn(
        "site", (F.col("site_k") - F.col("p") + site_strength * mean) / (F.col("site_n") - 1 + site_strength)).withColumn(
        "section", (F.col("k") - F.col("p") + strength * F.col("site")) / (F.col("n") - 1 + strength))

    def logit(p: Column) -> Column:
        inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(inside / (1 - inside))

    score = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(F.col("section")) - logit(F.lit(mean)))))
    return others.select(F.col("key").alias(key), F.col("p").alias("evidence"), "site", "section", score.alias("score"),
                         (score >= threshold).alias("kept"))
