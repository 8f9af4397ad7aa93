"""Components of documents that share most of their shingles, by b-bit MinHash.

Texts with A-Z lower-cased are words without spaces; a document's set is its
distinct runs of ``shingle`` words (with fewer words, the whole sequence). Equal
sets are one class, found by grouping on their digest, however many copies there
are. A class has ``MINIMA`` minima: the two low bits of each make the packed
signature, and each ``ROWS`` of them a band key. Two sets of similarity 0.8 agree
in none of the 32 bands with a probability of 5e-8.

Pairs of a band are never all listed. First each member is compared with one hub of
its bucket, drawn by the key: the signatures estimate the similarity by bit counts
(corrected for chance agreement), and pairs within five standard deviations of the
limit are confirmed on the full sets, the best of each document first. What is left are
members of buckets that hold several components. Their pairs across components pass only
if an exact bound on the shingles they share allows a link; again the best are confirmed
first. So a large group of near copies costs a few comparisons per member, and no pair
that shares a band and could join two components goes unchecked.

Only texts of candidate classes are moved, kept by a bitmap of their ids. Tables of
each phase are written to the shared folder, where an executor's loss costs nothing.
Nothing but sizes and that bitmap reaches the driver.

Null and empty texts have no shingles and are alone. Rows that share an id stand for
one document; a null id is linked with nothing and has no component. Ids are whole
numbers. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero.llm import texts
from callejero.llm.bitmaps import bitmap, holds
from callejero.llm.hot import join_groups
from callejero.session import scratch_dir

MINIMA = 128
ROWS = 4
BITS = 2
PERCENT = 80
#: least estimate to confirm: 0.8 less five standard deviations of the estimate
ESTIMATE = 0.58
SIGNATURE = ["s0", "s1", "s2", "s3"]
#: slots of the bitmaps of sets that were compared with their hubs only, and the words that hold them
SLOTS = 4096
WORDS = [f"w{i}" for i in range(SLOTS // 64)]


def _factors(seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(block: texts.Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and how many each has."""
    found = texts.words(block, texts.NOT_SPACE, lower=True)
    hashes = texts.word_hashes(found)
    at, n = texts.gram_positions(found.first, size, short=True)
    values = texts.grams(hashes, size)[at]
    few = np.flatnonzero((found.count > 0) & (found.count < size))
    ends = np.cumsum(n)
    for words in range(1, size):
        own = few[found.count[few] == words]
        if len(own):
            values[ends[own] - 1] = texts.mixed(texts.grams(hashes, words)[found.first[own]] + np.uint64(words))
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(n))


def _features(values: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Digest, packed signature and band keys of each set; of an empty one all zero."""
    full = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[full]
    out = {c: np.zeros(len(n), dtype=np.uint64) for c in ("d1", "d2", *SIGNATURE)}
    bands = np.zeros((len(n), MINIMA // ROWS), dtype=np.uint64)
    if len(full):
        out["d1"][full] = np.add.reduceat(texts.mixed(values), starts)
        out["d2"][full] = np.add.reduceat(texts.mixed(values ^ texts.STEP), starts)
        minima = np.empty((MINIMA, len(full)), dtype=np.uint64)
        for i, factor in enumerate(_factors()):
            minima[i] = np.minimum.reduceat(values * factor, starts)
        minima = texts.mixed(minima)
        low = minima & np.uint64(3)
        for word, name in enumerate(SIGNATURE):
            for i in range(32):
                out[name][full] |= low[32 * word + i] << np.uint64(2 * i)
        for band in range(MINIMA // ROWS):
            key = np.full(len(full), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                key = key * texts.MULTIPLIER + minima[ROWS * band + row]
            bands[full, band] = texts.mixed(key)
    return out | {"bands": bands}


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch.column(1)):
                values, n = shingles(block, shingle)
                made = _features(values, n)
                bands = made.pop("bands").view(np.int64)
                width = bands.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * width, pa.int32()), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, block.high - block.low), pa.array(n, pa.int64()),
                     *[pa.array(v.view(np.int64)) for v in made.values()], lists],
                    names=["id", "n", *made, "bands"])

    columns = ", ".join(f"{c} bigint" for c in ("id", "n", "d1", "d2", *SIGNATURE))
    return docs.mapInArrow(run, f"{columns}, bands array<bigint>")


def estimate(left: str, right: str) -> Column:
    """Similarity from two packed signatures: agreeing values, less those that agree by chance."""
    agree = None
    for name in SIGNATURE:
        differs = F.col(f"{left}{name}").bitwiseXOR(F.col(f"{right}{name}"))
        either = differs.bitwiseOR(F.shiftrightunsigned(differs, 1))
        same = F.bit_count(F.bitwise_not(either).bitwiseAND(F.lit(0x5555555555555555)))
        agree = same if agree is None else agree + same
    chance = 2.0 ** -BITS
    return (agree / MINIMA - chance) / (1 - chance)


class _Folder:
    """Tables of one run in the shared folder."""

    def __init__(self, docs: DataFrame):
        self.spark, self.path, self.count = docs.sparkSession, scratch_dir(docs.sparkSession, "neardup"), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def _confirmed(pairs: DataFrame, docs: DataFrame, folder: _Folder, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    sized = pairs.select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            held = pa.concat_arrays([batch.column(2), batch.column(3)])
            sets: list[np.ndarray] = []
            for block in texts.blocks(held):
                values, n = shingles(block, shingle)
                sets += np.split(values, np.cumsum(n)[:-1])
            good = np.zeros(rows, dtype=bool)
            for i in range(rows):
                x, y = sets[i], sets[rows + i]
                if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = len(x) + len(y) - len(np.union1d(x, y))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            at = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    left = docs.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = docs.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    joined = sized.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return folder.keep(joined.mapInArrow(run, "a bigint, b bigint"))


def connected(links: DataFrame, folder: _Folder) -> DataFrame:
    """(node, label): least node of the component, for nodes with links (large-star and small-star steps)."""
    edges = folder.keep(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(folder.keep(least), "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = folder.keep(large)
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = folder.keep(large.join(folder.keep(small), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                            .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now


def _merged(labels: DataFrame | None, links: DataFrame, folder: _Folder) -> DataFrame:
    """Labels after further links between their components."""
    if labels is None:
        return folder.keep(connected(links, folder))
    joined = connected(_labelled(links, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")), folder)
    moved = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))
    fresh = joined.join(labels, "node", "left_anti")
    return folder.keep(moved.unionByName(fresh.select("node", "label")))


def _labelled(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs with the labels of both sides; a node without links is its own label."""
    if labels is None:
        return pairs.withColumn("la", F.col("a")).withColumn("lb", F.col("b"))
    return (pairs.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
            .withColumn("la", F.coalesce("la", "a")).withColumn("lb", F.coalesce("lb", "b")))


def _texts_of(docs: DataFrame, hashes: DataFrame, folder: _Folder) -> DataFrame:
    """Id and text of the documents whose hashed id (``h``) is asked for, and a few others."""
    seen = docs.sparkSession.sparkContext.broadcast(bitmap(hashes, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array(np.flatnonzero(holds(seen.value, batch.column(2).to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["id", "text"])

    return folder.keep(docs.filter("id IS NOT NULL AND text IS NOT NULL").select("id", "text", F.xxhash64("id")).mapInArrow(
        run, "id bigint, text string"))


def _resolve(pairs: DataFrame, labels: DataFrame | None, docs: DataFrame, folder: _Folder, shingle: int,
             percent: int) -> DataFrame | None:
    """Confirm candidate pairs (a, b, e), the best of each document first; return the new labels."""
    if pairs.isEmpty():
        return labels
    involved = pairs.select(F.xxhash64("a").alias("h")).unionByName(pairs.select(F.xxhash64("b").alias("h")))
    held = _texts_of(docs, involved, folder)
    sides = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "e").unionByName(
        pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "e"))
    best = sides.groupBy("x").agg(F.max(F.struct("e", "y")).alias("top")).select("x", F.col("top.y").alias("y"))
    first = folder.keep(best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    links = _confirmed(first, held, folder, shingle, percent)
    if not links.isEmpty():
        labels = _merged(labels, links, folder)
    rest = folder.keep(_labelled(pairs.join(first, ["a", "b"], "left_anti"), labels).filter("la <> lb").select("a", "b"))
    if not rest.isEmpty():
        links = _confirmed(rest, held, folder, shingle, percent)
        if not links.isEmpty():
            labels = _merged(labels, links, folder)
    return labels


def _others(live: DataFrame, reps: DataFrame, docs: DataFrame, folder: _Folder, shingle: int,
            percent: int) -> DataFrame:
    """Candidate pairs (a, b, e) of different components among the members of mixed buckets.

    ``live``: bucket, id, label, inner (of the hub's component, to be compared with others
    only). A pair is compared in the first band it shares. Beside the estimate, each set
    has a bitmap of ``SLOTS`` hashed slots: two sets share at most as many shingles as
    slots, and one more for each slot that several of a set's own shingles take. That
    bound is exact, and refutes most pairs below the limit inside the join.
    """
    held = _texts_of(docs, live.select(F.xxhash64("id").alias("h")), folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch.column(1)):
                values, n = shingles(block, shingle)
                slots = np.zeros((len(n), SLOTS), dtype=bool)
                slots[np.repeat(np.arange(len(n)), n), (values >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)] = True
                words = np.packbits(slots, axis=1, bitorder="little").view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, block.high - block.low), pa.array(n, pa.int64()),
                     pa.array(n - slots.sum(axis=1), pa.int64()), *[pa.array(words[:, i]) for i in range(len(WORDS))]],
                    names=["id", "n", "spare", *WORDS])

    columns = ", ".join(f"{c} bigint" for c in ("id", "n", "spare", *WORDS))
    known = folder.keep(held.mapInArrow(run, columns).dropDuplicates(["id"]))
    signed = reps.select("id", *SIGNATURE, "bands").dropDuplicates(["id"])
    rows = folder.keep(live.join(known, "id").join(signed, "id").withColumn(
        "earlier", F.slice("bands", F.lit(1), F.array_position("bands", F.col("bucket")).cast("int") - 1)).drop("bands"))
    values = ["bucket", "id", "label", "inner", "n", "spare", "earlier", *SIGNATURE, *WORDS]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{name}_{c}") for c in values])

    shared = F.least("a_spare", "b_spare")
    for word in WORDS:
        shared = shared + F.bit_count(F.col(f"a_{word}").bitwiseAND(F.col(f"b_{word}")))
    total = F.col("a_n") + F.col("b_n")
    # 100 I >= p (na + nb - I), with the bound for I
    pairs = side(rows.filter("NOT inner"), "a").join(
        side(rows, "b"), (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_label") != F.col("b_label"))
        & (F.col("b_inner") | (F.col("a_id") < F.col("b_id")))
        & ((100 + percent) * F.least("a_n", "b_n") >= percent * total) & (estimate("a_", "b_") >= ESTIMATE)
        & ((100 + percent) * shared >= percent * total) & ~F.arrays_overlap("a_earlier", "b_earlier"))
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"),
                        estimate("a_", "b_").alias("e")).distinct()


def components(docs: DataFrame, shingle: int = 5, percent: int = PERCENT, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    folder = _Folder(docs)
    docs = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = folder.keep(_described(docs, shingle))
    digest = ["n", "d1", "d2"]
    filled = rows.filter("n > 0 AND id IS NOT NULL")
    classes = folder.keep(filled.groupBy(*digest).agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    # by id and digest: however many copies a class has, its key has the rows of one document
    reps = folder.keep(filled.join(classes.select(F.col("rep").alias("id"), *digest), ["id", *digest]).select(
        "id", *SIGNATURE, "bands"))
    members = reps.select("id", *SIGNATURE, F.explode("bands").alias("bucket"))
    hubs = folder.keep(members.groupBy("bucket").agg(
        F.min(F.col("id").bitwiseXOR(F.col("bucket"))).alias("least"), F.count("*").alias("size")).filter("size > 1").select(
        "bucket", F.col("least").bitwiseXOR(F.col("bucket")).alias("hub"), "size"))
    signed = folder.keep(hubs.join(
        reps.select(F.col("id").alias("hub"), *[F.col(s).alias(f"h{s}") for s in SIGNATURE]), "hub"))
    stars = folder.keep(members.join(
        signed, (members["bucket"] == signed["bucket"]) & (F.col("id") != F.col("hub")) & (estimate("", "h") >= ESTIMATE),
    ).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), estimate("", "h").alias("e")).distinct())
    labels = _resolve(stars, None, docs, folder, shingle, percent)

    # what is left to compare: members of a bucket that also holds another component
    met = members.select("id", "bucket").join(hubs.filter("size > 2").select("bucket", "hub"), "bucket").filter("id <> hub")
    if labels is not None:
        met = met.join(labels.select(F.col("node").alias("id"), "label"), "id", "left").join(
            labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub", "left")
        met = met.withColumn("label", F.coalesce("label", "id")).withColumn("hub_label", F.coalesce("hub_label", "hub"))
    else:
        met = met.withColumn("label", F.col("id")).withColumn("hub_label", F.col("hub"))
    met = folder.keep(met.select("bucket", "id", "label", (F.col("label") == F.col("hub_label")).alias("inner")))
    mixed = met.filter("NOT inner").select("bucket").distinct()
    live = folder.keep(met.join(mixed, "bucket", "left_semi"))
    if not live.isEmpty():
        others = _others(live, reps, docs, folder, shingle, percent)
        labels = _resolve(folder.keep(others.join(stars, ["a", "b"], "left_anti")), labels, docs, folder, shingle, percent)
    named = classes
    if labels is not None:
        named = classes.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn(
            "rep", F.coalesce("label", "rep")).drop("label")
    named = folder.keep(named)
    found = join_groups(filled.select("id", *digest), named, digest, "copies", filled.count())
    alone = rows.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("rep"))
    return found.select("id", "n", "rep").unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"))
