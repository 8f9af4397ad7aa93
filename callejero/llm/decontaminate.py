"""Documents that hold passages of benchmark items, found by winnowing.

Texts are words of letters and digits with A-Z lower-cased. Of every ``window -
gram + 1`` neighbouring ``gram``-word hashes the least is a fingerprint, so two
texts that share ``window`` words in a row share a fingerprint inside them, at the
same place. Fingerprints of documents are joined with the distinct windows of the
items that have them, and each hit is extended word by word over the window; a
window that agrees marks its words. An item of fewer words is one window, found by
the hash of all its words.

However many items share a window, it is compared once. Windows with the same items
are one set, and a document gets each set's list of items once.

Before the join a bitmap of the item fingerprints, of fixed size whatever the
number of items, drops document fingerprints that no item has; it loses none.
The documents' candidates are written to the shared folder once, with a row
number, since they are read twice.

A null or empty text has no words and is never hit; a null or empty item has no
window. Repeated rows are judged each on its own, and rows that share an id each
give a row. Equal items are hit together. Empty tables give empty or clean
results. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero.llm import texts
from callejero.llm.bitmaps import bitmap, holds
from callejero.session import scratch_dir

WINDOW = 10
GRAM = 5
CANDIDATE = "array<struct<at:bigint,hash:bigint,size:int,context:string,lead:int>>"


def _winnowed(first: np.ndarray, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window, and how many words stand before its fingerprint: the first least hash."""
    starts, _ = texts.gram_positions(first, window)
    least = np.zeros(len(starts), dtype=np.int64)
    if not len(starts):
        return starts, least
    values = texts.grams(hashes, gram)
    best = values[starts]
    for k in range(1, window - gram + 1):
        other = values[starts + k]
        smaller = other < best
        best = np.where(smaller, other, best)
        least[smaller] = k
    return starts, least


def _key(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same words as a fingerprint and as a short item are different keys."""
    return texts.mixed(value + size.astype(np.int64).view(np.uint64)).view(np.int64)


def _marks(block: texts.Block, window: int, gram: int, short_sizes: list[int]):
    """Candidates of a block of documents: word position, hash and number of words."""
    found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
    hashes = texts.word_hashes(found)
    starts, least = _winnowed(found.first, hashes, window, gram)
    at = [np.unique(starts + least)]
    value, size = [texts.grams(hashes, gram)[at[0]]], [np.full(len(at[0]), gram)]
    for n in short_sizes:
        places, _ = texts.gram_positions(found.first, n)
        at.append(places)
        value.append(texts.grams(hashes, n)[places])
        size.append(np.full(len(places), -n))
    at, value, size = map(np.concatenate, (at, value, size))
    return found, at, _key(value, size), size


def _joined(block: texts.Block, found: texts.Words, low: np.ndarray, high: np.ndarray) -> list[str]:
    """The words from ``low`` to before ``high``, with a space between."""
    data = texts.LOWER[block.data]
    return [" ".join(data[s:e].tobytes().decode() for s, e in zip(found.starts[a:b], found.ends[a:b]))
            for a, b in zip(low.tolist(), high.tolist())]


def _rows(block: texts.Block, found: texts.Words, at, size, window: int, gram: int):
    """Text number, words around each candidate, and how many of them stand before it."""
    number = np.searchsorted(found.first, at, side="right") - 1
    reach = np.where(size > 0, window - gram, 0)
    low = np.maximum(at - reach, found.first[number])
    high = np.minimum(at + np.abs(size) + reach, found.first[number + 1])
    return number, _joined(block, found, low, high), at - low


def item_windows(items: DataFrame, item_key: str, text: str, window: int, gram: int) -> DataFrame:
    """item (as text), hash, size, words and lead (words before the fingerprint) of every window of every item."""
    source = items.select(F.col(item_key).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch.column(1)):
                found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
                hashes = texts.word_hashes(found)
                low, lead = _winnowed(found.first, hashes, window, gram)
                value, size = texts.grams(hashes, gram)[low + lead], np.full(len(low), gram)
                length = np.full(len(low), window)
                for n in range(1, window):
                    own = found.first[:-1][found.count == n]
                    low, lead = np.r_[low, own], np.r_[lead, np.zeros(len(own), dtype=np.int64)]
                    value, size = np.r_[value, texts.grams(hashes, n)[own]], np.r_[size, np.full(len(own), -n)]
                    length = np.r_[length, np.full(len(own), n)]
                number = np.searchsorted(found.first, low, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(number + block.low)), pa.array(_key(value, size)), pa.array(size, pa.int32()),
                     pa.array(_joined(block, found, low, low + length), pa.string()), pa.array(lead, pa.int32())],
                    names=["item", "hash", "size", "words", "lead"])

    return source.mapInArrow(run, "item string, hash bigint, size int, words string, lead int")


def _sets(windows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows with the number of their set of items; and the items of each set."""
    spark = windows.sparkSession
    windows.groupBy("hash", "size", "words", "lead").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn(
        "items_of", F.sha2(F.to_json("items"), 256)).write.parquet(f"{folder}/windows")
    known = spark.read.parquet(f"{folder}/windows")
    known.select("items_of", "items").dropDuplicates(["items_of"]).write.parquet(f"{folder}/sets")
    return known.drop("items"), spark.read.parquet(f"{folder}/sets")


def _document_candidates(docs: DataFrame, key: str, text: str, seen, short_sizes: list[int],
                         window: int, gram: int) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    struct = [("at", pa.int64()), ("hash", pa.int64()), ("size", pa.int32()),
              ("context", pa.string()), ("lead", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = seen.value
        for batch in batches:
            for block in texts.blocks(batch.column(1)):
                found, at, value, size = _marks(block, window, gram, short_sizes)
                known = holds(table, value)
                at, value, size = at[known], value[known], size[known]
                order = np.argsort(at, kind="stable")
                at, value, size = at[order], value[order], size[order]
                number, contexts, lead = _rows(block, found, at, size, window, gram)
                ends = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(found.count)))]) if len(at) \
                    else np.zeros(len(found.count) + 1)
                rows = pa.StructArray.from_arrays(
                    [pa.array(at - found.first[number]), pa.array(value), pa.array(size, pa.int32()),
                     pa.array(contexts, pa.string()), pa.array(lead, pa.int32())], fields=[pa.field(*f) for f in struct])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, block.high - block.low), pa.array(found.count, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)],
                    names=["key", "n_words", "candidates"])

    return source.mapInArrow(run, f"key {kind}, n_words bigint, candidates {CANDIDATE}")


def _extended(pairs: DataFrame) -> DataFrame:
    """Extend each candidate over the item's window; keep those whose words all agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("at", "context", "lead", "item_words", "item_lead")]
            kept, starts, ends = [], [], []
            for i, (at, mine, lead, theirs, item_lead) in enumerate(zip(*columns)):
                low, theirs = lead - item_lead, theirs.split(" ")
                if low >= 0 and mine.split(" ")[low:low + len(theirs)] == theirs:
                    kept.append(i)
                    starts.append(at - item_lead)
                    ends.append(at - item_lead + len(theirs))
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(at), batch.column("items_of").take(at), pa.array(starts, pa.int64()),
                 pa.array(ends, pa.int64())], names=["row", "items_of", "low", "high"])

    return pairs.select("row", "items_of", "at", "context", "lead", "item_words", "item_lead").mapInArrow(
        run, "row bigint, items_of string, low bigint, high bigint")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id",
                  text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: key, n_words, n_hit, spans (array of low, high) and items (sorted ids as text)."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "winnowing")
    windows, sets = _sets(item_windows(items, item_key, text, window, gram), folder)
    # at most window - 1 sizes
    short_sizes = sorted(-r["size"] for r in windows.filter("size < 0").select("size").distinct().collect())
    seen = spark.sparkContext.broadcast(bitmap(windows, "hash"))
    _document_candidates(docs, key, text, seen, short_sizes, window, gram).withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(f"{folder}/documents")
    rows = spark.read.parquet(f"{folder}/documents")
    theirs = windows.select("hash", "size", "items_of", F.col("words").alias("item_words"), F.col("lead").alias("item_lead"))
    _extended(rows.select("row", F.inline("candidates")).join(theirs, ["hash", "size"])).write.parquet(f"{folder}/hits")
    found = spark.read.parquet(f"{folder}/hits")
    named = found.select("row", "items_of").distinct().join(sets, "items_of").groupBy("row").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = found.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("spans")).join(named, "row")
    nothing = "array<struct<low:bigint,high:bigint>>"
    merged = F.aggregate(
        F.array_sort("spans"), F.array().cast(nothing),
        lambda done, span: F.when(
            (F.size(done) > 0) & (span["low"] <= F.element_at(done, -1)["high"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["low"].alias("low"),
                F.greatest(F.element_at(done, -1)["high"], span["high"]).alias("high")))),
        ).otherwise(F.concat(done, F.array(span))))
    return rows.select("row", "key", "n_words").join(hits, "row", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce(merged, F.array().cast(nothing)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).select(key, "n_words", F.aggregate("spans", F.lit(0).cast("bigint"),
                                         lambda n, s: n + s["high"] - s["low"]).alias("n_hit"), "spans", "items")
