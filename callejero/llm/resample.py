"""Importance resampling towards a target: hashed n-gram features by prefix CRCs.

Words (A-Z lower-cased, letters and digits) joined by one space are a text's
normal form. It is scanned once, and the running CRC-32 after each word is kept.
The CRC of any run of words follows from two of these prefixes: that before the
run is shifted by the run's length (a linear map over GF(2), looked up by byte)
and cancelled out of that behind it. So all features of one to ``LONGEST`` words
cost a few table lookups each, however many words they share.

A feature's bucket is its CRC modulo ``BUCKETS``. One pass counts the buckets of
the corpus and of the target (sums of fixed size, the only thing the driver
sees); a bucket's gain is 1000 times the log of its smoothed share in the target
over that in the corpus. A second pass adds the gains of each text to a Gumbel
variable drawn from its id, and the texts of the highest sums are the sample: a
draw without replacement in proportion to the weights. Ranks come from one range
exchange, the row numbers inside its partitions and their counts.

Null and empty texts have no features and weight 0; a null id draws like the
empty text. Rows that tie in score and id (copies of a row) are ranked in any
order, and their ties are spread over tasks. With an empty target or corpus the
smoothing alone decides. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callejero.llm import texts
from callejero.session import scratch_dir

BUCKETS = 10_000
LONGEST = 3
POLYNOMIAL = 0xEDB88320
#: shifts of up to so many bytes have tables of their own; longer ones are composed
NEAR = 128
ALL_ONES = np.uint32(0xFFFFFFFF)
PIECE = re.compile(rb" [^ ]+")
ROW_BITS = 33   # monotonically_increasing_id: partition number above, row number below


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


BYTE = _byte_table()


def _moved(state: np.ndarray) -> np.ndarray:
    """A CRC register after one zero byte."""
    return BYTE[state & np.uint32(255)] ^ (state >> np.uint32(8))


def _near_tables() -> np.ndarray:
    """For each shift below ``NEAR`` and each byte of the register: what that byte alone becomes."""
    tables = np.empty((NEAR, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for length in range(1, NEAR):
        tables[length] = _moved(tables[length - 1])
    return tables


SHIFTS = _near_tables()


def _apply(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    """A linear map given by its four byte tables."""
    return (table[0][state & np.uint32(255)] ^ table[1][(state >> np.uint32(8)) & np.uint32(255)]
            ^ table[2][(state >> np.uint32(16)) & np.uint32(255)] ^ table[3][state >> np.uint32(24)])


def shifted(state: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC registers after ``lengths`` zero bytes each."""
    near = (lengths % NEAR).astype(np.int64) * 1024
    flat = SHIFTS.ravel()
    out = flat[near + (state & np.uint32(255))]
    for byte in (1, 2, 3):
        out ^= flat[near + 256 * byte + ((state >> np.uint32(8 * byte)) & np.uint32(255))]
    far = lengths // NEAR
    if far.any():
        step = _apply(SHIFTS[NEAR // 2], SHIFTS[NEAR // 2])   # NEAR bytes: the map of half of it, twice
        while far.any():
            odd = np.flatnonzero(far & 1)
            out[odd] = _apply(step, out[odd])
            far = far >> 1
            step = _apply(step, step)
    return out


def _running(crc: int, piece: bytes) -> int:
    return zlib.crc32(piece, crc)


def ngram_crcs(found: texts.Words, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: the first words of all runs of that many words of one text, and their CRC-32."""
    count = len(found.starts)
    lengths = found.ends - found.starts
    # the normal form of the block's texts, with a space before each word
    line = np.full(len(found.letters) + count, 32, dtype=np.uint8)
    line[np.arange(len(found.letters)) + np.repeat(np.arange(count), lengths) + 1] = found.letters
    behind = np.fromiter(accumulate(PIECE.findall(line.tobytes()), _running, initial=0), dtype=np.uint32, count=count + 1)
    stop = np.cumsum(lengths + 1)
    # the prefix before a word is the one behind the word before it and a space
    state = behind[:-1] ^ ALL_ONES
    before = (BYTE[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))) ^ ALL_ONES
    for size in range(1, longest + 1):
        at, _ = texts.gram_positions(found.first, size)
        last = at + size - 1
        length = stop[last] - (stop[at] - lengths[at])
        yield at, behind[1:][last] ^ shifted(before[at], length)


def _sums(rows: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for block in texts.blocks(batch.column(0)):
                for _, crcs in ngram_crcs(texts.words(block, texts.LETTERS_DIGITS, lower=True), longest):
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    found = rows.select(F.col(text)).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, dtype=np.int64)
    out[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in whole thousandths."""
    size, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_corpus + size) / ((s + 1) * (all_target + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def gumbel(seed: str, key: str) -> int:
    """A standard Gumbel variable in whole thousandths, drawn from a key."""
    drawn = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: str = "42", key: str = "doc_id", text: str = "text",
           longest: int = LONGEST) -> DataFrame:
    """key, n_words, n_features, weight and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for block in texts.blocks(batch.column(2)):
                found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
                owner, rows = found.text, block.high - block.low
                weight, features = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
                for at, crcs in ngram_crcs(found, longest):
                    # whole numbers far below 2 ** 53, so the sums of doubles are exact
                    weight += np.bincount(owner[at], weights=gain[crcs % np.uint32(len(gain))], minlength=rows).astype(np.int64)
                    features += np.bincount(owner[at], minlength=rows)
                names = batch.column(1).slice(block.low, rows).to_pylist()
                noise = np.array([gumbel(seed, name or "") for name in names], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, rows), pa.array(found.count, pa.int64()), pa.array(features),
                     pa.array(weight), pa.array(weight + noise)],
                    names=["key", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(key).cast("string").alias("name"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: str = "42",
             key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST,
             buckets: int = BUCKETS) -> DataFrame:
    """All rows with their weight and score, and the rank of those that are drawn (null for the others)."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "resample")
    gain = gains(_sums(docs, text, longest, buckets), _sums(target, target_text, longest, buckets))
    scores(docs, gain, seed, key, text, longest).write.parquet(f"{folder}/scores")
    scored = spark.read.parquet(f"{folder}/scores")
    eligible = F.col("n_words") >= least_words
    # the row number as the last key spreads copies of a row over partitions
    numbered = scored.filter(eligible).withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("score"), F.asc_nulls_first("key"), F.asc("_tie")]
    numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn(
        "_row", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted")
    rows = spark.read.parquet(f"{folder}/sorted").withColumn("_part", F.shiftright("_row", ROW_BITS))
    # one row per partition of the exchange
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                         F.expr(f"{percent} * sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING "
                                f"AND UNBOUNDED FOLLOWING) DIV 100").alias("_drawn"))
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    columns = [F.col("key").alias(key), "n_words", "n_features", "weight", "score"]
    drawn = rows.join(parts, "_part").select(*columns, F.when(place <= F.col("_drawn"), place).alias("rank"))
    return drawn.unionByName(scored.filter(~eligible).select(*columns, F.lit(None).cast("bigint").alias("rank")))
