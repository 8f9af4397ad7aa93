"""Shards whose every cut has the mixture of the sources (proportional stratified interleaving).

Rows are shuffled within their source by a seeded hash and ranked; row ``r`` of
``n`` stands at the fraction ``(r - 1/2) / n`` of its source. All rows sorted by
that fraction interleave the sources in proportion, and equal cuts of that order
are the shards: sizes in rows differ by one at most.

Ranks are taken without ever bringing a source or the whole table into one task:
rows go by their order value into bins of about ``ROWS_PER_BIN`` rows (at least
``BINS``), the counts of the bins are summed up on a table of counts, and only the
rows of a bin are ranked together. The order value of a row is uniform, so the bins
are even whatever share one source has.

A null source is a source of its own; a null text has the size of an empty one.
Rows equal in id and text are ranked in any order, which gives the same rows. An
empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096
ROWS_PER_BIN = 20_000


def ranked(rows: DataFrame, groups: list[str], bin_: str, order: list[str], rank: str) -> DataFrame:
    """Add the 1-based rank within ``groups``; ``bin_`` must be a coarse form of the first order column."""
    counts = rows.groupBy(*groups, bin_).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*groups).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, bin_, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*groups, bin_).orderBy(*order)
    return (rows.join(offsets, [*groups, bin_])
            .withColumn(rank, F.col("_before") + F.row_number().over(within)).drop("_before"))


def interleave(df: DataFrame, shards: int, seed: str, key: str = "doc_id", source: str = "source",
               text: str = "text", bins: int | None = None) -> DataFrame:
    """One row per row of ``df``: key, size, text_crc32, shard, slot."""
    bins = bins or max(BINS, df.count() // ROWS_PER_BIN)
    value = F.coalesce(F.col(text), F.lit(""))
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = df.select(
        F.col(key).alias("_key"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_source"),
        mixed.alias("_order"), (F.octet_length(value).cast("bigint") + 1).alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"),
    ).withColumn("_bin", (F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") * bins / 2**32).cast("int"))
    rows = ranked(rows, ["_source"], "_bin", ["_order", "_key", "text_crc32", "size"], "_rank")
    sizes = df.groupBy(F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_source")).agg(
        F.count("*").alias("_n"))
    rows = rows.join(sizes, "_source").withColumn("_at", (F.col("_rank") - F.lit(0.5)) / F.col("_n"))
    rows = rows.withColumn("_bin", (F.col("_at") * bins).cast("int")).withColumn("_all", F.lit(0))
    rows = ranked(rows, ["_all"], "_bin", ["_at", "_source", "_rank"], "_place")
    total = df.agg(F.count("*").alias("_total")).scalar()
    placed = rows.select(F.col("_key").alias(key), "size", "text_crc32",
                         (F.col("_place") - 1).alias("_place"), total.alias("_total"))
    # shard s begins at the least place p with p * shards / total >= s
    return placed.select(
        key, "size", "text_crc32", F.expr(f"CAST(_place * {shards} DIV _total AS INT)").alias("shard"),
        F.expr(f"_place - ((_place * {shards} DIV _total) * _total + {shards - 1}) DIV {shards}").alias("slot"))
