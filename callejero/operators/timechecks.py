"""Stamps that don't fit: out of order, after a gap, overlapping with earlier ones.

All three look at the highest end of what came before in the same source. A source with a
third of all rows must not be one task, so the rows are ranged by source and order over
partitions, the maximum runs inside each piece of a source, and what a piece inherits
from the pieces before it comes from a table with one row per piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callejero.operators.joins import spread_key
from callejero.session import scratch_dir


def with_earlier_max(df: DataFrame, by: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add the maximum of ``value`` over the rows of the same source that come before, null for the first.

    Rows equal in ``order`` follow each other in any order; null sources are one source.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "earlier")
    keys = [F.asc_nulls_first(by), *[F.asc_nulls_first(c) for c in order]]
    columns = df.columns
    rows = df.withColumns({"__tie": spread_key(df), "__value": value})
    # the tie keeps a source with one stamp only from being a single range
    ranged = rows.repartitionByRange(*keys, F.asc("__tie")).withColumn("__piece", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.parquet(path)
    inside = Window.partitionBy(by, "__piece").orderBy(*keys[1:], "__tie").rowsBetween(Window.unboundedPreceding, -1)
    # one row per source and partition it reaches into
    pieces = rows.groupBy(by, "__piece").agg(F.max("__value").alias("__most"))
    before = Window.partitionBy(by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(F.col(by).alias("__by"), F.col("__piece").alias("__of"), F.max("__most").over(before).alias("__inherited"))
    found = rows.withColumn("__own", F.max("__value").over(inside)).join(
        pieces, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__piece") == F.col("__of")))
    return found.withColumn(name, F.greatest("__own", "__inherited")).select(*[F.col(f"`{c}`") for c in columns], name)


def out_of_order(df: DataFrame, by: str, arrival: list[str], stamp: str) -> DataFrame:
    """Add ``latest_before`` (of the rows that arrived earlier) and ``out_of_order`` (the stamp is before it)."""
    found = with_earlier_max(df, by, arrival, F.col(stamp), "latest_before")
    return found.withColumn("out_of_order", F.coalesce(F.col(stamp) < F.col("latest_before"), F.lit(False)))


def gaps_and_overlaps(df: DataFrame, by: str, start: str, end: Column, limit_s: int, key: str) -> DataFrame:
    """Add ``gap_s`` (seconds from the latest end before to the start, if over the limit), ``overlap`` (it starts before that
    end) and ``island`` (rows without a gap between them are one; the first of each has its start, others null).

    Rows without a start are left out; a null end counts as the start.
    """
    rows = df.filter(F.col(start).isNotNull()).withColumn("__end", F.greatest(F.coalesce(end, F.col(start)), F.col(start)))
    found = with_earlier_max(rows, by, [start, key], F.col("__end"), "ended_before")
    since = (F.unix_micros(start) - F.unix_micros("ended_before")) / 1_000_000
    return found.withColumns({
        "gap_s": F.when(since > limit_s, since),
        "overlap": F.coalesce(F.col(start) < F.col("ended_before"), F.lit(False)),
        "island": F.when(F.col("ended_before").isNull() | (since > limit_s), F.col(start)),
    }).drop("__end")


def consistency(df: DataFrame, by: str, key: str, stamp: str, seconds: Column, limit_s: int) -> DataFrame:
    """One row per source: rows, stamps out of order of arrival, gaps over the limit, the longest, overlaps, islands."""
    df = df.withColumn(stamp, F.col(stamp).cast("timestamp"))
    late = out_of_order(df, by, [key], stamp).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("out_of_order").alias("n_out_of_order"),
        F.count_if(F.col(stamp).isNull()).alias("n_undated"))
    end = F.timestamp_micros(F.unix_micros(stamp) + (seconds * 1_000_000).cast("bigint"))
    spans = gaps_and_overlaps(df, by, stamp, end, limit_s, key).groupBy(by).agg(
        F.count("gap_s").alias("n_gaps"), F.max("gap_s").alias("longest_gap_s"),
        F.count_if("overlap").alias("n_overlaps"), F.count("island").alias("n_islands"))
    spans = spans.withColumnRenamed(by, "__by")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_gaps", "n_overlaps", "n_islands")}
    return late.join(spans, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by").withColumns(zero)
