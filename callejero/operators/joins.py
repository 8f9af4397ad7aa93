"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32


def spread_key(df: DataFrame) -> Column:
    """A hash that also tells apart exact copies of a row in different partitions.

    The partition number is stable when a task is retried, unlike a random number.
    """
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())


def spread_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Inner or left-semi join of a possibly skewed ``big`` with a ``small`` side of unique keys.

    Rows of ``big`` are spread over ``salts`` buckets by :func:`spread_key` and the
    small side is repeated once per bucket, so a hot key is shared by many tasks
    whichever way the join runs. Spark still broadcasts ``small`` when its measured
    size is under the session threshold.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("spread_join supports inner and left_semi")
    salt = "__salt"
    left = big.withColumn(salt, F.pmod(spread_key(big), F.lit(salts)).cast("int"))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, salt], how).drop(salt)


def left_join_hot_right(
    left: DataFrame, right: DataFrame, on: list[str], salts: int = SALTS
) -> DataFrame:
    """Left outer join where ``left`` has unique keys and ``right`` may be skewed.

    Adaptive execution cannot split the right side of a left outer join. So the right
    rows are spread over ``salts`` buckets, and a left row is repeated once per bucket
    if its key occurs on the right at all (the distinct right keys combine before
    their shuffle), else kept once. ``left`` is computed a single time.
    """
    salt, known, hit = "__salt", "__known", "__hit"
    keys = right.select(*on).distinct().withColumn(known, F.lit(True))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    buckets = F.when(F.col(known), every).otherwise(F.array(F.lit(0)))
    repeated = left.join(keys, on, "left").withColumn(salt, F.explode(buckets))
    spread = right.withColumn(
        salt, F.pmod(spread_key(right), F.lit(salts)).cast("int")
    ).withColumn(hit, F.lit(True))
    return (
        repeated.join(spread, [*on, salt], "left")
        .where(F.col(hit).isNotNull() | F.col(known).isNull())
        .drop(salt, known, hit)
    )
