"""Sorts, previews and best-per-group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.operators.joins import spread_key
from callejero.operators.roles import col


def sort_spread(df: DataFrame, *order: Column, cheap: bool = False) -> DataFrame:
    """Global sort with a tie-break, so that one repeated sort value (a date with a third
    of the rows, or the rows without any) is still split over many partitions.

    Range partitioning samples its input first. The exchange in front of it keeps that
    sample from running everything since the last exchange a second time; ``cheap`` says
    that there is little to run (a scan and a filter), and leaves one exchange.
    """
    tie = "__tie"
    rows = df.withColumn(tie, spread_key(df))
    return (rows if cheap else rows.repartition(tie)).orderBy(*order, tie).drop(tie)


def sort_by_timestamp(df: DataFrame, stamp: Column | None) -> DataFrame:
    """Ascending, rows without a timestamp last."""
    return df if stamp is None else sort_spread(df, stamp.asc_nulls_last())


def sort_by_first_date_column(df: DataFrame, cheap: bool = False) -> DataFrame:
    """Ascending by the first of the well-known date column names, if any is present."""
    name = next((n for n in K.SORT_DATE_NAMES if n in df.columns), None)
    return df if name is None else sort_spread(df, col(name).asc_nulls_last(), cheap=cheap)


def nearest(df: DataFrame, n: int, distance: str, key: str) -> DataFrame:
    return df.orderBy(distance, key).limit(n)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows of a total order (a top-k, never a full sort)."""
    return df.orderBy(*order).limit(n)


def best_link(links: DataFrame, page: str, score: str, position: str) -> DataFrame:
    """Per page the link with the lowest score, ties to the earlier one.

    A minimum over (score, position) combines before the shuffle, so a page with
    very many links costs no more than any other.
    """
    rest = [c for c in links.columns if c not in (page, score, position)]
    best = F.min(F.struct(score, position, *rest)).alias("best")
    return links.groupBy(page).agg(best).select(page, "best.*")
