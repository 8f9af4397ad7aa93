"""Joins of many rows with one row per group, where a group may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a group with one row in so many is hot; there are at most so many hot groups
ONE_IN = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Inner join; ``groups`` has unique keys, and in ``size`` how many of the ``total`` rows each has.

    Hot groups, at most ``ONE_IN`` of them, are broadcast, so their rows stay where they are;
    the rows of all others are joined by a shuffle in which no key has more than one in
    ``ONE_IN`` rows.
    """
    hot = groups.filter(F.col(size) * ONE_IN >= max(total, 1)).limit(ONE_IN)
    cold = groups.filter(F.col(size) * ONE_IN < max(total, 1))
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return rows.join(F.broadcast(hot), on).unionByName(rest)
