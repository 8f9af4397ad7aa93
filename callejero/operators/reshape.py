"""Unions of drifting tables, fallbacks, first-source-wins and wide-to-long."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.text import BLANKS
from callejero.operators.joins import spread_join
from callejero.operators.roles import col
from callejero.session import written


def union_drifting(parts: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; absent columns are null, clashing types become text.

    Names that differ only in case are one column, spelled as the first table has it.
    """
    types: dict[str, set[str]] = {}
    spelled: dict[str, str] = {}
    for part in parts:
        for name, kind in part.dtypes:
            types.setdefault(name.lower(), set()).add(kind)
            spelled.setdefault(name.lower(), name)
    clashing = {n for n, kinds in types.items() if len(kinds) > 1}

    def aligned_column(name: str) -> Column:
        kept = col(name).cast("string") if name.lower() in clashing else col(name)
        return kept.alias(spelled[name.lower()])

    aligned = [
        p.select(*[aligned_column(c) for c in p.columns])
        if any(c.lower() in clashing or spelled[c.lower()] != c for c in p.columns)
        else p
        for p in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed null columns for the names ``df`` lacks."""
    absent = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def only_if_empty(fallback: DataFrame, primary: DataFrame) -> DataFrame:
    """``fallback`` when ``primary`` has no row, else nothing. No count, no join:
    one lazy existence test that stops at the first row found."""
    return fallback.where(~primary.exists())


def first_nonempty(candidates: DataFrame, group: str, rank: str) -> DataFrame:
    """Per group keep the rows of the lowest rank that has any row."""
    winners = candidates.groupBy(group).agg(F.min(rank).alias(rank))
    return spread_join(candidates, winners, [group, rank], "left_semi")


def first_with_rows(candidates: Iterable[DataFrame]) -> DataFrame | None:
    """The first of some tables that has rows (the last, if none has), written once to the shared folder and read back.

    Whether a table has rows is in the footers of what was written; tables behind the
    one found are never asked for.
    """
    found = None
    for df in candidates:
        found = written(df, "candidate")
        if not found.isEmpty():
            break
    return found


def tag_source(df: DataFrame, first: bool = False, **tags: Column | str) -> DataFrame:
    """Provenance columns as literals, at the end or (``first``) in front.

    A column of the same name (in any case) already present is kept as ``<name>_src``.
    """
    for name in tags:
        if any(c.lower() == name.lower() for c in df.columns):
            df = df.withColumnRenamed(name, f"{name}_src")
    made = [(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in tags.items()]
    return df.select(*made, "*") if first else df.select("*", *made)


def fill_sentinel(df: DataFrame, sentinel: str = "NA", but: str | None = None) -> DataFrame:
    """All columns as text; null, NaN and blank cells become the sentinel. ``but`` stays as it is."""
    cells = []
    for name, kind in df.dtypes:
        if name == but:
            cells.append(col(name))
            continue
        text = col(name).cast("string")
        missing = col(name).isNull()
        if kind in ("double", "float"):
            missing = missing | F.isnan(col(name))
        elif kind == "string":
            missing = missing | (F.btrim(col(name), F.lit(BLANKS)) == "")
        cells.append(F.when(missing, F.lit(sentinel)).otherwise(text).alias(name))
    return df.select(*cells)


def project_with_default(
    df: DataFrame, fields: dict[str, str], default: str = "N/D"
) -> list[Column]:
    """Output columns from source keys; a null or absent key gives the default."""
    return [
        (F.coalesce(col(key).cast("string"), F.lit(default)) if key in df.columns
         else F.lit(default)).alias(name)
        for name, key in fields.items()
    ]


def snapshot_to_long(df: DataFrame) -> DataFrame:
    """One row per snapshot and pollutant with value, raw text and unit."""
    def known(c: Column) -> Column:
        return F.when(c != "NA", c)

    rows = [
        F.struct(
            F.lit(p).alias("pollutant"),
            known(col(f"{p}_ugm3")).try_cast("double").alias("acc_value_ugm3"),
            known(col(f"{p}_raw")).alias("acc_raw"),
            known(col(f"{p}_unit")).alias("acc_unit"),
        )
        for p in K.SNAPSHOT_POLLUTANTS
    ]
    return df.select("fecha", "aqi", "aqi_category", F.inline(F.array(*rows))).select(
        F.col("fecha").try_cast("date").alias("fecha"),
        "pollutant", "acc_value_ugm3", "acc_raw", "acc_unit", "aqi", "aqi_category",
    )


def ordered_distinct(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys with the position each was first seen at."""
    return df.groupBy(key).agg(F.min(position).alias(position))


def preferred_first(df: DataFrame, preferred: list[str]) -> DataFrame:
    """Known columns in their fixed order, the rest after them."""
    head = [c for c in preferred if c in df.columns]
    return df.select(*[col(c) for c in head + [c for c in df.columns if c not in preferred]])
