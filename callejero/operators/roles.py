"""Which column plays which role, decided from names alone (no data is read)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.dates import parse_timestamp
from callejero.functions.numbers import coerce_number


def named_like(columns: Iterable[str], keys: Iterable[str]) -> list[str]:
    """Columns whose lower-cased name contains any of ``keys``, in column order."""
    return [c for c in columns if any(k in c.lower() for k in keys)]


def first_like(columns: Iterable[str], keys: Iterable[str]) -> str | None:
    return next(iter(named_like(columns, keys)), None)


def last_like(columns: Iterable[str], keys: Iterable[str]) -> str | None:
    return next(reversed(named_like(columns, keys)), None)


def timestamp_columns(columns: Iterable[str], wide: bool = False) -> list[str]:
    return named_like(columns, K.TIMESTAMP_KEYS_WIDE if wide else K.TIMESTAMP_KEYS_NARROW)


def date_parts(columns: Iterable[str]) -> tuple[str, str, str] | None:
    """The (year, month, day) columns by exact name; all three or none."""
    by_name = {c.lower(): c for c in columns}
    parts = [
        next((by_name[n] for n in names if n in by_name), None)
        for names in (K.YEAR_NAMES, K.MONTH_NAMES, K.DAY_NAMES)
    ]
    return tuple(parts) if all(parts) else None


def coordinate_columns(columns: Iterable[str]) -> tuple[str, str] | None:
    """(latitude, longitude); the last match of each wins."""
    columns = list(columns)
    pair = last_like(columns, K.LATITUDE_KEYS), last_like(columns, K.LONGITUDE_KEYS)
    return pair if all(pair) else None


def name_column(columns: Iterable[str]) -> str | None:
    return first_like(columns, K.NAME_KEYS)


def address_column(columns: Iterable[str]) -> str | None:
    return last_like(columns, K.ADDRESS_KEYS)


def is_event_level(columns: Iterable[str], with_ranges: bool = False) -> bool:
    """False for aggregated tables: those without any date or time-of-day column.

    ``with_ranges`` also takes hour ranges and day columns as event-level.
    """
    columns = list(columns)
    hour_keys = K.HOUR_KEYS_RANGES if with_ranges else ["hora", "time"]
    date_keys = K.DATETIME_KEYS + (K.BUILD_DATE_KEYS if with_ranges else K.DATE_KEYS)
    return bool(named_like(columns, hour_keys) or named_like(columns, date_keys))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Names trimmed, lower case, blanks and dots as underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_").replace(".", "_") for c in df.columns])


def col(name: str) -> Column:
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """A column as zone-less timestamp: typed columns are cast, text is parsed."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return col(name).cast("timestamp_ntz")
    return parse_timestamp(col(name))


def as_number(df: DataFrame, name: str) -> Column:
    """A column as double: numeric columns are cast, text is parsed."""
    is_text = df.schema[name].dataType.typeName() == "string"
    return coerce_number(col(name)) if is_text else col(name).cast("double")


def parse_ratios(df: DataFrame, names: list[str]) -> DataFrame:
    """Share of values that parse as a date, one row, one column per candidate."""
    return df.agg(
        *[F.avg(as_timestamp(df, n).isNotNull().cast("double")).alias(n) for n in names]
    )


def usable_flags(df: DataFrame, names: list[str], threshold: float = 0.5) -> dict[str, Column]:
    """Per candidate a scalar: do more than ``threshold`` of its values parse?

    All candidates are profiled by one lazy aggregate that reads only those columns.
    """
    if not names:
        return {}
    ratios = parse_ratios(df, names).select(F.struct(*[col(n) for n in names]).alias("r")).scalar()
    return {
        n: F.coalesce(ratios.getField(n) > threshold, F.lit(False)) for n in names
    }
