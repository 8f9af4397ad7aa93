"""Best-effort timestamp of a row from whatever date and hour columns a table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.clock import time_midpoint
from callejero.functions.dates import text_date_and_hour
from callejero.operators.roles import as_timestamp, col, first_like, named_like

NO_TIMESTAMP = "timestamp_ntz"


def split_timestamp(df: DataFrame) -> Column:
    """Date column plus midpoint of the hour column; a missing hour counts as 00:00."""
    date_name = first_like(df.columns, K.BUILD_DATE_KEYS)
    hour_name = first_like(df.columns, K.HOUR_KEYS_RANGES)
    if not date_name:
        return F.lit(None).cast(NO_TIMESTAMP)
    stamp = as_timestamp(df, date_name)
    if not hour_name:
        return stamp
    minute = F.coalesce(time_midpoint(col(hour_name)), F.lit(0))
    day = stamp.cast("date").cast(NO_TIMESTAMP)
    return day + F.make_dt_interval(F.lit(0), F.lit(0), minute)


def has_rows(df: DataFrame) -> Column:
    """Scalar: is there any row? Every task stops at its first one."""
    return df.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)) > 0).scalar()


def build_ts(df: DataFrame) -> Column:
    """Timestamp expression for ``df``.

    The first datetime-like column with any parsable value serves all rows; only
    when there is none are date and hour columns combined. Whether a column has one
    depends on the data; each candidate is asked by a lazy existence test that
    stops at the first value that parses.
    """
    stamp = split_timestamp(df)
    for name in reversed(named_like(df.columns, K.DATETIME_KEYS)):
        parsed = as_timestamp(df, name)
        stamp = F.when(has_rows(df.where(parsed.isNotNull())), parsed).otherwise(stamp)
    return stamp


def serving_column(df: DataFrame) -> str | None:
    """The column that dates the rows in :func:`build_ts`, if it has any value: the first datetime-like one, else the
    date column. If it has none, all its values are null."""
    named = named_like(df.columns, K.DATETIME_KEYS)
    return named[0] if named else first_like(df.columns, K.BUILD_DATE_KEYS)


def emergency_sort_ts(df: DataFrame) -> Column | None:
    """Sort key of the emergency job: a datetime column, else date + hour text, else date."""
    direct = first_like(df.columns, K.DATETIME_KEYS)
    if direct:
        return as_timestamp(df, direct)
    date_name = first_like(df.columns, K.DATE_KEYS)
    hour_name = first_like(df.columns, ["hora", "time"])
    if not date_name:
        return None
    if not hour_name:
        return as_timestamp(df, date_name)
    return text_date_and_hour(col(date_name), col(hour_name))
