"""Row filters: date windows, hours, places, distance and event level.

A :class:`Test` is a condition plus the parsed values it looks at. :func:`keep`
computes every value once per row and then filters, instead of parsing a cell
anew for each comparison. Null counts as false. ``stored`` is a condition on stored
columns that every passing row fulfils; it is there for the scan to prune by.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.clock import stamp_code, time_midpoint, to_hour_minute
from callejero.functions.dates import (
    date_argument, date_from_parts, months_before, within_months,
)
from callejero.functions.geo import haversine_km, in_bounding_box
from callejero.functions.text import fold_literal, fold_text
from callejero.operators import roles
from callejero.operators.roles import as_timestamp, col
from callejero.operators.timestamps import build_ts

STAMP = "__ts"
PASSED = "__passed"


@dataclass(frozen=True)
class Test:
    mask: Column
    values: dict[str, Column] = field(default_factory=dict)
    stored: Column | None = None


def any_of(masks: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(m, F.lit(False)) for m in masks], F.lit(False))


def all_of(masks: list[Column]) -> Column:
    """AND of masks, null as false."""
    return reduce(lambda a, b: a & b, [F.coalesce(m, F.lit(False)) for m in masks], F.lit(True))


def bind(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with extra columns that are computed exactly once per row.

    The one-row ``inline`` keeps the optimizer from copying the expressions into
    every place a filter above mentions them, as it does with a plain projection.
    """
    if not values:
        return df
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))


def keep(
    df: DataFrame, *tests: Test, carry: dict[str, str] | None = None, funnel: Observation | None = None
) -> DataFrame:
    """Rows that pass every test; ``carry`` keeps parsed values under new names.

    What a test says of stored columns goes first, where it reaches the scan. ``funnel``
    counts the rows while an action runs: ``n_rows`` of the table and ``n_1``, ``n_2``, ...
    left after each test in turn. It has to see all rows, so nothing is pruned then.
    """
    values = {name: value for test in tests for name, value in test.values.items()}
    for test in tests:
        if test.stored is not None and funnel is None:
            df = df.where(test.stored)
    bound = bind(df, values)
    if funnel is None:
        passing = bound.where(all_of([test.mask for test in tests]))
    else:
        # how many tests a row passes in turn; a mask may ask other tables, which a metric may not
        passed = F.lit(len(tests))
        for n in range(len(tests) - 1, -1, -1):
            passed = F.when(~F.coalesce(tests[n].mask, F.lit(False)), n).otherwise(passed)
        counted = bound.withColumn(PASSED, passed)
        left = [F.count_if(F.col(PASSED) >= n).alias(f"n_{n}") for n in range(1, len(tests) + 1)]
        passing = counted.observe(funnel, F.count(F.lit(1)).alias("n_rows"), *left).where(F.col(PASSED) == len(tests))
    kept = [F.col(value).alias(name) for value, name in (carry or {}).items()]
    return passing.select(*[col(c) for c in df.columns], *kept) if values or funnel else passing


# --- dates --------------------------------------------------------------------

def stored_window(df: DataFrame, names: list[str], first: Column, last: Column) -> Column | None:
    """Some of the typed columns is dated in [first, last]; None if one of them is text.

    A plain comparison of the stored value, which a Parquet scan prunes by.
    """
    ranges = []
    for name in names:
        kind = df.schema[name].dataType.typeName()
        if kind not in ("date", "timestamp", "timestamp_ntz"):
            return None
        until = col(name) <= last if kind == "date" else (
            col(name) < F.date_add(last, 1).cast(df.schema[name].dataType))
        ranges.append((col(name) >= first.cast(df.schema[name].dataType)) & until)
    return reduce(lambda a, b: a | b, ranges) if ranges else None


def date_test(df: DataFrame, day: dt.date, months: int) -> Test:
    """In [day - months, day] by any usable date column or by year/month/day parts.

    Columns where at most half of the values parse do not take part. Without
    any date column nothing passes.
    """
    names = roles.timestamp_columns(df.columns)
    usable = roles.usable_flags(df, names)
    values = {f"__d{i}": as_timestamp(df, n).cast("date") for i, n in enumerate(names)}
    masks = [
        usable[n] & within_months(F.col(f"__d{i}"), day, months) for i, n in enumerate(names)
    ]
    if parts := roles.date_parts(df.columns):
        values["__parts"] = date_from_parts(*[col(p) for p in parts])
        masks.append(within_months(F.col("__parts"), day, months))
    stored = None if parts else stored_window(df, names, months_before(day, months), F.lit(day))
    return Test(any_of(masks), values, stored)


def date_window(
    df: DataFrame, day: str | dt.date, months: int = K.MONTHS_BACK_ACCIDENTS
) -> DataFrame:
    return keep(df, date_test(df, date_argument(day), months))


def date_or_undated_test(
    stamp: Column, day: dt.date, months: int, df: DataFrame | None = None, name: str | None = None
) -> Test:
    """In the window, or without a timestamp at all.

    ``name`` is the column of ``df`` that dates the rows if it has a value; where it is a
    stored date or timestamp, the scan prunes by it.
    """
    mask = within_months(F.col(STAMP).cast("date"), day, months) | F.col(STAMP).isNull()
    stored = None if name is None else stored_window(df, [name], months_before(day, months), F.lit(day))
    return Test(mask, {STAMP: stamp}, None if stored is None else stored | col(name).isNull())


def date_window_keep_null(
    df: DataFrame, stamp: Column | str, day: str | dt.date, months: int = K.MONTHS_BACK
) -> DataFrame:
    """In the window by ``stamp``, an expression or the name of a column, or undated."""
    day, name = date_argument(day), None
    if isinstance(stamp, str):
        name, stamp = stamp, as_timestamp(df, stamp)
    return keep(df, date_or_undated_test(stamp, day, months, df, name))


def first_date(df: DataFrame) -> Column:
    """Date of the first date-like column, else of the year/month/day parts, else null."""
    name = roles.first_like(df.columns, K.TIMESTAMP_KEYS_NARROW)
    if name:
        return as_timestamp(df, name).cast("date")
    if parts := roles.date_parts(df.columns):
        return date_from_parts(*[col(p) for p in parts])
    return F.lit(None).cast("date")


def last_n_days(df: DataFrame, end: str | dt.date, days: int, name: str = "fecha") -> DataFrame:
    """Rows dated in [end - days, end]; ``days`` is at least 1."""
    if days < 1:
        raise ValueError("the period must be at least one day")
    end = date_argument(end)
    day = as_timestamp(df, name).cast("date")
    first, last = F.date_sub(F.lit(end), days), F.lit(end)
    stored = stored_window(df, [name], first, last)
    return keep(df, Test(F.col("__day").between(first, last), {"__day": day}, stored))


def row_time_test(
    df: DataFrame, day: dt.date | None, months: int, hour: tuple[int, int] | None
) -> Test:
    """The emergency rule: some time column matches, and the row's date agrees.

    With date and hour both given, the timestamp built from the row must match
    both. With a date only, some time column must be in the window and the first
    parsable date column, if any, too. With an hour only, the hour of any time
    column counts, be it a full timestamp or an hour text.
    """
    names = roles.timestamp_columns(df.columns, wide=True)
    if day and hour:
        inside = within_months(F.col(STAMP).cast("date"), day, months)
        return Test(inside & (F.hour(STAMP) == hour[0]), {STAMP: build_ts(df)})
    if day:
        values = {f"__d{i}": as_timestamp(df, n).cast("date") for i, n in enumerate(names)}
        found = any_of([within_months(F.col(d), day, months) for d in values])
        dated = [f"__d{i}" for i, n in enumerate(names) if roles.named_like([n], K.DATE_KEYS)]
        if dated:
            values["__first"] = F.coalesce(
                *[as_timestamp(df, names[int(d[3:])]).cast("date") for d in dated]
            )
            found &= F.coalesce(within_months(F.col("__first"), day, months), F.lit(True))
        return Test(found, values, stored_window(df, names, months_before(day, months), F.lit(day)))
    if hour:
        hours = [
            F.coalesce(stamp_code(as_timestamp(df, n)), to_hour_minute(col(n))) for n in names
        ]
        values = {f"__h{i}": code for i, code in enumerate(hours)}
        return Test(any_of([F.floor(F.col(h) / 100) == hour[0] for h in values]), values)
    return Test(F.lit(True))


# --- hours --------------------------------------------------------------------

def hour_exact_test(df: DataFrame, hour: tuple[int, int]) -> Test:
    """Exact HH:MM per hour column; a column without any exact row matches on the hour.

    Usable timestamp columns and hour columns are OR-ed; without any of them the
    hour is not tested. Whether a column has an exact row is asked in one lazy
    aggregate over all of them.
    """
    stamps = roles.timestamp_columns(df.columns)
    hours = roles.named_like(df.columns, K.HOUR_KEYS_ACCIDENTS)
    codes = [stamp_code(as_timestamp(df, n)) for n in stamps]
    codes += [to_hour_minute(col(n)) for n in hours]
    if not codes:
        return Test(F.lit(True))
    wanted = hour[0] * 100 + hour[1]
    seen = df.agg(
        F.struct(*[F.max(c == wanted).alias(f"c{i}") for i, c in enumerate(codes)]).alias("seen")
    ).scalar()
    usable = roles.usable_flags(df, stamps)
    masks = []
    for i in range(len(codes)):
        code = F.col(f"__h{i}")
        mask = F.when(seen.getField(f"c{i}"), code == wanted).otherwise(
            F.floor(code / 100) == hour[0]
        )
        masks.append(usable[stamps[i]] & mask if i < len(stamps) else mask)
    if not hours:
        # only timestamp columns: when none of them is usable the hour is not tested
        masks.append(~any_of([usable[n] for n in stamps]))
    return Test(any_of(masks), {f"__h{i}": c for i, c in enumerate(codes)})


def hour_exact_or_hour(df: DataFrame, hour: tuple[int, int]) -> DataFrame:
    return keep(df, hour_exact_test(df, hour))


def hour_within_test(
    df: DataFrame, stamp: Column, hour: tuple[int, int], margin: int = K.HOUR_MARGIN_MINUTES
) -> Test:
    """Within ``margin`` minutes of the hour, without wrapping at midnight.

    A row without timestamp fails, unless no row of the table has one: then any
    hour column within the margin is enough.
    """
    target = hour[0] * 60 + hour[1]
    by_stamp = F.abs(F.hour(STAMP) * 60 + F.minute(STAMP) - target) <= margin
    names = roles.named_like(df.columns, K.HOUR_KEYS_RANGES)
    by_column = any_of([F.abs(time_midpoint(col(n)) - target) <= margin for n in names])
    any_stamp = df.where(stamp.isNotNull()).exists()
    mask = F.when(any_stamp, by_stamp).otherwise(by_column if names else F.lit(True))
    return Test(mask, {STAMP: stamp})


def hour_within(
    df: DataFrame, hour: tuple[int, int], margin: int = K.HOUR_MARGIN_MINUTES
) -> DataFrame:
    return keep(df, hour_within_test(df, build_ts(df), hour, margin))


# --- places -------------------------------------------------------------------

def location_test(
    df: DataFrame, text: str, keys: list[str], on_missing: str = "empty", regex: bool = False
) -> Test:
    """Folded search text inside any location column.

    ``on_missing`` says what a table without location columns gives: ``empty`` or
    ``all``. ``regex`` takes the folded text as a pattern.
    """
    names = roles.named_like(df.columns, keys)
    if not names:
        return Test(F.lit(on_missing == "all"))
    target = fold_literal(text)
    cells = [fold_text(col(n)) for n in names]
    return Test(any_of([c.rlike(target) if regex else c.contains(target) for c in cells]))


def location_any(df: DataFrame, text: str, keys: list[str], **options) -> DataFrame:
    return keep(df, location_test(df, text, keys, **options))


def location_joined_test(df: DataFrame, text: str, keys: list[str]) -> Test:
    """Search all location columns as one text, so a query may span columns."""
    names = roles.named_like(df.columns, keys)
    if not names:
        return Test(F.lit(False))
    joined = F.concat_ws(" ", *[fold_text(col(n)) for n in names])
    return Test(joined.contains(fold_literal(text)))


def location_joined(df: DataFrame, text: str, keys: list[str] | None = None) -> DataFrame:
    return keep(df, location_joined_test(df, text, keys or K.ROAD_POINT_KEYS))


# --- geography ----------------------------------------------------------------

def numeric_coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Coordinates as doubles, rows without both dropped."""
    numbers = {lat: roles.as_number(df, lat), lon: roles.as_number(df, lon)}
    return df.withColumns(numbers).where(col(lat).isNotNull() & col(lon).isNotNull())


def valid_coordinates(df: DataFrame, lat: str = "latitud", lon: str = "longitud") -> DataFrame:
    """Numeric, present and not zero."""
    return numeric_coordinates(df, lat, lon).where((col(lat) != 0) & (col(lon) != 0))


def with_distance(
    df: DataFrame,
    centre: tuple[float, float] = (K.CENTRE_LAT, K.CENTRE_LON),
    lat: str = "latitud",
    lon: str = "longitud",
    name: str = "distancia_centro_km",
) -> DataFrame:
    point = F.lit(float(centre[0])), F.lit(float(centre[1]))
    return df.withColumn(name, haversine_km(*point, col(lat), col(lon)))


def within_radius(
    df: DataFrame,
    centre: tuple[float, float] = (K.CENTRE_LAT, K.CENTRE_LON),
    km: float = K.RADIUS_KM,
    lat: str = "latitud",
    lon: str = "longitud",
    name: str = "distancia_centro_km",
) -> DataFrame:
    """Rows at most ``km`` from ``centre``, with their distance.

    The bounding box goes first: it is cheap and prunes Parquet row groups.
    """
    boxed = df.where(in_bounding_box(col(lat), col(lon), centre, km))
    return with_distance(boxed, centre, lat, lon, name).where(col(name) <= km)


# --- gates --------------------------------------------------------------------

def event_level_gate(df: DataFrame, with_ranges: bool = False) -> DataFrame:
    """Aggregated tables (no date or time per row) become empty."""
    return df if roles.is_event_level(df.columns, with_ranges) else df.where(F.lit(False))
