"""Accidents, traffic history, emergency calls and speed cameras."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.clock import hour_argument
from callejero.functions.dates import date_argument
from callejero.operators import filters
from callejero.operators.ordering import sort_by_first_date_column, sort_by_timestamp
from callejero.operators.reshape import (
    fill_sentinel, first_with_rows, tag_source, union_drifting,
)
from callejero.operators.roles import is_event_level
from callejero.operators.timestamps import build_ts, emergency_sort_ts, serving_column

Day = str | dt.date | None
Hour = str | tuple[int, int] | None
SORT_STAMP = "__sort_ts"


@dataclass(frozen=True)
class Source:
    """A table with the link it came from and the catalogue page that named it."""

    table: DataFrame
    link: str
    page: str = ""
    enabled: bool = True


def filter_accidents(
    df: DataFrame, day: Day = None, street: str | None = None, hour: Hour = None,
    months: int = K.MONTHS_BACK_ACCIDENTS,
) -> DataFrame:
    """Date window, street and hour; a filter without a column to test empties the table
    (date, street) or is skipped (hour)."""
    tests = []
    if day := date_argument(day):
        tests.append(filters.date_test(df, day, months))
    if street:
        tests.append(filters.location_test(df, street, K.STREET_KEYS))
    if hour := hour_argument(hour):
        tests.append(filters.hour_exact_test(df, hour))
    return filters.keep(df, *tests)


def accidents(
    sources: list[Source], day: Day = None, street: str | None = None, hour: Hour = None,
    months: int = K.MONTHS_BACK_ACCIDENTS,
) -> DataFrame:
    """Per page the first source that yields rows, stacked and sorted by date.

    ``sources`` are in order of preference within their page. A source is filtered once,
    into the shared folder, and those behind the first with rows are not read at all.
    """
    pages: dict[str, list[Source]] = {}
    for s in sources:
        pages.setdefault(s.page, []).append(s)
    parts = []
    for page, own in pages.items():
        tagged = (tag_source(filter_accidents(s.table, day, street, hour, months), __origen__=page, __descarga__=s.link) for s in own)
        parts.append(first_with_rows(tagged))
    parts = [p for p in parts if p is not None]
    if not parts:
        return _nothing("__origen__", "__descarga__")
    return sort_by_first_date_column(union_drifting(parts), cheap=True)


def _nothing(*columns: str) -> DataFrame:
    """The result without any source: no row, but a header to write."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return SparkSession.active().createDataFrame([], schema)


def filter_traffic(
    df: DataFrame, day: Day = None, hour: Hour = None, place: str | None = None,
    months: int = K.MONTHS_BACK, margin: int = K.HOUR_MARGIN_MINUTES, carry: str | None = None,
    funnel: Observation | None = None,
) -> DataFrame:
    """Date window (undated rows stay), hour margin, and place over all columns joined.

    ``carry`` names a column that keeps the timestamp of each row; ``funnel`` is that of
    :func:`callejero.operators.filters.keep`.
    """
    day, hour = date_argument(day), hour_argument(hour)
    if (day or hour) and not is_event_level(df.columns, with_ranges=True):
        df = df.where(F.lit(False))
    stamp = build_ts(df)
    tests = []
    if day:
        tests.append(filters.date_or_undated_test(stamp, day, months, df, serving_column(df)))
    if hour:
        tests.append(filters.hour_within_test(df, stamp, hour, margin))
    if place:
        tests.append(filters.location_joined_test(df, place, K.ROAD_POINT_KEYS))
    if carry:
        tests.append(filters.Test(F.lit(True), {filters.STAMP: stamp}))
    return filters.keep(df, *tests, carry={filters.STAMP: carry} if carry else None, funnel=funnel)


def traffic(sources: list[Source], funnels: dict[str, Observation] | None = None, **criteria) -> DataFrame:
    """Filtered tables of the enabled sources, blanks as ``NA``, in time order.

    ``funnels`` (by link) count each source's rows per filter while the result is written.
    """
    parts = [
        tag_source(filter_traffic(s.table, carry=SORT_STAMP, funnel=(funnels or {}).get(s.link), **criteria), __fuente=s.link)
        for s in sources if s.enabled
    ]
    if not parts:
        return _nothing("__fuente")
    out = fill_sentinel(union_drifting(parts), but=SORT_STAMP)
    return sort_by_timestamp(out, F.col(SORT_STAMP)).drop(SORT_STAMP)


def filter_emergencies(
    df: DataFrame, day: Day = None, hour: Hour = None, place: str | None = None,
    months: int = K.MONTHS_BACK,
) -> DataFrame:
    """Event tables only; date and hour by the row rule, place in any column if there is one."""
    gated = filters.event_level_gate(df)
    tests = [filters.row_time_test(df, date_argument(day), months, hour_argument(hour))]
    if place:
        tests.append(filters.location_test(df, place, K.PLACE_KEYS, on_missing="all"))
    return filters.keep(gated, *tests)


def emergencies(sources: list[Source], **criteria) -> DataFrame:
    parts = [
        tag_source(filter_emergencies(s.table, **criteria), __fuente=s.link)
        for s in sources if s.enabled
    ]
    if not parts:
        return _nothing("__fuente")
    out = fill_sentinel(union_drifting(parts))
    return sort_by_timestamp(out, emergency_sort_ts(out))


def cameras(df: DataFrame, place: str | None = None) -> DataFrame:
    """Cameras at a place (all of them without one), blanks as ``NA``."""
    if place:
        df = filters.location_any(df, place, K.STATION_KEYS, on_missing="all")
    return fill_sentinel(df)
