"""Service-day resolution and the stop schedule of a transit feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.numbers import coerce_number
from callejero.operators.reshape import union_drifting

MODE = "tipo_transporte"


@dataclass(frozen=True)
class Feed:
    """The five tables of a feed that a schedule needs."""

    trips: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame
    stop_times: DataFrame
    stops: DataFrame


def runs_on(calendar: DataFrame, day: dt.date) -> DataFrame:
    """Services whose period covers the day and whose weekday flag is set."""
    number = F.lit(int(day.strftime("%Y%m%d")))
    return calendar.where(
        (F.col("start_date").cast("int") <= number)
        & (F.col("end_date").cast("int") >= number)
        & (F.col(K.WEEKDAYS[day.weekday()]) == 1)
    )


def exceptions_on(calendar_dates: DataFrame, day: dt.date) -> DataFrame:
    """Services added (1) or removed (2) on the day."""
    return calendar_dates.where(
        (F.col("date").cast("int") == int(day.strftime("%Y%m%d")))
        & F.col("exception_type").isin(1, 2)
    )


def stacked(feeds: dict[str, Feed]) -> Feed:
    """All feeds as one, each table with the mode in front, so that a plan has one chain
    of joins whatever the number of feeds."""
    def table(name: str) -> DataFrame:
        return union_drifting([
            getattr(feed, name).withColumn(MODE, F.lit(mode)) for mode, feed in feeds.items()
        ])

    return Feed(**{f.name: table(f.name) for f in fields(Feed)})


def active_services(calendar: DataFrame, calendar_dates: DataFrame, day: dt.date) -> DataFrame:
    """Services of the day: (regular minus removed) plus added; added wins.

    Regular services and exceptions are stacked as flags and folded by one
    aggregate: a single shuffle of ids instead of an anti join, a union and a
    distinct. Without any calendar row there is no service at all, by mode where the
    tables carry one.
    """
    mode = [MODE] if MODE in calendar.columns else []
    exceptions = exceptions_on(calendar_dates, day)
    kind = F.col("exception_type")
    flags = runs_on(calendar, day).select(
        *mode, "service_id", F.lit(True).alias("regular"), F.lit(False).alias("added"),
        F.lit(False).alias("removed"),
    ).unionByName(
        exceptions.select(
            *mode, "service_id", F.lit(False).alias("regular"), (kind == 1).alias("added"),
            (kind == 2).alias("removed"),
        )
    )
    active = (
        flags.groupBy(*mode, "service_id")
        .agg(*[F.bool_or(c).alias(c) for c in ("regular", "added", "removed")])
        .where("(regular and not removed) or added")
        .select(*mode, "service_id")
    )
    if mode:
        return active.join(calendar.select(MODE).distinct(), MODE, "left_semi")
    return active.where(calendar.exists())


def active_trips(feed: Feed, day: dt.date) -> DataFrame:
    services = active_services(feed.calendar, feed.calendar_dates, day)
    return feed.trips.join(services, services.columns, "left_semi")


def schedule(feed: Feed, day: dt.date, raw_stops: Collection[str] = ()) -> DataFrame:
    """Every stop of every trip that runs on the day, one row per stop time, of stacked feeds.

    Only active trips reach the join with the stop times. Trips, services and stops
    are joined without hints: adaptive execution broadcasts what it measures as
    small and splits skewed keys of the rest. Stops without numeric coordinates are
    dropped, but for the modes in ``raw_stops``, which keep them with null.
    """
    trips = active_trips(feed, day).select(
        MODE, "trip_id", "route_id", "service_id", "trip_headsign", "direction_id"
    )
    times = feed.stop_times.select(
        MODE, "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"
    )
    numbers = {c: coerce_number(F.col(c)) for c in ("stop_lat", "stop_lon")}
    stops = feed.stops.select(MODE, "stop_id", "stop_name", "stop_lat", "stop_lon")
    stops = stops.withColumns(numbers).where(
        F.col(MODE).isin(*raw_stops) | (F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull())
    )
    return (
        times.join(trips, [MODE, "trip_id"]).join(stops, [MODE, "stop_id"])
        .select(*K.TRANSIT_COLUMNS)
    )
