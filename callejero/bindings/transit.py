"""Transit: service day and schedules over order and line-item tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from callejero.bindings import query
from callejero.bindings.views import spark_view, with_views
from callejero.operators import transit
from callejero.operators.aggregates import counts_by
from callejero.plans.transit import day_schedule

DAY = dt.date(1998, 5, 29)  # a Friday
FEED = with_views("v_trips", "v_calendar", "v_calendar_dates", "v_stop_times", "v_stops")
ACTIVE = """active AS (
  (SELECT service_id FROM v_calendar
   WHERE start_date <= 19980529 AND end_date >= 19980529 AND friday = 1
   EXCEPT
   SELECT service_id FROM v_calendar_dates WHERE date = 19980529 AND exception_type = 2)
  UNION
  SELECT service_id FROM v_calendar_dates WHERE date = 19980529 AND exception_type = 1
)"""
# the three feeds differ in which service their trips belong to
SHIFTS = {"METRO": 0, "EMT": 3, "INTERURBANO": 5}


def _service(shift: int) -> str:
    return (f"'S' || CAST((CAST(substr(service_id, 2, 9) AS INT) + {shift}) % 10 AS STRING)")


def _feed(spark, sf_dir, shift: int = 0) -> transit.Feed:
    views = {
        name: spark_view(spark, sf_dir, f"v_{name}")
        for name in ("trips", "calendar", "calendar_dates", "stop_times", "stops")
    }
    views["trips"] = views["trips"].withColumn("service_id", F.expr(_service(shift)))
    return transit.Feed(**views)


def _feeds(spark, sf_dir) -> dict[str, transit.Feed]:
    return {mode: _feed(spark, sf_dir, shift) for mode, shift in SHIFTS.items()}


def _mode_sql(mode: str, shift: int) -> str:
    lat, lon = "try_cast(stop_lat AS DOUBLE)", "try_cast(stop_lon AS DOUBLE)"
    clean = "" if mode == "METRO" else f"AND {lat} IS NOT NULL AND {lon} IS NOT NULL"
    return f"""SELECT '{mode}' AS tipo_transporte, trip_id, route_id, {_service(shift)} AS service_id,
  direction_id, trip_headsign, stop_sequence, stop_id, stop_name, arrival_time, departure_time,
  {lat} AS stop_lat, {lon} AS stop_lon
FROM v_trips JOIN v_stop_times USING (trip_id) JOIN v_stops USING (stop_id)
WHERE {_service(shift)} IN (SELECT service_id FROM active) {clean}"""


SCHEDULE = "\nUNION ALL\n".join(_mode_sql(mode, shift) for mode, shift in SHIFTS.items())


@query(f"{FEED}, {ACTIVE} SELECT service_id FROM active")
def q_active_services(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    return transit.active_services(feed.calendar, feed.calendar_dates, DAY)


@query(f"""{FEED}, {ACTIVE} SELECT 'con calendario' AS caso, service_id FROM active
UNION ALL SELECT 'solo excepciones', service_id FROM v_calendar_dates
  WHERE date = {DAY:%Y%m%d} AND exception_type = 1 AND EXISTS (SELECT 1 FROM v_calendar WHERE start_date < 19950105)
UNION ALL SELECT 'sin calendario', service_id FROM active WHERE false""")
def q_active_services_no_calendar(spark, sf_dir):
    """Without calendar rows there are no services, whatever the exceptions add; one row that
    doesn't run is enough for the added ones."""
    feed = _feed(spark, sf_dir)
    none = feed.calendar.where("start_date < 0")
    idle = feed.calendar.where("start_date < 19950105").withColumn("end_date", F.lit(19950106))
    cases = {"con calendario": feed.calendar, "solo excepciones": idle, "sin calendario": none}
    parts = [transit.active_services(calendar, feed.calendar_dates, DAY).select(F.lit(case).alias("caso"), "service_id")
             for case, calendar in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""{FEED}, {ACTIVE} SELECT trip_id, route_id, service_id, trip_headsign, direction_id
FROM v_trips WHERE service_id IN (SELECT service_id FROM active)""")
def q_transit_active_trips(spark, sf_dir):
    return transit.active_trips(_feed(spark, sf_dir), DAY).select(
        "trip_id", "route_id", "service_id", "trip_headsign", "direction_id"
    )


@query(f"{FEED}, {ACTIVE} {SCHEDULE}")
def q_transit_schedule(spark, sf_dir):
    return day_schedule(_feeds(spark, sf_dir), DAY)


@query(f"{FEED}, {ACTIVE}, s AS ({SCHEDULE}) "
       "SELECT tipo_transporte, count(*) AS n FROM s GROUP BY tipo_transporte")
def q_transit_counts(spark, sf_dir):
    return counts_by(day_schedule(_feeds(spark, sf_dir), DAY), "tipo_transporte")


