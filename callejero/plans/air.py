"""Air quality: open measurements against a snapshot of another provider."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.air import (
    aqi_category, delta, last_mentions, parse_aqi_text, parse_pollutant_text, readings_part,
)
from callejero.functions.dates import date_argument, months_before, within_months
from callejero.operators import filters
from callejero.operators.aggregates import city_daily_mean
from callejero.operators.joins import left_join_hot_right
from callejero.operators.reshape import (
    fill_sentinel, only_if_empty, preferred_first, snapshot_to_long, tag_source, union_drifting,
)
from callejero.operators.roles import first_like
from callejero.session import written

Day = str | dt.date | None
MEASURED = "__fecha_dt"


def parse_snapshots(pages: DataFrame, text: str, fecha: str, hora: str, source: str, origin: str):
    """Snapshot rows (24 columns) from page texts; pages without any reading are dropped."""
    page = F.col(text)
    cut = filters.bind(pages, {"__part": readings_part(page), "__aqi": parse_aqi_text(page)})
    mentions = F.struct(*[m.alias(n) for n, m in last_mentions(F.col("__part")).items()])
    rows = filters.bind(cut, {"__m": mentions}).select(
        F.col(source).alias("__fuente"), F.col(fecha).alias("fecha"), F.col(hora).alias("hora"),
        F.lit(origin).alias("origen"), F.col("__aqi").alias("aqi"),
        aqi_category(F.col("__aqi")).alias("aqi_category"),
        *parse_pollutant_text(F.col("__m")),
        F.greatest("__aqi", *[f"__m.m{i}" for i in range(len(K.SNAPSHOT_SPELLINGS))]).alias("any"),
    )
    return rows.where("any is not null").drop("any")


def open_measurements(
    df: DataFrame, link: str, day: Day = None, place: str | None = None,
    months: int = K.MONTHS_BACK, regex: bool = False,
) -> DataFrame:
    """One open table: dated, in the window, at the place, with its origin."""
    dated = filters.bind(
        tag_source(df, __fuente=link, origen=K.OPEN_AIR_ORIGIN),
        {MEASURED: filters.first_date(df)},
    )
    tests = []
    if day := date_argument(day):
        name = first_like(df.columns, K.TIMESTAMP_KEYS_NARROW)
        first = months_before(day, months)
        stored = filters.stored_window(df, [name], first, F.lit(day)) if name else None
        tests.append(filters.Test(within_months(F.col(MEASURED), day, months), {}, stored))
    if place:
        tests.append(
            filters.location_test(df, place, K.STATION_KEYS, on_missing="all", regex=regex)
        )
    return filters.keep(dated, *tests)


def daily_means(measurements: DataFrame) -> DataFrame:
    return city_daily_mean(measurements, MEASURED)


def compare(
    open_daily: DataFrame, snapshot_long: DataFrame, day: Day = None, months: int = K.MONTHS_BACK
) -> DataFrame:
    """Open means with the snapshot of the same day and pollutant beside them, and the
    difference. Without any open row, the snapshot rows alone."""
    if day := date_argument(day):
        open_daily = open_daily.where(within_months(F.col("fecha"), day, months))
    merged = left_join_hot_right(open_daily, snapshot_long, ["fecha", "pollutant"]).withColumn(
        "delta_ugm3_acc_minus_open",
        delta(F.col("acc_value_ugm3"), F.col("open_value"), F.col("open_unit")),
    )
    alone = only_if_empty(snapshot_long, open_daily)
    return preferred_first(
        merged.unionByName(alone, allowMissingColumns=True), K.COMPARISON_COLUMNS
    )


def air_comparison(
    open_tables: dict[str, DataFrame], snapshots: DataFrame, day: Day = None,
    place: str | None = None, months: int = K.MONTHS_BACK,
) -> DataFrame:
    """``open_tables``: link -> table. Result with blanks as ``NA``.

    The daily means, a row per day and pollutant, are written once: the join reads them,
    and so does the question whether there are any.
    """
    stacked = union_drifting(
        [open_measurements(t, link, day, place, months) for link, t in open_tables.items()]
    )
    long = snapshot_to_long(snapshots)
    return fill_sentinel(compare(written(daily_means(stacked), "means"), long, day, months))


def air_log(
    open_tables: dict[str, DataFrame], snapshots: DataFrame, day: Day = None,
    place: str | None = None, months: int = K.MONTHS_BACK,
) -> DataFrame:
    """Snapshots and filtered measurements in one table of text; ``fecha`` is derived
    from the parsed date where a table has none."""
    parts = [snapshots]
    for link, table in open_tables.items():
        rows = open_measurements(table, link, day, place, months)
        if "fecha" not in rows.columns:
            rows = rows.withColumn("fecha", F.col(MEASURED).cast("string"))
        parts.append(rows)
    return fill_sentinel(union_drifting(parts))
