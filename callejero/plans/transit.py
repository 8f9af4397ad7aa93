"""The stop schedule of a day over several transit feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.operators.ordering import sort_spread
from callejero.operators.transit import MODE, Feed, schedule, stacked
from callejero.session import written
from callejero.sources.readers import read_gtfs

MODES_WITH_RAW_STOPS = ("METRO",)


def load_feed(spark: SparkSession, folder: str) -> Feed:
    return Feed(**{name: read_gtfs(spark, folder, name) for name in K.GTFS_SCHEMAS})


def day_schedule(feeds: dict[str, Feed], day: dt.date) -> DataFrame:
    """All modes' stops of the day in mode, trip and stop order (one sort in all).

    The rows are stored once in front of the sort: columns compress far better there than
    rows do in an exchange.
    """
    rows = written(schedule(stacked(feeds), day, MODES_WITH_RAW_STOPS), "schedule")
    return sort_spread(rows, *[F.col(c) for c in (MODE, "trip_id", "stop_sequence")], cheap=True)
