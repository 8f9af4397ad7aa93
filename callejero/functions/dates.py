"""Dates as the feeds write them: ISO, or day first with slashes or dashes.

Accepted: ``yyyy-M-d``, ``d/M/yyyy`` and ``d-M-yyyy``, each with an optional
``H:mm[:ss[.fraction]]`` after a space or ``T``; a fraction is cut to microseconds.
Everything else is null. A time without a date is not a date.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero.functions.numbers import first_group

DAY_FIRST = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
ANY_FORM = (
    r"^((?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})"
    r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?)(?:(?<=\.\d{6})\d+)?$"
)
WHOLE = r"^\s*\+?(\d{1,9})(?:\.0*)?\s*$"
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def parse_timestamp(c: Column) -> Column:
    """Date or date-time text to a zone-less timestamp, day first unless ISO."""
    known = F.regexp_extract(F.trim(c.cast("string")), ANY_FORM, 1)
    return F.regexp_replace(known, DAY_FIRST, "$3-$2-$1").try_cast("timestamp_ntz")


def parse_date_iso_or_dayfirst(c: Column) -> Column:
    return parse_timestamp(c).cast("date")


def parse_date_input(c: Column) -> Column:
    """Date typed by a user in ISO order; anything invalid is null."""
    return F.regexp_extract(F.trim(c), ISO_DATE, 0).try_cast("date")


def parse_date_strict_dayfirst(c: Column) -> Column:
    """``dd/MM/yyyy`` only, as the climate job asks for it."""
    known = F.regexp_extract(c, r"^\d{1,2}/\d{1,2}/\d{4}$", 0)
    return F.regexp_replace(known, DAY_FIRST, "$3-$2-$1").try_cast("date")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from three cells; a part that is no whole number, or no such day, gives null."""

    def whole(c: Column) -> Column:
        return first_group(c.cast("string"), WHOLE, 1).try_cast("int")

    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        whole(year), whole(month), whole(day), zero, zero, zero
    ).cast("date")


def text_date_and_hour(date: Column, hour: Column) -> Column:
    """Timestamp from a date text and an hour text joined by a space."""
    return parse_timestamp(F.concat_ws(" ", date.cast("string"), hour.cast("string")))


def date_argument(value: str | dt.date | None) -> dt.date | None:
    """Validate a date given to a job (ISO text or a date)."""
    if value is None or (isinstance(value, dt.date) and not isinstance(value, dt.datetime)):
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    if not value.strip():
        return None
    if not re.match(ISO_DATE, value.strip()):
        raise ValueError(f"invalid date: {value!r}")
    year, month, day = (int(part) for part in value.strip().split("-"))
    return dt.date(year, month, day)


def months_before(day: dt.date, months: int) -> Column:
    """Calendar months back, clamped to the end of a shorter month."""
    return F.add_months(F.lit(day), -months)


def within_months(day_column: Column, day: dt.date, months: int) -> Column:
    """``day_column`` in [day - months, day], both ends included."""
    return day_column.between(months_before(day, months), F.lit(day))
