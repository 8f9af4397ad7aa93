"""Hours of the day in the many ways the feeds and the users write them.

Hours are ``hhmm`` integers (830 is 8:30): one number holds hour and minute even
where a cell has an out-of-range part on purpose (``8.999`` is 8:60 = 860, the
text ``830`` is 83:00 = 8300). Each spelling is one alternative of a ``coalesce``
whose pattern does the range checks, so the expressions stay small enough for
code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.dates import parse_timestamp
from callejero.functions.text import strip_blanks

COLON_INPUT = r"^(\d{1,2}):([0-5]?\d?(?:\.\d+)?|60(?:\.0*)?)$"
DECIMAL_INPUT = r"^\d{1,3}(?:\.\d+)?$"
NUMBER_FORM = r"^\s*\+?(?:0*\d{1,3}\.?\d*|\.\d+)\s*$"
FRACTION_FORM = r"^\+?0*(?:1?\d|2[0-3])?\.0{0,8}[1-9]\d*$"
PADDED_FORM = r"^0{1,7}(?:[01]?\d|2[0-3])$"
CLOCK_IN_TEXT = r"(?:^|[^\d:])([01]?\d|2[0-3]):([0-5]\d)(?:\D|$)"
AFTERNOON = r"(?:^|[^\d:])(?:0?[1-9]|1[01]):[0-5]\d(?::[0-5]\d)?\s*[pP]\.?[mM]"
MIDNIGHT = r"(?:^|[^\d:])12:[0-5]\d(?::[0-5]\d)?\s*[aA]\.?[mM]"


def hour_of(code: Column) -> Column:
    return F.floor(code / 100).cast("int")


def minute_of(code: Column) -> Column:
    return code % 100


def stamp_code(stamp: Column) -> Column:
    """``hhmm`` of a timestamp."""
    return F.hour(stamp) * 100 + F.minute(stamp)


def _int(text: Column, pattern: str, group: int) -> Column:
    """A group of a pattern known to match, as int; an empty group is 0."""
    return F.concat(F.lit("0"), F.regexp_extract(text, pattern, group)).try_cast("int")


def _before_midnight(minutes: Column) -> Column:
    """Null from 24:00 on. One mention of ``minutes``: the expression is not repeated."""
    day = F.lit(1440.0)
    return F.nullif(F.least(minutes.cast("double"), day), day)


def parse_hour_input(c: Column) -> Column:
    """Hour typed by a user, as ``hhmm``: ``08``, ``8:30``, ``8h30``, ``8.5``, ``8,25``.

    Fractions are rounded half to even and 60 minutes carry. Bad text and hours
    from 24:00 on give null.
    """
    text = F.translate(F.lower(strip_blanks(c)), ",h ", ".:")  # the blank has no partner: dropped
    value = text.try_cast("double")
    part = F.concat(F.lit("0"), F.regexp_extract(text, COLON_INPUT, 2)).try_cast("double")
    minutes = _before_midnight(
        F.when(text.rlike(COLON_INPUT), _int(text, COLON_INPUT, 1) * 60 + F.rint(part)).when(
            text.rlike(DECIMAL_INPUT), F.floor(value) * 60 + F.rint(value % 1 * 60)
        )
    )
    return (F.floor(minutes / 60) * 100 + minutes % 60).cast("int")


def to_hour_minute(c: Column) -> Column:
    """Hour of a data cell as ``hhmm``: a fraction of 0-24, a compact form, or free text.

    Free text gives its first clock time, or 0:00 for a bare date.
    """
    cell = strip_blanks(c.cast("string"))
    pointed, dotted = F.translate(cell, ",", "."), F.translate(cell, ".", ":")
    value = pointed.try_cast("double")
    half_day = F.when(cell.rlike(AFTERNOON), 1200).when(cell.rlike(MIDNIGHT), -1200).otherwise(0)
    return (
        F.when(
            pointed.rlike(FRACTION_FORM),
            (F.floor(value) * 100 + F.rint(value % 1 * 60)).cast("int"),
        )
        .when(
            dotted.rlike(K.CELL_FORM),
            _int(dotted, K.CELL_FORM, 1) * 100 + _int(dotted, K.CELL_FORM, 2),
        )
        .when(cell.rlike(PADDED_FORM), cell.try_cast("int") * 100)
        .when(
            cell.rlike(CLOCK_IN_TEXT),
            _int(cell, CLOCK_IN_TEXT, 1) * 100 + _int(cell, CLOCK_IN_TEXT, 2) + half_day,
        )
        .when(parse_timestamp(cell).isNotNull(), 0)
    )


def time_midpoint(c: Column) -> Column:
    """Minute of the day of a time or the floor midpoint of a range; null from 24:00 on.

    Ranges over midnight are averaged as written (``23:00-01:00`` is noon).
    """
    text = c.cast("string")
    pointed = F.translate(text, ",", ".")
    value = pointed.try_cast("double")
    both = (
        (_int(text, K.RANGE_FORM, 1) + _int(text, K.RANGE_FORM, 3)) * 60
        + _int(text, K.RANGE_FORM, 2) + _int(text, K.RANGE_FORM, 4)
    )
    minutes = (
        F.when(text.rlike(K.RANGE_FORM), F.floor(both / 2))
        .when(text.rlike(K.HHMM_FORM), _int(text, K.HHMM_FORM, 1) * 60 + _int(text, K.HHMM_FORM, 2))
        .when(pointed.rlike(NUMBER_FORM), F.floor(value) * 60 + F.rint(value % 1 * 60))
    )
    return _before_midnight(minutes).cast("int")


def hour_argument(text: str | tuple[int, int] | None) -> tuple[int, int] | None:
    """Validate an hour given to a job; accepts the same spellings as the column form."""
    if text is None or isinstance(text, tuple):
        parsed = text
    else:
        compact = "".join(text.lower().split()).translate(str.maketrans(",h", ".:"))
        if not compact:
            return None
        if match := re.match(COLON_INPUT, compact):
            minutes = int(match[1]) * 60 + round(float(match[2] or 0))
        elif re.match(DECIMAL_INPUT, compact):
            minutes = int(float(compact)) * 60 + round(float(compact) % 1 * 60)
        else:
            raise ValueError(f"unrecognised hour: {text!r}")
        parsed = divmod(minutes, 60)
    if parsed is not None and not (0 <= parsed[0] < 24 and 0 <= parsed[1] < 60):
        raise ValueError(f"hour out of range: {text!r}")
    return parsed
