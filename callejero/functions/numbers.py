"""Lenient number parsing: bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
INTEGER = r"^\s*([+-]?\d+)\s*$"


def first_group(text: Column, pattern: str, group: int) -> Column:
    """A pattern's group, null where the pattern does not match.

    Null, unlike the empty string of a plain extract, casts without raising an
    error inside, which on dirty columns is most of the cost.
    """
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def coerce_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def decimal_comma(c: Column) -> Column:
    """Like :func:`coerce_number`, with a comma accepted as the decimal mark."""
    return coerce_number(F.translate(c.cast("string"), ",", "."))


def coerce_int(c: Column) -> Column:
    """Text to int; fractions and other text become null."""
    text = c.cast("string")
    return F.when(text.rlike(INTEGER), F.trim(text)).try_cast("int")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
