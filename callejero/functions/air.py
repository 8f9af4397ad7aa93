"""Air quality: pollutant names, units, measured values and snapshot text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.numbers import coerce_int, decimal_comma
from callejero.functions.text import strip_blanks

MICRO = "µg/m³"
UNIT_FORM = "µg/m³|μg/m³|ug/m3|ppm"
NAN = float("nan")
NAME_TO_NUMBER = 300


def _lookup(table: dict, key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def aqi_category(c: Column) -> Column:
    """Name of the AQI band of a whole number 0-500, else null."""
    value = coerce_int(c)
    band = F.lit(None).cast("string")
    for low, high, name in reversed(K.AQI_BANDS):
        band = F.when(value.between(low, high), F.lit(name)).otherwise(band)
    return band


def pollutant_from_code(c: Column) -> Column:
    return _lookup(K.POLLUTANT_CODES, coerce_int(c))


def pollutant_from_text(cells: list[Column]) -> Column:
    """First known spelling found anywhere in the row's cells."""
    text = F.lower(F.concat_ws(" ", *[c.cast("string") for c in cells]))
    name = F.lit(None).cast("string")
    for spelling, pollutant in reversed(K.POLLUTANT_SPELLINGS):
        name = F.when(text.contains(spelling), F.lit(pollutant)).otherwise(name)
    return name


def pollutant_of(columns: list[str]) -> Column:
    """Pollutant of a row: the first code column that parses decides, else the text."""
    name = pollutant_from_text([F.col(f"`{c}`") for c in columns])
    for code in reversed([c for c in K.POLLUTANT_CODE_COLUMNS if c in columns]):
        cell = F.col(f"`{code}`")
        name = F.when(coerce_int(cell).isNotNull(), pollutant_from_code(cell)).otherwise(name)
    return name


def unit_for(pollutant: Column) -> Column:
    return F.coalesce(_lookup(K.POLLUTANT_UNITS, pollutant), F.lit("NA"))


def _reading(c: Column) -> Column:
    """Number in a cell; a missing cell is NaN (known but empty), bad text is null."""
    missing = c.isNull() | (F.lower(strip_blanks(c.cast("string"))).isin("", "nan"))
    return F.when(missing, F.lit(NAN)).otherwise(decimal_comma(c))


def hourly_columns(columns: list[str]) -> list[str]:
    """For each hour 1-24 the first column name present.

    ``V01`` to ``V24`` count as hours only when they are not days of a month,
    that is, unless the table has year and month but no day column.
    """
    lower = {c.lower() for c in columns}
    monthly = (
        bool(lower & set(K.YEAR_NAMES))
        and bool(lower & set(K.MONTH_NAMES))
        and not lower & set(K.DAY_NAMES)
    )
    patterns = [p for p in K.HOURLY_COLUMN_PATTERNS if not (monthly and p.startswith("V"))]
    present = set(columns)
    found = []
    for hour in range(1, 25):
        names = [p.format(hour) for p in patterns if p.format(hour) in present]
        found.extend(names[:1])
    return found


def mean_of_hourly(columns: list[str]) -> Column:
    """Mean of the hour cells that hold a number; null when none does."""
    names = hourly_columns(columns)
    if not names:
        return F.lit(None).cast("double")
    readings = F.filter(
        F.array(*[decimal_comma(F.col(f"`{n}`")) for n in names]), lambda v: v.isNotNull()
    )
    total = F.aggregate(readings, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(readings) > 0, total / F.size(readings))


def first_numeric(columns: list[str], otherwise: Column | None = None) -> Column:
    """First value column that parses. An empty value cell stops the search with NaN."""
    value = F.lit(None).cast("double") if otherwise is None else otherwise
    for name in reversed([c for c in K.VALUE_COLUMNS if c in columns]):
        value = F.coalesce(_reading(F.col(f"`{name}`")), value)
    return value


def row_value(columns: list[str]) -> Column:
    """Measured value of a row: a value column, else the mean of the hours.

    NaN marks a row whose value is missing; null marks a row without a value.
    """
    return first_numeric(columns, otherwise=mean_of_hourly(columns))


def delta(snapshot: Column, measured: Column, unit: Column) -> Column:
    """Snapshot minus measured, only where both are in µg/m³."""
    return F.when(unit == MICRO, snapshot - measured)


def parse_aqi_text(text: Column) -> Column:
    """The number before ``AQI`` in a page's text, as text; null when absent."""
    found = F.regexp_extract(text, r"(?i)\b(\d{1,3})\s*AQI\b", 1)
    return F.when(found != "", found)


def readings_part(text: Column) -> Column:
    """The end of a text from which on readings can occur; null without any.

    A reading is a name at most 300 characters before a number with a unit, so
    nothing before the first such number, less that distance, can take part.
    """
    first = F.regexp_instr(text, F.lit(rf"(?i)\d+(?:[.,]\d+)?\s*(?:{UNIT_FORM})"))
    start = F.greatest(first - NAME_TO_NUMBER - 20, F.lit(1))
    return F.when(first > 0, F.substr(text, start))


def _spelling_form(spelling: str) -> str:
    gap = f".{{0,{NAME_TO_NUMBER}}}?"
    return rf"(?is){re.escape(spelling)}{gap}(\d+(?:[.,]\d+)?)\s*({UNIT_FORM})"


def last_mentions(text: Column) -> dict[str, Column]:
    """Per spelling the last stretch of text from the name to its number and unit."""
    return {
        f"m{i}": F.try_element_at(
            F.regexp_extract_all(text, F.lit(_spelling_form(spelling)), F.lit(0)), F.lit(-1)
        )
        for i, (spelling, _) in enumerate(K.SNAPSHOT_SPELLINGS)
    }


def parse_pollutant_text(mentions: Column) -> list[Column]:
    """The 18 measure columns ``<pollutant>_{ugm3,raw,unit}`` of a snapshot row.

    ``mentions``: a struct of :func:`last_mentions`. Between spellings of one
    pollutant the later in the list wins; ``_ugm3`` is filled for that unit only.
    """
    tries: dict[str, list[tuple[Column, str]]] = {p: [] for p in K.SNAPSHOT_POLLUTANTS}
    for i, (spelling, pollutant) in enumerate(K.SNAPSHOT_SPELLINGS):
        tries[pollutant].insert(0, (mentions[f"m{i}"], _spelling_form(spelling)))
    values, rest = [], []
    for pollutant, found in tries.items():
        raw = F.coalesce(*[F.regexp_extract(m, form, 1) for m, form in found])
        unit = F.coalesce(*[F.regexp_extract(m, form, 2) for m, form in found])
        raw = F.translate(raw, ",", ".")
        unit = F.replace(F.lower(unit), F.lit("ug/m3"), F.lit(MICRO))
        values.append(F.when(unit == MICRO, raw).alias(f"{pollutant}_ugm3"))
        rest += [raw.alias(f"{pollutant}_raw"), unit.alias(f"{pollutant}_unit")]
    return values + rest
