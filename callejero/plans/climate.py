"""Climate tables, daily and monthly, in their published layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.labels import month_name
from callejero.operators.filters import last_n_days
from callejero.operators.ordering import sort_spread
from callejero.operators.reshape import project_with_default


def climate_daily(df: DataFrame, end: str | dt.date, days: int) -> DataFrame:
    """The last ``days`` days up to ``end``, newest first; missing values are ``N/D``."""
    newest = F.coalesce(F.col("fecha"), F.lit("")).desc()
    return sort_spread(last_n_days(df, end, days), newest, cheap=True).select(
        *project_with_default(df, K.CLIMATE_DAILY_FIELDS)
    )


def climate_monthly(df: DataFrame, year: int) -> DataFrame:
    """The records of one year with month names; a record without month is ``Mes N/D``.

    The year of a record leads its ``fecha`` (``yyyy-M``).
    """
    month = F.col("mes") if "mes" in df.columns else F.lit(None)
    return df.where(F.regexp_extract("fecha", r"^\s*(\d{4})(?:\D|$)", 1) == str(year)).select(
        F.lit(year).alias("Año"),
        F.coalesce(month.cast("string"), F.lit("N/D")).alias("Mes"),
        month_name(month).alias("Nombre_Mes"),
        *project_with_default(df, K.CLIMATE_MONTHLY_FIELDS),
    )
