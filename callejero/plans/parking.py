"""Car parks near the city centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.operators.filters import valid_coordinates, with_distance, within_radius
from callejero.operators.ordering import sort_spread
from callejero.operators.roles import coordinate_columns, normalize_columns


def located(df: DataFrame, extracted: Column | None = None) -> DataFrame:
    """Clean names, coordinates as ``latitud``/``longitud``, bad ones dropped, time of
    extraction added."""
    df = normalize_columns(df)
    pair = coordinate_columns(df.columns)
    if pair is None:
        raise ValueError("no coordinate columns")
    renamed = df.withColumnsRenamed(dict(zip(pair, ("latitud", "longitud"), strict=True)))
    stamp = F.current_timestamp() if extracted is None else extracted
    return valid_coordinates(renamed.withColumn("fecha_extraccion", stamp))


def parking_in_radius(
    df: DataFrame, centre: tuple[float, float] = (K.CENTRE_LAT, K.CENTRE_LON),
    km: float = K.RADIUS_KM, extracted: Column | None = None,
) -> DataFrame:
    """Car parks within the radius, nearest first."""
    found = within_radius(located(df, extracted), centre, km)
    return sort_spread(found, F.col("distancia_centro_km").asc(), cheap=True)


def parking_or_all(
    df: DataFrame, centre: tuple[float, float] = (K.CENTRE_LAT, K.CENTRE_LON),
    km: float = K.RADIUS_KM, extracted: Column | None = None,
) -> DataFrame:
    """The radius result, or every located car park when the radius is empty.

    ``scope`` says which of the two a row belongs to.
    """
    everything = with_distance(located(df, extracted), centre)
    any_inside = within_radius(located(df, extracted), centre, km).exists()
    inside = F.col("distancia_centro_km") <= km
    return everything.where(inside | ~any_inside).withColumn(
        "scope", F.when(inside, "radius").otherwise("all")
    )
