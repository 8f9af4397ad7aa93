"""Counts, bands, funnels and daily means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.functions.air import pollutant_of, row_value, unit_for
from callejero.functions.numbers import nan_to_null
from callejero.operators.filters import bind


def city_daily_mean(df: DataFrame, day: str) -> DataFrame:
    """Mean per day and pollutant; undated rows and rows without a value are left out."""
    columns = [c for c in df.columns if c != day]
    rows = bind(df, {"pollutant__": pollutant_of(columns), "value__": row_value(columns)})
    return (
        rows.select(
            F.col(day).alias("fecha"), F.col("pollutant__").alias("pollutant"),
            F.col("value__").alias("value"),
        )
        .where("fecha is not null and pollutant is not null and value is not null")
        .groupBy("fecha", "pollutant")
        .agg(F.avg(nan_to_null(F.col("value"))).alias("open_value"))
        .withColumn("open_unit", unit_for(F.col("pollutant")))
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per category, largest first."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)
    )


def distance_bands(df: DataFrame, distance: str = "distancia_centro_km") -> DataFrame:
    """Cumulative counts within each band, in one pass."""
    return df.agg(
        *[
            F.count_if(F.col(distance) <= km).alias(f"within_{str(km).replace('.', '_')}_km")
            for km in K.DISTANCE_BANDS_KM
        ]
    )


def distance_stats(
    df: DataFrame, name: str, key: str, distance: str = "distancia_centro_km",
    km: float = K.RADIUS_KM,
) -> DataFrame:
    """Extremes over all rows; count, mean, minimum and nearest name inside the radius."""
    inside = F.when(F.col(distance) <= km, F.col(distance))
    nearest = F.min(
        F.when(inside.isNotNull(), F.struct(F.col(distance), F.col(key), F.col(name)))
    )
    return df.agg(
        F.min(distance).alias("min_km"),
        F.max(distance).alias("max_km"),
        F.count(inside).alias("n_inside"),
        F.min(inside).alias("nearest_km"),
        F.avg(inside).alias("mean_inside_km"),
        nearest[name].alias("nearest_name"),
    )


def filter_funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each step applied in turn, all counted in one pass."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("n_rows")]
    for name, mask in steps.items():
        passed = passed & F.coalesce(mask, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return df.agg(*counts)
