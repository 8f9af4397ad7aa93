"""Car parks over the customer table."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero.bindings import query, sql
from callejero.bindings.views import spark_view, table, with_views
from callejero.operators.aggregates import distance_bands, distance_stats
from callejero.operators.filters import with_distance
from callejero.operators.ordering import nearest
from callejero.operators.reshape import add_missing, ordered_distinct
from callejero.operators.roles import address_column, col, name_column
from callejero.plans import parking as jobs

PARKING = with_views("v_parking") + f""", located AS (
  SELECT pk, nombre, via, la AS latitud, lo AS longitud,
         {sql.haversine('la', 'lo')} AS distancia_centro_km
  FROM (SELECT *, try_cast(lat AS DOUBLE) AS la, try_cast(lon AS DOUBLE) AS lo FROM v_parking)
  WHERE la <> 0 AND lo <> 0
)"""
OUT = ["pk", "nombre_del_parking", "via_1", "latitud", "longitud", "distancia_centro_km"]
COLUMNS = """pk, nombre AS nombre_del_parking, via AS via_1, round(latitud, 6) AS latitud,
  round(longitud, 6) AS longitud, round(distancia_centro_km, 6) AS distancia_centro_km"""


def _raw(spark, sf_dir):
    """Column names as messy as the feed's."""
    df = spark_view(spark, sf_dir, "v_parking")
    return df.toDF("PK", " Nombre del Parking", "Via.1", "COORDENADA-Y", "COORDENADA-X")


def _rounded(df, *extra):
    numbers = ("latitud", "longitud", "distancia_centro_km")
    return df.select(*OUT, *extra).withColumns({c: F.round(c, 6) for c in numbers})


@query(f"{PARKING} SELECT {COLUMNS} FROM located WHERE distancia_centro_km <= 1.5")
def q_radius(spark, sf_dir):
    return _rounded(jobs.parking_in_radius(_raw(spark, sf_dir)))


@query(f"""{PARKING} SELECT pk, nombre AS nombre_del_parking, round(latitud, 6) AS latitud,
  round(longitud, 6) AS longitud, 'all' AS scope FROM located""")
def q_radius_fallback(spark, sf_dir):
    """Nothing lies near the other city asked for, so every located car park is kept."""
    out = jobs.parking_or_all(_raw(spark, sf_dir), centre=(41.3874, 2.1686))
    return out.select(
        "pk", "nombre_del_parking", F.round("latitud", 6).alias("latitud"),
        F.round("longitud", 6).alias("longitud"), "scope",
    )


@query(f"{PARKING} SELECT {COLUMNS}, 'radius' AS scope FROM located "
       "WHERE distancia_centro_km <= 1.5")
def q_radius_or_all(spark, sf_dir):
    return _rounded(jobs.parking_or_all(_raw(spark, sf_dir)), "scope")


@query(f"""{PARKING} SELECT pk, nombre AS nombre_del_parking,
  round(distancia_centro_km, 6) AS distancia_centro_km FROM located
ORDER BY located.distancia_centro_km, pk LIMIT 5""")
def q_nearest5(spark, sf_dir):
    found = with_distance(jobs.located(_raw(spark, sf_dir)))
    name = name_column(found.columns)
    return nearest(found, 5, "distancia_centro_km", "pk").select(
        "pk", name, F.round("distancia_centro_km", 6).alias("distancia_centro_km")
    )


@query(f"""{PARKING} SELECT count(*) FILTER (distancia_centro_km <= 0.5) AS within_0_5_km,
  count(*) FILTER (distancia_centro_km <= 1.0) AS within_1_0_km,
  count(*) FILTER (distancia_centro_km <= 1.5) AS within_1_5_km,
  count(*) FILTER (distancia_centro_km <= 2.0) AS within_2_0_km FROM located""")
def q_distance_bands(spark, sf_dir):
    return distance_bands(with_distance(jobs.located(_raw(spark, sf_dir))))


@query(f"""{PARKING} SELECT round(min(distancia_centro_km), 6) AS min_km,
  round(max(distancia_centro_km), 6) AS max_km,
  count(*) FILTER (distancia_centro_km <= 1.5) AS n_inside,
  round(min(distancia_centro_km) FILTER (distancia_centro_km <= 1.5), 6) AS nearest_km,
  round(avg(distancia_centro_km) FILTER (distancia_centro_km <= 1.5), 6) AS mean_inside_km,
  (SELECT nombre FROM located WHERE distancia_centro_km <= 1.5
   ORDER BY distancia_centro_km, pk LIMIT 1) AS nearest_name
FROM located""")
def q_distance_stats(spark, sf_dir):
    found = with_distance(jobs.located(_raw(spark, sf_dir)))
    stats = distance_stats(found, name_column(found.columns), "pk")
    numbers = ("min_km", "max_km", "nearest_km", "mean_inside_km")
    return stats.withColumns({c: F.round(c, 6) for c in numbers})


@query(f"""{PARKING} SELECT pk, nombre AS name, via AS address, CAST(NULL AS INT) AS plazas FROM located""")
def q_name_and_address(spark, sf_dir):
    """The columns that hold names and addresses, and one the table lacks."""
    found = jobs.located(_raw(spark, sf_dir))
    name, address = name_column(found.columns), address_column(found.columns)
    return add_missing(found, {"plazas": "int"}).select(
        "pk", col(name).alias("name"), col(address).alias("address"), "plazas"
    )


@query("""SELECT event_type, min(event_id) AS event_id FROM events GROUP BY event_type""")
def q_ordered_distinct(spark, sf_dir):
    """Distinct values, each with the position it first stands at."""
    return ordered_distinct(table(spark, sf_dir, "events"), "event_type", "event_id")


@query(f"""{PARKING} SELECT count(*) AS n, count(*) AS n_stamped, 1 AS n_runs FROM located""")
def q_extraction_ts(spark, sf_dir):
    """Every row carries the one time of extraction of its run."""
    return jobs.located(_raw(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("n"), F.count("fecha_extraccion").alias("n_stamped"),
        F.countDistinct("fecha_extraccion").cast("int").alias("n_runs"),
    )

