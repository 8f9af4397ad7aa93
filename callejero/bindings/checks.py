"""Checks of a data set: duplicates and nulls, times, places, and what lies nearest."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero.bindings import query
from callejero.bindings.places import PARKING
from callejero.bindings.views import spark_view, with_views
from callejero.operators import profile
from callejero.operators.neighbours import knn
from callejero.operators.regions import locate, outside_declared
from callejero.operators.timechecks import consistency, out_of_order
from callejero.plans import parking as jobs
from callejero.session import scratch_dir
from callejero.sources.readers import read_geojson_features

REPEATED = with_views("v_repeated")


def _measures(name: str, kind: str, text: bool) -> str:
    blank = f"count(*) FILTER (trim({name}) = '')" if text else "CAST(0 AS BIGINT)"
    return f"""SELECT '{name}' AS column_name, '{kind}' AS kind, count(*) AS n_rows,
      count(*) FILTER ({name} IS NULL) AS n_null, {blank} AS n_empty,
      CAST(min({name}) AS VARCHAR) AS least, CAST(max({name}) AS VARCHAR) AS most FROM v_repeated"""


@query(REPEATED + " UNION ALL ".join([
    _measures("ficha", "bigint", False), _measures("tipo", "string", True),
    _measures("usuario", "int", False), _measures("detalle", "string", True)]))
def q_profile(spark, sf_dir):
    """Nulls, blanks and extremes of every column, from one pass; the sketches are tested beside."""
    found = profile.columns_profile(spark_view(spark, sf_dir, "v_repeated"))
    return profile.with_estimates(found).select("column_name", "kind", "n_rows", "n_null", "n_empty", "least", "most")


@query(f"""{REPEATED}, d AS (SELECT count(*) AS n FROM v_repeated GROUP BY ficha, tipo, usuario, detalle),
k AS (SELECT count(*) AS n FROM v_repeated GROUP BY ficha HAVING count(*) > 1)
SELECT (SELECT count(*) FROM v_repeated) AS n_rows, (SELECT CAST(sum(n - 1) AS BIGINT) FROM d) AS n_repeated_rows,
  (SELECT count(*) FROM k) AS n_repeated_keys, (SELECT CAST(sum(n) AS BIGINT) FROM k) AS n_rows_of_repeated_keys""")
def q_duplicates(spark, sf_dir):
    return profile.duplicates(spark_view(spark, sf_dir, "v_repeated"), ["ficha"])


LIMIT_S = 1800
READINGS = with_views("v_readings") + f""", a AS (
  SELECT *, max(momento) OVER (PARTITION BY estacion ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM v_readings),
s AS (SELECT *, max(epoch_us(momento) + segundos * 1000000) OVER (PARTITION BY estacion ORDER BY momento, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM v_readings WHERE momento IS NOT NULL),
g AS (SELECT *, (epoch_us(momento) - ended) / 1e6 AS since FROM s),
late AS (SELECT estacion, count(*) AS n_rows, count(*) FILTER (momento < latest) AS n_out_of_order,
  count(*) FILTER (momento IS NULL) AS n_undated FROM a GROUP BY estacion),
spans AS (SELECT estacion, count(*) FILTER (since > {LIMIT_S}) AS n_gaps, max(since) FILTER (since > {LIMIT_S}) AS longest_gap_s,
  count(*) FILTER (since < 0) AS n_overlaps, count(*) FILTER (since IS NULL OR since > {LIMIT_S}) AS n_islands FROM g GROUP BY estacion)"""


@query(f"""{READINGS} SELECT late.*, n_gaps, round(longest_gap_s, 3) AS longest_gap_s, n_overlaps, n_islands
FROM late LEFT JOIN spans ON late.estacion IS NOT DISTINCT FROM spans.estacion""")
def q_time_consistency(spark, sf_dir):
    """Per station: stamps out of order, gaps of half an hour, overlapping spells, spells without a gap between them."""
    rows = spark_view(spark, sf_dir, "v_readings")
    found = consistency(rows, "estacion", "event_id", "momento", F.col("segundos"), LIMIT_S)
    return found.withColumn("longest_gap_s", F.round("longest_gap_s", 3))


@query(f"""{READINGS} SELECT event_id, estacion, strftime(momento, '%Y-%m-%d %H:%M:%S') AS momento,
  strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest_before FROM a WHERE momento < latest""")
def q_out_of_order(spark, sf_dir):
    """Rows whose stamp is before one that came earlier from the same station."""
    rows = out_of_order(spark_view(spark, sf_dir, "v_readings"), "estacion", ["event_id"], "momento").filter("out_of_order")
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("momento", "latest_before")}
    return rows.select("event_id", "estacion", "momento", "latest_before").withColumns(shown)


# edges of all rings, and for each point and region the polygons that hold it
DISTRICTS = with_views("v_declared", "v_rings") + """, edges AS (
  SELECT a.distrito AS d, a.pieza, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2
  FROM v_rings a JOIN v_rings b ON a.distrito = b.distrito AND a.pieza = b.pieza AND a.anillo = b.anillo AND b.paso = a.paso + 1),
crossed AS (
  SELECT pk, distrito, d, pieza, lon AS x, lat AS y, x1, y1, x2, y2, (x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1) AS c
  FROM v_declared JOIN edges ON true),
judged AS (
  SELECT pk, distrito, d, pieza,
    count(*) FILTER ((y1 > y) <> (y2 > y) AND CASE WHEN y2 > y1 THEN c > 0 ELSE c < 0 END) % 2 = 1
    OR bool_or(c = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS hit
  FROM crossed GROUP BY pk, distrito, d, pieza),
held AS (SELECT DISTINCT pk, distrito, d FROM judged WHERE hit)"""
GEOJSON = ("features array<struct<type:string,properties:struct<id:string>,"
           "geometry:struct<type:string,coordinates:array<array<array<double>>>>>>")


def _districts(spark, sf_dir):
    """Polygons of the districts, by way of a GeoJSON file."""
    path = scratch_dir(spark, "districts")
    rings = spark_view(spark, sf_dir, "v_rings").groupBy("distrito", "pieza", "anillo").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("paso", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"])).alias("ring"))
    shapes = rings.groupBy("distrito", "pieza").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("anillo", "ring"))), lambda r: r["ring"]).alias("rings"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("distrito").alias("id")).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geometry"))
    shapes.select(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")).write.json(path)
    found = read_geojson_features(spark, path, GEOJSON, multi_line=False)
    return found.select(F.col("`properties.id`").alias("id"), F.col("`geometry.coordinates`").alias("rings"))


@query(f"""{DISTRICTS} SELECT pk, distrito FROM v_declared WHERE distrito IN (SELECT d FROM edges)
AND NOT EXISTS (SELECT 1 FROM held WHERE held.pk = v_declared.pk AND held.d = v_declared.distrito)""")
def q_outside_district(spark, sf_dir):
    """Car parks that lie outside the district they declare; some stand on an edge or in a hole."""
    points = spark_view(spark, sf_dir, "v_declared")
    return outside_declared(points, _districts(spark, sf_dir), "lat", "lon", "distrito", "id", "rings").select("pk", "distrito")


@query(f"{DISTRICTS} SELECT pk, d AS id FROM held")
def q_points_in_districts(spark, sf_dir):
    """Every district that holds a car park."""
    points = spark_view(spark, sf_dir, "v_declared").select("pk", "lat", "lon")
    return locate(points, _districts(spark, sf_dir), "lat", "lon", "id", "rings").select("pk", "id")


def _between(a: str, b: str) -> str:
    p1, p2 = f"radians({a}.latitud)", f"radians({b}.latitud)"
    half = f"((radians({b}.longitud) - radians({a}.longitud)) / 2)"
    arc = (f"(sin(({p2} - {p1}) / 2) * sin(({p2} - {p1}) / 2) + cos({p1}) * cos({p2}) * sin({half}) * sin({half}))")
    return f"(6371e0 * 2 * atan2(sqrt({arc}), sqrt(1 - {arc})))"


@query(f"""{PARKING}, pairs AS (SELECT a.pk AS query, b.pk AS neighbour, round({_between('a', 'b')}, 9) AS d
  FROM located a JOIN located b ON a.pk <> b.pk)
SELECT query, neighbour, CAST(r AS INT) AS rank, round(d, 6) AS distance_km FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, neighbour) AS r FROM pairs) WHERE r <= 3""")
def q_knn(spark, sf_dir):
    """The three car parks nearest to each one."""
    found = jobs.located(spark_view(spark, sf_dir, "v_parking").toDF("PK", "Nombre", "Via.1", "COORDENADA-Y", "COORDENADA-X"))
    near = knn(found, found, 3, "pk", "latitud", "longitud", apart=True)
    return near.withColumn("distance_km", F.round("distance_km", 6))
