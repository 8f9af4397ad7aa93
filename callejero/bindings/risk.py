"""Incident probability over the events: the feature table, and the forest's answer for held-out days."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero.bindings import query
from callejero.bindings.sql import stamp
from callejero.bindings.views import spark_view, with_views
from callejero.functions.dates import parse_timestamp
from callejero.functions.numbers import decimal_comma
from callejero.plans import risk
from callejero.session import scratch_dir

FEATURES = with_views("v_flows", "v_crashes", "v_climate_daily") + f""", flow AS (
  SELECT tramo AS place, epoch_us({stamp('fecha_hora')}) // 3600000000 AS slot, count(*) AS n_counts,
    round(avg(intensidad), 6) AS mean_intensity, max(intensidad) AS max_intensity FROM v_flows GROUP BY 1, 2),
hit AS (SELECT tramo AS place, epoch_us({stamp("fecha || ' ' || hora")}) // 3600000000 AS slot, count(*) AS n_incidents
  FROM v_crashes GROUP BY 1, 2),
cells AS (SELECT *, sum(n_incidents) OVER w AS ri, avg(mean_intensity) OVER w AS rm FROM flow FULL JOIN hit USING (place, slot)
  WINDOW w AS (PARTITION BY place ORDER BY slot RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING)),
known AS (SELECT CAST({stamp('fecha')} AS DATE) AS day, round(avg(try_cast(replace(tmed, ',', '.') AS DOUBLE)), 6) AS temperature
  FROM v_climate_daily GROUP BY 1)
SELECT place, slot, strftime(c.day, '%Y-%m-%d') AS day, n_counts, mean_intensity, max_intensity, CAST(slot % 24 AS INT) AS hour,
  CAST(isodow(c.day) AS INT) AS weekday, temperature, CAST(coalesce(ri, 0) AS BIGINT) AS recent_incidents,
  coalesce(round(rm, 6), 0) AS recent_intensity, CASE WHEN n_incidents > 0 THEN 1 ELSE 0 END AS label
FROM (SELECT *, CAST(make_timestamp(slot * 3600000000) AS DATE) AS day FROM cells WHERE n_counts IS NOT NULL) c
LEFT JOIN known ON known.day = c.day"""


def features(spark, sf_dir):
    counts = spark_view(spark, sf_dir, "v_flows").select(
        F.col("tramo").alias("place"), parse_timestamp(F.col("fecha_hora")).alias("stamp"), F.col("intensidad").alias("intensity"))
    crashes = spark_view(spark, sf_dir, "v_crashes").select(
        F.col("tramo").alias("place"), parse_timestamp(F.concat_ws(" ", "fecha", "hora")).alias("stamp"))
    weather = spark_view(spark, sf_dir, "v_climate_daily").select(
        F.to_date(parse_timestamp(F.col("fecha"))).alias("day"), decimal_comma(F.col("tmed")).alias("temperature"))
    return risk.incident_features(counts, crashes, weather)


@query(FEATURES)
def q_incident_features(spark, sf_dir):
    """Traffic, calendar, weather and what happened lately, by segment and hour."""
    return features(spark, sf_dir).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def held_out(spark, sf_dir, **settings):
    """Days held out, judged by a forest of the days before."""
    path = scratch_dir(spark, "features")
    features(spark, sf_dir).write.parquet(path)
    known = spark.read.parquet(path)
    later = F.col("day") >= risk.split_day(known)
    model = risk.fit(known.filter(~later), **settings)
    return risk.probabilities(model, known.filter(later))


@query()
def q_incident_forest(spark, sf_dir):
    """Probability of an incident in each segment and hour of the last quarter."""
    return held_out(spark, sf_dir).select("place", "slot", "label", F.round("probability", 6).alias("probability"))
