"""Air quality over line items (measurements), customers (snapshots) and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero import constants as K
from callejero.bindings import query, sql
from callejero.bindings.views import spark_view, with_views
from callejero.functions import air as air_functions
from callejero.operators.reshape import only_if_empty, snapshot_to_long
from callejero.plans import air as jobs

TARGET, MONTHS = "1998-05-31", 3
AIR = with_views("v_air")
BOTH = with_views("v_air", "v_snapshot")
BANDS = " ".join(
    f"WHEN CAST(aqi AS INT) <= {high} THEN '{name}'"
    for high, name in [(50, "Buena"), (100, "Moderada"),
                       (150, "Perjudicial para grupos sensibles"), (200, "Mala"),
                       (300, "Muy mala"), (500, "Peligrosa")]
)
POLLUTANT = """CASE magnitud WHEN '1' THEN 'so2' WHEN '6' THEN 'co' WHEN '7' THEN 'no'
  WHEN '8' THEN 'no2' WHEN '9' THEN 'o3' WHEN '10' THEN 'pm10' WHEN '12' THEN 'pm25' END"""
HOURS = [sql.comma(c) for c in ("h01", "h02", "hora_03")]
HOURLY = (
    "CASE WHEN " + " OR ".join(f"({h}) IS NOT NULL" for h in HOURS) + " THEN ("
    + " + ".join(f"coalesce({h}, 0)" for h in HOURS) + ") / ("
    + " + ".join(f"CASE WHEN ({h}) IS NULL THEN 0 ELSE 1 END" for h in HOURS) + ") END"
)
# an empty value cell is a known but missing value: it stops the search
VALUE = f"CASE WHEN valor = '' THEN NULL ELSE coalesce({sql.comma('valor')}, {HOURLY}) END"
HAS_VALUE = f"(valor = '' OR coalesce({sql.comma('valor')}, {HOURLY}) IS NOT NULL)"
DAILY = f"""daily AS (
  SELECT CAST(fecha AS DATE) AS fecha, {POLLUTANT} AS pollutant, avg({VALUE}) AS open_value,
         CASE WHEN {POLLUTANT} = 'co' THEN 'mg/m³' ELSE 'µg/m³' END AS open_unit
  FROM v_air
  WHERE {{where}} AND {POLLUTANT} IS NOT NULL AND {HAS_VALUE}
  GROUP BY ALL
)"""
PLACE = f"contains({sql.fold('estacion')}, 'retiro')"
AT_PLACE = f"{sql.window('CAST(fecha AS DATE)', TARGET, MONTHS)} AND {PLACE}"
LONG = "snap AS (" + "\nUNION ALL\n".join(
    f"""SELECT CAST(fecha AS DATE) AS fecha, '{p}' AS pollutant,
  try_cast({p}_ugm3 AS DOUBLE) AS acc_value_ugm3, nullif({p}_raw, 'NA') AS acc_raw,
  nullif({p}_unit, 'NA') AS acc_unit, aqi, CASE {BANDS} END AS aqi_category FROM v_snapshot"""
    for p in K.SNAPSHOT_POLLUTANTS
) + ")"


def _snapshots(spark, sf_dir):
    df = spark_view(spark, sf_dir, "v_snapshot").drop("c_custkey")
    return df.withColumn("aqi_category", air_functions.aqi_category(F.col("aqi")))


def _measurements(spark, sf_dir, **criteria):
    table = spark_view(spark, sf_dir, "v_air")
    return jobs.open_measurements(table, "medidas.csv", months=MONTHS, **criteria)


def _printable(df):
    return df.withColumn("fecha", F.col("fecha").cast("string"))


@query(f"""{with_views('v_pollutant')} SELECT p_partkey, CASE
  WHEN regexp_matches(magnitud, '^[0-9]+$') THEN {POLLUTANT}
  ELSE CASE {' '.join(f"WHEN contains(lower(concat_ws(' ', CAST(p_partkey AS STRING), magnitud, descripcion)), {sql.quoted(s)}) THEN '{p}'" for s, p in K.POLLUTANT_SPELLINGS)} END
END AS pollutant FROM v_pollutant""")
def q_pollutant(spark, sf_dir):
    df = spark_view(spark, sf_dir, "v_pollutant")
    return df.select("p_partkey", air_functions.pollutant_of(df.columns).alias("pollutant"))


@query(f"""{AIR} SELECT registro, linea, valor, round(CASE WHEN valor = '' THEN NULL ELSE
  coalesce({sql.comma('valor')}, {HOURLY}) END, 6) AS medida, NOT {HAS_VALUE} AS sin_valor
FROM v_air""")
def q_air_value(spark, sf_dir):
    df = spark_view(spark, sf_dir, "v_air")
    value = air_functions.row_value(df.columns)
    return df.select("registro", "linea", "valor", value.alias("v")).select(
        "registro", "linea", "valor", F.round(F.nanvl("v", F.lit(None)), 6).alias("medida"),
        F.col("v").isNull().alias("sin_valor"),
    )


@query(f"""{AIR}, {DAILY.format(where=AT_PLACE)}
SELECT {sql.iso('fecha')} AS fecha, pollutant, round(open_value, 6) AS open_value, open_unit
FROM daily""")
def q_air_daily(spark, sf_dir):
    means = jobs.daily_means(_measurements(spark, sf_dir, day=TARGET, place="Retiro"))
    return _printable(means.withColumn("open_value", F.round("open_value", 6)))


@query(f"""{with_views('v_snapshot')}, {LONG}
SELECT {sql.iso('fecha')} AS fecha, pollutant, acc_value_ugm3, acc_raw, acc_unit, aqi, aqi_category
FROM snap""")
def q_air_long(spark, sf_dir):
    return _printable(snapshot_to_long(_snapshots(spark, sf_dir)))


@query(f"""{BOTH}, {LONG}, {DAILY.format(where='true')}
SELECT {sql.iso('daily.fecha')} AS fecha, daily.pollutant, round(open_value, 6) AS open_value,
  open_unit, acc_value_ugm3, acc_raw, acc_unit, aqi, aqi_category,
  round(CASE WHEN open_unit = 'µg/m³' THEN acc_value_ugm3 - open_value END, 6)
    AS delta_ugm3_acc_minus_open
FROM daily LEFT JOIN snap ON daily.fecha = snap.fecha AND daily.pollutant = snap.pollutant""")
def q_air_compare(spark, sf_dir):
    means = jobs.daily_means(_measurements(spark, sf_dir))
    out = jobs.compare(means, snapshot_to_long(_snapshots(spark, sf_dir)))
    rounded = {c: F.round(c, 6) for c in ("open_value", "delta_ugm3_acc_minus_open")}
    return _printable(out.withColumns(rounded))


@query(f"""{with_views('v_snapshot')}, {LONG}
SELECT {sql.iso('fecha')} AS fecha, pollutant, 'NA' AS open_value, 'NA' AS open_unit,
  round(try_cast(acc_value_ugm3 AS DOUBLE), 6) AS acc_value_ugm3,
  coalesce(acc_raw, 'NA') AS acc_raw, coalesce(acc_unit, 'NA') AS acc_unit, aqi,
  coalesce(aqi_category, 'NA') AS aqi_category, 'NA' AS delta_ugm3_acc_minus_open FROM snap""")
def q_air_fallback(spark, sf_dir):
    """No measurement falls in the window, so the snapshot rows stand alone."""
    tables = {"medidas.csv": spark_view(spark, sf_dir, "v_air")}
    out = jobs.air_comparison(tables, _snapshots(spark, sf_dir), day="1980-01-01")
    return out.withColumn("acc_value_ugm3", F.round(F.col("acc_value_ugm3").try_cast("double"), 6))


@query(f"""{with_views('v_snapshot', 'v_air')} SELECT 'con filas' AS principal, count(*) FILTER (false) AS n FROM v_snapshot
UNION ALL SELECT 'vacia', count(*) FROM v_snapshot""")
def q_only_if_empty(spark, sf_dir):
    """Nothing of the fallback is used while the primary has rows, all of it when it has none."""
    snapshots, measured = _snapshots(spark, sf_dir), spark_view(spark, sf_dir, "v_air")
    parts = [only_if_empty(snapshots, primary).agg(F.count(F.lit(1)).alias("n")).select(F.lit(case).alias("principal"), "n")
             for case, primary in (("con filas", measured), ("vacia", measured.where("linea < 0")))]
    return parts[0].unionByName(parts[1])


_LOG = ["__fuente", "fecha", "hora", "origen", "aqi", "aqi_category", "co_raw", "registro",
        "linea", "magnitud", "valor", "estacion", "__fecha_dt"]


@query(f"""{BOTH}, u AS (
  SELECT __fuente, fecha, hora, origen, aqi, CASE {BANDS} END AS aqi_category, co_raw,
    NULL AS registro, NULL AS linea, NULL AS magnitud, NULL AS valor, NULL AS estacion,
    NULL AS __fecha_dt
  FROM v_snapshot
  UNION ALL
  SELECT 'medidas.csv', fecha, NULL, 'DatosAbiertosMadrid', NULL, NULL, NULL, registro, linea,
    magnitud, valor, estacion, fecha FROM v_air WHERE {AT_PLACE}
  UNION ALL
  SELECT 'por-partes.csv', lpad(CAST(CASE WHEN linea > 0 THEN 1998 END AS STRING), 4, '0') || '-05-'
    || lpad(CAST(linea AS STRING), 2, '0'), NULL, 'DatosAbiertosMadrid', NULL, NULL, NULL,
    registro, linea, magnitud, valor, NULL,
    '1998-05-' || lpad(CAST(linea AS STRING), 2, '0') FROM v_air
)
SELECT {', '.join(f"coalesce(CASE WHEN trim(CAST({c} AS STRING)) <> '' THEN CAST({c} AS STRING) END, 'NA') AS {c}" for c in _LOG)} FROM u""")
def q_air_log(spark, sf_dir):
    """Snapshots, a dated table at a place, and a table whose date is in three columns."""
    air = spark_view(spark, sf_dir, "v_air")
    by_parts = air.select("registro", "linea", "magnitud", "valor",
                          F.lit("1998").alias("ANO"), F.lit("5").alias("MES"),
                          F.col("linea").alias("DIA"))
    snapshots = _snapshots(spark, sf_dir)
    log = jobs.air_log({"medidas.csv": air}, snapshots, TARGET, "retiro", MONTHS)
    parts = jobs.air_log({"por-partes.csv": by_parts}, snapshots.where("false"))
    return log.select(*_LOG).unionByName(
        parts.withColumn("estacion", F.lit("NA")).select(*_LOG)
    )


_SPELL = [("PM 2.5", "pm25"), ("PM 2,5", "pm25"), ("PM2.5", "pm25"), ("PM 10", "pm10"),
          ("PM10", "pm10"), ("O3", "o3"), ("O 3", "o3"), ("NO2", "no2"), ("NO 2", "no2"),
          ("SO2", "so2"), ("SO 2", "so2"), ("CO", "co")]


def _last(spelling: str, group: int) -> str:
    name = spelling.replace(".", r"\.")
    pattern = rf"(?is){name}.{{0,300}}?(\d+(?:[.,]\d+)?)\s*(µg/m³|μg/m³|ug/m3|ppm)"
    return f"list_extract(regexp_extract_all(texto, '{pattern}', {group}), -1)"


def _measure(pollutant: str, group: int) -> str:
    tries = [_last(s, group) for s, p in reversed(_SPELL) if p == pollutant]
    found = f"coalesce({', '.join(tries)})"
    return (f"replace({found}, ',', '.')" if group == 1
            else f"replace(lower({found}), 'ug/m3', 'µg/m³')")


@query(f"""{with_views('v_panels')}, p AS (
  SELECT doc_id, source, nullif(regexp_extract(texto, '(?i)\\b(\\d{{1,3}})\\s*AQI\\b', 1), '') AS aqi,
    {', '.join(f"{_measure(p, 1)} AS {p}_raw, {_measure(p, 2)} AS {p}_unit" for p in K.SNAPSHOT_POLLUTANTS)}
  FROM v_panels)
SELECT source AS __fuente, doc_id, CASE {BANDS} END AS aqi_category, aqi,
  {', '.join(f"{p}_raw, {p}_unit, CASE WHEN {p}_unit = 'µg/m³' THEN {p}_raw END AS {p}_ugm3" for p in K.SNAPSHOT_POLLUTANTS)}
FROM p WHERE aqi IS NOT NULL OR {' OR '.join(f'{p}_raw IS NOT NULL' for p in K.SNAPSHOT_POLLUTANTS)}""")
def q_aqi_text(spark, sf_dir):
    panels = spark_view(spark, sf_dir, "v_panels")
    parsed = jobs.parse_snapshots(panels, "texto", "doc_id", "source", "source", "Panel")
    return parsed.withColumnRenamed("fecha", "doc_id").drop("hora", "origen")
