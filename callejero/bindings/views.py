"""Messy-feed views over the benchmark tables, in SQL both engines read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_EVENT_TEXT = """
    SELECT event_id, user_id, event_type, value, CAST(ts AS STRING) AS t,
           CAST(substr(CAST(ts AS STRING), 12, 2) AS INT) AS h
    FROM {events}
"""
_DAY_FIRST = "substr(t, 9, 2) || '/' || substr(t, 6, 2) || '/' || substr(t, 1, 4)"

VIEWS = {
    # incidents with mixed date and hour spellings
    "v_incidents": f"""
SELECT event_id,
       CASE WHEN event_id % 17 = 0 THEN 'sin fecha'
            WHEN event_id % 2 = 0 THEN substr(t, 1, 10)
            ELSE {_DAY_FIRST} END AS fecha,
       CASE event_id % 7
            WHEN 0 THEN substr(t, 12, 5)
            WHEN 1 THEN CAST(h AS STRING)
            WHEN 2 THEN CAST(h AS STRING) || 'h' || substr(t, 15, 2)
            WHEN 3 THEN CAST(h AS STRING) || ',5'
            WHEN 4 THEN substr(t, 12, 2) || ':00-' || substr(t, 12, 2) || ':45'
            WHEN 5 THEN 's/h'
            ELSE NULL END AS hora,
       CASE user_id % 5
            WHEN 0 THEN 'Calle Alcalá'
            WHEN 1 THEN 'GRAN VÍA'
            WHEN 2 THEN 'Paseo de la Castellana'
            WHEN 3 THEN 'Plaza Mayor'
            ELSE ' Núñez de Balboa' END AS calle,
       CASE user_id % 3
            WHEN 0 THEN 'Centro' WHEN 1 THEN 'Chamberí' ELSE NULL END AS distrito,
       substr(t, 1, 4) AS ano,
       CASE WHEN event_id % 23 = 0 THEN '13' ELSE substr(t, 6, 2) END AS mes,
       substr(t, 9, 2) AS dia,
       value AS valor
FROM ({_EVENT_TEXT}) AS e
""",
    # date-times in one of two candidate columns; the first candidate never parses
    "v_counts": f"""
SELECT event_id,
       'pendiente' AS datetime_origen,
       CASE WHEN event_id % 4 = 3 THEN NULL
            WHEN event_id % 4 = 2 THEN substr(t, 1, 16)
            ELSE {_DAY_FIRST} || ' ' || substr(t, 12, 8) END AS fecha_hora,
       CASE user_id % 4
            WHEN 0 THEN 'M-30 Norte' WHEN 1 THEN 'Túnel de María' ELSE 'Castellana' END AS tramo,
       CASE user_id % 3 WHEN 0 THEN '12+500' ELSE NULL END AS pk,
       CAST(floor(value) AS INT) AS intensidad
FROM ({_EVENT_TEXT}) AS e
""",
    # counts per month only: no date or hour of an event
    "v_monthly": """
SELECT substr(CAST(ts AS STRING), 1, 4) AS ano, substr(CAST(ts AS STRING), 6, 2) AS mes,
       event_type AS tipo, count(*) AS total
FROM {events}
GROUP BY substr(CAST(ts AS STRING), 1, 4), substr(CAST(ts AS STRING), 6, 2), event_type
""",
    # text of every shape a user or a cell may hold for an hour, a date or a number
    "v_spellings": f"""
SELECT event_id,
       CASE event_id % 12
            WHEN 0 THEN substr(t, 12, 2)
            WHEN 1 THEN CAST(h AS STRING) || ':' || substr(t, 15, 2)
            WHEN 2 THEN CAST(h AS STRING) || 'h' || substr(t, 15, 2)
            WHEN 3 THEN CAST(h AS STRING) || 'h'
            WHEN 4 THEN CAST(h AS STRING) || '.5'
            WHEN 5 THEN CAST(h AS STRING) || ',25'
            WHEN 6 THEN CAST(h AS STRING) || '.999'
            WHEN 7 THEN ''
            WHEN 8 THEN 'mañana'
            WHEN 9 THEN ' ' || CAST(h AS STRING) || ' : ' || substr(t, 15, 2) || ' '
            WHEN 10 THEN CAST(h AS STRING) || ':' || substr(t, 15, 2) || '.5'
            ELSE CAST(h + 20 AS STRING) END AS entrada,
       CASE event_id % 13
            WHEN 0 THEN CAST(h AS STRING) || '.5'
            WHEN 1 THEN CAST(h AS STRING) || '.30'
            WHEN 2 THEN substr(t, 12, 2) || substr(t, 15, 2)
            WHEN 3 THEN CAST(h AS STRING) || '30'
            WHEN 4 THEN CAST(h AS STRING) || '.999'
            WHEN 5 THEN CAST(h AS STRING) || ' H ' || substr(t, 15, 2)
            WHEN 6 THEN substr(t, 1, 16)
            WHEN 7 THEN {_DAY_FIRST} || ' ' || substr(t, 12, 8)
            WHEN 8 THEN 'a las ' || substr(t, 12, 5) || ' horas'
            WHEN 9 THEN CAST(1 + h % 12 AS STRING) || ':' || substr(t, 15, 2) || ' pm'
            WHEN 10 THEN NULL
            WHEN 11 THEN substr(t, 12, 8)
            ELSE 'noche' END AS celda,
       CASE event_id % 9
            WHEN 0 THEN substr(t, 12, 2) || ':00-' || substr(t, 12, 2) || ':15'
            WHEN 1 THEN substr(t, 12, 5) || ' - 01:00'
            WHEN 2 THEN CAST(h AS STRING) || 'h' || substr(t, 15, 2)
            WHEN 3 THEN CAST(h AS STRING) || ':5'
            WHEN 4 THEN CAST(h AS STRING) || ',5'
            WHEN 5 THEN CAST(h AS STRING) || '.999'
            WHEN 6 THEN CAST(h + 3 AS STRING)
            WHEN 7 THEN '8:75'
            ELSE 'x' END AS franja,
       CASE event_id % 11
            WHEN 0 THEN substr(t, 1, 10)
            WHEN 1 THEN substr(t, 1, 16)
            WHEN 2 THEN substr(t, 1, 19)
            WHEN 3 THEN {_DAY_FIRST}
            WHEN 4 THEN {_DAY_FIRST} || ' ' || substr(t, 12, 5)
            WHEN 5 THEN substr(t, 9, 2) || '-' || substr(t, 6, 2) || '-' || substr(t, 1, 4)
            WHEN 6 THEN '31/02/' || substr(t, 1, 4)
            WHEN 7 THEN substr(t, 1, 4) || '-13-01'
            WHEN 8 THEN substr(t, 12, 5)
            WHEN 9 THEN ' ' || CAST(h + 1 AS STRING) || '/1/' || substr(t, 1, 4) || ' '
            ELSE 'ayer' END AS fecha_texto,
       CASE event_id % 8
            WHEN 0 THEN CAST(h AS STRING) || ',5'
            WHEN 1 THEN '-' || CAST(h AS STRING) || '.25'
            WHEN 2 THEN CAST(h AS STRING) || 'f'
            WHEN 3 THEN '1,5e1'
            WHEN 4 THEN ''
            WHEN 5 THEN 'N/V'
            WHEN 6 THEN '1.234,5'
            ELSE ',5' END AS numero,
       substr(t, 1, 4) AS ano,
       CASE WHEN event_id % 5 = 0 THEN '13' WHEN event_id % 5 = 1 THEN 'enero'
            ELSE CAST(1 + h % 12 AS STRING) END AS mes,
       CAST(1 + (user_id % 31) AS STRING) AS dia
FROM ({_EVENT_TEXT}) AS e
""",
    # transit feed
    "v_trips": """
SELECT 'R' || CAST(o_custkey % 37 AS STRING) AS route_id,
       'S' || CAST(o_custkey % 10 AS STRING) AS service_id,
       CAST(o_orderkey AS STRING) AS trip_id,
       o_orderpriority AS trip_headsign,
       CAST(o_orderkey % 2 AS INT) AS direction_id
FROM {orders}
""",
    "v_calendar": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS service_id,
       CAST(s_suppkey % 2 AS INT) AS monday,
       CAST((s_suppkey + 1) % 2 AS INT) AS tuesday,
       CAST(s_suppkey % 2 AS INT) AS wednesday,
       CAST((s_suppkey + 1) % 2 AS INT) AS thursday,
       CAST(CASE WHEN s_suppkey % 5 = 4 THEN 0 ELSE 1 END AS INT) AS friday,
       CAST(CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS saturday,
       CAST(0 AS INT) AS sunday,
       CAST(19950101 + s_suppkey % 28 AS INT) AS start_date,
       CAST(CASE WHEN s_suppkey % 6 = 3 THEN 19980101 ELSE 20011231 END AS INT) AS end_date
FROM {supplier}
""",
    "v_calendar_dates": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS service_id,
       CAST(CASE WHEN s_suppkey % 7 IN (0, 5, 6) THEN 19980529 ELSE 19970101 END AS INT) AS date,
       CAST(CASE WHEN s_suppkey % 7 = 0 THEN 2 ELSE 1 END AS INT) AS exception_type
FROM {supplier}
""",
    "v_stop_times": """
SELECT CAST(l_orderkey AS STRING) AS trip_id,
       CAST(20 + l_linenumber AS STRING) || ':05:00' AS arrival_time,
       CAST(20 + l_linenumber AS STRING) || ':06:00' AS departure_time,
       'P' || CAST(l_partkey AS STRING) AS stop_id,
       CAST(l_linenumber AS INT) AS stop_sequence
FROM {lineitem}
""",
    "v_stops": """
SELECT 'P' || CAST(p_partkey AS STRING) AS stop_id, p_name AS stop_name,
       CASE WHEN p_partkey % 50 = 7 THEN 'bad'
            ELSE '40.' || CAST(300 + p_partkey % 200 AS STRING) END AS stop_lat,
       CASE WHEN p_partkey % 61 = 9 THEN NULL
            ELSE '-3.' || CAST(600 + p_partkey % 300 AS STRING) END AS stop_lon
FROM {part}
""",
    # air quality measurements and snapshots
    "v_air": """
SELECT l_orderkey AS registro, CAST(l_linenumber AS INT) AS linea,
       substr(CAST(l_shipdate AS STRING), 1, 10) AS fecha,
       CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '6' WHEN 3 THEN '7' WHEN 4 THEN '8'
            WHEN 5 THEN '9' WHEN 6 THEN '10'
            ELSE CASE WHEN l_orderkey % 2 = 0 THEN '12' ELSE '99' END END AS magnitud,
       CASE WHEN l_orderkey % 11 = 0 THEN 'N/V'
            WHEN l_orderkey % 13 = 0 THEN ''
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) || ','
                 || CAST(l_partkey % 10 AS STRING) END AS valor,
       CASE WHEN l_suppkey % 5 = 0 THEN 'x'
            ELSE CAST(l_suppkey % 40 AS STRING) || ',5' END AS h01,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL
            ELSE CAST(l_partkey % 50 AS STRING) END AS h02,
       CASE WHEN l_suppkey % 10 = 0 THEN ''
            ELSE CAST(l_partkey % 30 AS STRING) || '.25' END AS hora_03,
       CASE l_suppkey % 4 WHEN 0 THEN 'Plaza de España' WHEN 1 THEN 'Méndez Álvaro'
            WHEN 2 THEN 'Retiro' ELSE 'Casa de Campo' END AS estacion
FROM {lineitem}
""",
    "v_snapshot": """
SELECT c_custkey, 'https://example.org/aqi/' || CAST(c_custkey AS STRING) AS __fuente,
       y || '-' || m || '-' || d AS fecha, '18:55' AS hora, 'Panel' AS origen,
       CAST(c_custkey % 520 AS STRING) AS aqi,
       pm25_raw, pm25_unit, CASE WHEN pm25_unit = 'µg/m³' THEN pm25_raw END AS pm25_ugm3,
       pm10_raw, pm10_unit, CASE WHEN pm10_unit = 'µg/m³' THEN pm10_raw END AS pm10_ugm3,
       o3_raw, o3_unit, CASE WHEN o3_unit = 'µg/m³' THEN o3_raw END AS o3_ugm3,
       no2_raw, no2_unit, CASE WHEN no2_unit = 'µg/m³' THEN no2_raw END AS no2_ugm3,
       so2_raw, so2_unit, CASE WHEN so2_unit = 'µg/m³' THEN so2_raw END AS so2_ugm3,
       co_raw, co_unit, CASE WHEN co_unit = 'µg/m³' THEN co_raw END AS co_ugm3
FROM (
  SELECT c_custkey,
         CAST(1995 + c_custkey % 6 AS STRING) AS y,
         substr(CAST(101 + c_custkey % 12 AS STRING), 2, 2) AS m,
         substr(CAST(101 + c_custkey % 28 AS STRING), 2, 2) AS d,
         CAST(c_custkey % 90 AS STRING) || '.5' AS pm25_raw, 'µg/m³' AS pm25_unit,
         CAST(c_custkey % 70 AS STRING) AS pm10_raw,
         CASE WHEN c_custkey % 3 = 0 THEN 'ppm' ELSE 'µg/m³' END AS pm10_unit,
         CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE CAST(c_custkey % 60 AS STRING) END AS o3_raw,
         CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE 'µg/m³' END AS o3_unit,
         CAST(c_custkey % 50 AS STRING) AS no2_raw, 'µg/m³' AS no2_unit,
         CAST(NULL AS STRING) AS so2_raw, CAST(NULL AS STRING) AS so2_unit,
         CAST(c_custkey % 11 AS STRING) || '.25' AS co_raw, 'ppm' AS co_unit
  FROM {customer}
) AS c
""",
    # pollutant named by code or only in words
    "v_pollutant": """
SELECT p_partkey,
       CASE p_partkey % 4 WHEN 0 THEN CAST(1 + p_partkey % 14 AS STRING)
            WHEN 1 THEN 'n/d' ELSE NULL END AS magnitud,
       CASE p_partkey % 9
            WHEN 0 THEN 'Ozono troposférico' WHEN 1 THEN 'Partículas PM 2,5'
            WHEN 2 THEN 'Dióxido de Nitrógeno' WHEN 3 THEN 'Dioxido de azufre'
            WHEN 4 THEN 'Monóxido de carbono' WHEN 5 THEN 'PM10 y PM2.5'
            WHEN 6 THEN 'Benceno' WHEN 7 THEN 'NO2 en Cuatro Caminos'
            ELSE p_type END AS descripcion
FROM {part}
""",
    # car parks with text coordinates, some zero or missing
    "v_parking": """
SELECT c_custkey AS pk, c_name AS nombre, c_mktsegment AS via,
       CASE WHEN c_custkey % 50 = 0 THEN '0' WHEN c_custkey % 59 = 0 THEN 'sin dato'
            ELSE CAST(40.4168e0 + (c_custkey % 201 - 100) * 3e-4 AS STRING) END AS lat,
       CASE WHEN c_custkey % 53 = 0 THEN NULL
            ELSE CAST(-3.7038e0 + (c_custkey % 157 - 78) * 3e-4 AS STRING) END AS lon
FROM {customer}
""",
    "v_climate_daily": """
SELECT d AS fecha, 'MADRID, RETIRO' AS nombre, '3195' AS indicativo,
       CAST(n % 40 AS STRING) || ',' || CAST(n % 10 AS STRING) AS tmed,
       CAST(hi AS STRING) || ',0' AS tmax,
       CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(lo AS STRING) || ',5' END AS tmin,
       substr(last_t, 12, 5) AS horatmax, substr(first_t, 12, 5) AS horatmin,
       CASE WHEN n % 4 = 0 THEN 'Ip' ELSE '0,0' END AS prec,
       '1,1' AS velmedia, '3,9' AS racha, '17' AS dir, '17:20' AS horaracha,
       '947,3' AS presMax, '944,6' AS presMin, CAST(NULL AS STRING) AS sol
FROM (
  SELECT substr(CAST(ts AS STRING), 1, 10) AS d, count(*) AS n,
         CAST(floor(max(value)) AS BIGINT) AS hi, CAST(floor(min(value)) AS BIGINT) AS lo,
         max(CAST(ts AS STRING)) AS last_t, min(CAST(ts AS STRING)) AS first_t
  FROM {events} GROUP BY substr(CAST(ts AS STRING), 1, 10)
) AS g
""",
    "v_climate_monthly": """
SELECT y || '-' || m AS fecha,
       CASE WHEN n % 5 = 0 THEN NULL WHEN n % 7 = 0 THEN '13'
            ELSE CAST(CAST(m AS INT) AS STRING) END AS mes,
       CAST(n % 30 AS STRING) || '.5' AS tm_mes, CAST(n % 40 AS STRING) || '.0' AS tm_max,
       CAST(n % 15 AS STRING) || '.1' AS tm_min,
       CAST(n % 45 AS STRING) || '.9(' || m || ')' AS ta_max,
       CASE WHEN n % 2 = 0 THEN NULL ELSE CAST(n % 9 AS STRING) || '.0(02)' END AS ta_min,
       CAST(n % 100 AS STRING) AS hr, '0.0' AS p_mes, CAST(NULL AS STRING) AS n_sol
FROM (
  SELECT substr(CAST(o_orderdate AS STRING), 1, 4) AS y,
         substr(CAST(o_orderdate AS STRING), 6, 2) AS m, count(*) AS n
  FROM {orders}
  GROUP BY substr(CAST(o_orderdate AS STRING), 1, 4), substr(CAST(o_orderdate AS STRING), 6, 2)
) AS g
""",
    # pages with a data link, a data attribute, or both kinds of noise
    "v_pages": """
SELECT page_id, url,
       html || CASE page_id % 3
         WHEN 0 THEN '<button class="b" data-url="/descarga/' || CAST(page_id AS STRING)
              || '.csv" data-href="/otro">x</button><p data-url="/mapa/wms">y</p>'
         WHEN 1 THEN '<div data-href="//cdn.example.org/' || CAST(page_id AS STRING)
              || '.zip"></div><a href="https://example.org/datos?x=1&amp;f=json">Mapa</a>'
         ELSE '<a class="d" title="a > b &amp; href=/no" href="/download/' || CAST(page_id AS STRING)
              || '.csv">Descarga  <b>datos</b> de &oacute;rdenes &#233;</a><a href="//cdn.example.org/d/'
              || CAST(page_id AS STRING) || '.json">json</a>' END AS html
FROM {pages}
""",
    # what the servers answered for the data links of v_pages, one row per link
    "v_answers": """
SELECT DISTINCT href, href AS final_url, CAST(NULL AS STRING) AS disposition,
       CASE page_id % 3 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'text/html' ELSE NULL END AS content_type,
       CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS status
FROM (
  SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/descarga/' || CAST(page_id AS STRING) || '.csv' AS href
  FROM {pages} WHERE page_id % 3 = 0
  UNION ALL SELECT page_id + 1, 'https://cdn.example.org/' || CAST(page_id AS STRING) || '.zip' FROM {pages} WHERE page_id % 3 = 1
  UNION ALL SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/download/' || CAST(page_id AS STRING) || '.csv'
  FROM {pages} WHERE page_id % 3 = 2
  UNION ALL SELECT page_id + 1, 'https://cdn.example.org/d/' || CAST(page_id AS STRING) || '.json' FROM {pages} WHERE page_id % 3 = 2
) AS links
""",
    # what the servers answered for the links of a crawl
    "v_responses": """
SELECT page_id,
       CASE page_id % 6 WHEN 0 THEN 'text/csv; charset=utf-8' WHEN 1 THEN 'application/json'
            WHEN 2 THEN 'application/geo+json' WHEN 3 THEN 'application/zip'
            WHEN 4 THEN 'Application/Octet-Stream' ELSE NULL END AS content_type,
       CASE page_id % 5 WHEN 0 THEN 'attachment; filename="DATOS.CSV"'
            WHEN 1 THEN 'inline; filename = plano.pdf; size=3'
            WHEN 2 THEN 'attachment; filename=lote.zip' ELSE NULL END AS disposition,
       CASE page_id % 7 WHEN 0 THEN url || '.csv' WHEN 1 THEN url || '/f.geojson'
            WHEN 2 THEN url || '/f.ZIP' ELSE url END AS final_url
FROM {pages}
""",
    # program output naming files, and page text with air readings
    "v_logs": """
SELECT conv_id, turn,
       text || ' [OK] Guardado: "/datos/bus/Resultados/salida_' || CAST(conv_id AS STRING)
            || '.csv" y file:///tmp/a_' || CAST(turn AS STRING) || '.CSV, luego C:' || chr(92) || 'x'
            || chr(92) || 'b.csv. '
            || 'Otra vez /datos/bus/Resultados/salida_' || CAST(conv_id AS STRING)
            || '.csv); fin' AS registro
FROM {conversations}
""",
    "v_panels": """
SELECT doc_id, source,
       text || CASE doc_id % 5
         WHEN 0 THEN ' Hoy 28 AQI. PM 2.5 12,5 µg/m³ O3 40 ug/m3'
         WHEN 1 THEN ' aqi 105aqi PM10: media 33 µg/m³, máxima PM10 41.5 UG/M3'
         WHEN 2 THEN ' 1234 AQI CO 0,3 ppm y NO 2 alto NO2 18 µg/m³'
         WHEN 3 THEN ' 301  AQI SO2 sin dato'
         ELSE ' PM2.5 7 ppm PM 2.5 9 µg/m³' END AS texto
FROM {documents}
""",
    # result files of several producers
    "v_paths": """
SELECT doc_id,
       CASE doc_id % 8
         WHEN 0 THEN '/p/Trafico_Scripts/Resultados/traffic_filtrado.csv'
         WHEN 1 THEN '/p/Camaras/Resultados/dataset_' || CAST(doc_id AS STRING) || '.csv'
         WHEN 2 THEN '/p/otros/' || lang || '/' || source || '.csv'
         WHEN 3 THEN '/p/x/Carpeta_con_un_nombre_realmente_muy_largo_para_hoja/r.csv'
         WHEN 4 THEN 'suelto_' || lang || '.v2.csv'
         WHEN 5 THEN '/p/CALIDAD_AIRE/bus.csv'
         WHEN 6 THEN '/p/clima/aemet.csv'
         ELSE '/p/Accidentes/' || source || '/a.csv' END AS ruta
FROM {documents}
""",
    # traffic by segment and crashes: likelier at rush hours and under dense traffic
    "v_flows": f"""
SELECT event_id, 'T' || CAST(user_id % 40 AS STRING) AS tramo, {_DAY_FIRST} || ' ' || substr(t, 12, 8) AS fecha_hora,
       CAST(floor(value) AS INT) AS intensidad
FROM ({_EVENT_TEXT}) AS e
""",
    "v_crashes": f"""
SELECT event_id, 'T' || CAST(user_id % 40 AS STRING) AS tramo, substr(t, 1, 10) AS fecha, substr(t, 12, 5) AS hora
FROM ({_EVENT_TEXT}) AS e
WHERE (value > 60 AND h IN (7, 8, 9, 17, 18, 19, 20)) OR (value > 85 AND user_id % 40 < 12) OR event_id % 37 = 0
""",
    # stations that send late or twice, one of them most of the time
    "v_readings": """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'E0' WHEN event_id % 41 = 1 THEN NULL
            ELSE 'E' || CAST(user_id % 17 AS STRING) END AS estacion,
       CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 19 = 0 THEN ts - INTERVAL '2' HOUR
            WHEN event_id % 23 = 0 THEN ts + INTERVAL '5' HOUR ELSE ts END AS momento,
       CAST(floor(value) AS BIGINT) * 20 AS segundos
FROM {events}
""",
    # a feed with repeated rows, repeated keys, nulls and blanks
    "v_repeated": """
SELECT event_id AS ficha, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' ELSE event_type END AS tipo,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS usuario, props AS detalle
FROM {events}
UNION ALL SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' ELSE event_type END,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS INT) END, props
FROM {events} WHERE event_id % 10 = 0
UNION ALL SELECT event_id, 'otra', CAST(user_id AS INT), props FROM {events} WHERE event_id % 11 = 0
""",
    # car parks with the district they say they are in, one in seven of them wrong
    "v_declared": """
SELECT c_custkey AS pk, CAST(c_custkey % 201 - 100 AS INT) AS i, CAST(c_custkey % 157 - 78 AS INT) AS j,
       40.4168e0 + (c_custkey % 201 - 100) * 3e-4 AS lat, -3.7038e0 + (c_custkey % 157 - 78) * 3e-4 AS lon,
       CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN 'D99' ELSE 'D' || CAST((
         CAST(floor((c_custkey % 157 - 78 + 75) / 30e0) AS INT) + 5 * CAST(floor((c_custkey % 201) / 40e0) AS INT)
         + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) % 25 AS STRING) END AS distrito
FROM {customer}
""",
    # outlines and holes of districts in steps of a grid that the car parks stand on; some have an exclave
    "v_rings": """
SELECT 'D' || CAST(n_nationkey AS STRING) AS distrito, 0 AS pieza, anillo, paso,
       40.4168e0 + (ci + di) * 3e-4 AS lat, -3.7038e0 + (cj + dj) * 3e-4 AS lon
FROM (SELECT n_nationkey, CAST(floor(n_nationkey / 5e0) AS INT) * 40 - 80 AS ci, (n_nationkey % 5) * 30 - 60 AS cj FROM {nation}) AS n
JOIN (VALUES (0, 0, -20, -15), (0, 1, -20, 15), (0, 2, 20, 11), (0, 3, 20, -15), (0, 4, -20, -15),
             (1, 0, -4, -4), (1, 1, 4, -4), (1, 2, 4, 4), (1, 3, -4, 4), (1, 4, -4, -4)) AS r (anillo, paso, di, dj) ON anillo >= 0
UNION ALL
SELECT 'D' || CAST(n_nationkey AS STRING), 1, 0, paso, 40.4168e0 + (CAST(floor(n_nationkey / 5e0) AS INT) * 40 - 80 + di) * 3e-4,
       -3.7038e0 + ((n_nationkey % 5) * 30 - 45 + dj) * 3e-4
FROM {nation} JOIN (VALUES (0, 0, 0), (1, 9, 3), (2, 3, 9), (3, 0, 0)) AS r (paso, di, dj) ON n_nationkey % 4 = 1
""",
    # a listing of archive members; every order is one member of its customer's archive
    "v_manifest": """
SELECT 'lote-' || substr(CAST(101 + o_custkey % 12 AS STRING), 2, 2) || '-'
         || CAST(1995 + o_custkey % 7 AS STRING) || '-' || CAST(o_custkey AS STRING)
         || '.zip' AS archive,
       substr(CAST(o_orderdate AS STRING), 1, 7) || '/parte_' || CAST(o_orderkey AS STRING)
         || '.csv' AS member,
       CAST(floor(o_totalprice * 200) AS BIGINT) AS size,
       o_orderkey AS pos
FROM {orders}
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the Parquet tables in ``sf_dir``."""
    text = VIEWS[name]
    used = set(re.findall(r"\{(\w+)\}", text))
    tables = {t: table(spark, sf_dir, t) for t in used}
    return spark.sql(text, **tables)


def with_views(*names: str) -> str:
    """``WITH v AS (...), ...`` over registered tables, ready for more SQL after it."""
    tables = {t: t for t in TABLES}
    return "WITH " + ",\n".join(
        f"{n} AS ({VIEWS[n].format(**tables)})" for n in names
    )
