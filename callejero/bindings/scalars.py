"""Scalar functions over whole tables of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from callejero.bindings import query, sql
from callejero.bindings.views import spark_view, table, with_views
from callejero.functions import air, clock, dates, labels, numbers, text

SPELLINGS = with_views("v_spellings")
INPUT = "replace(replace(replace(lower(trim(entrada)), ' ', ''), ',', '.'), 'h', ':')"
COLON = r"'^(\d+):(\d*\.?\d*)$'"
DECIMAL = r"'^\d+(\.\d+)?$'"


def _spellings(spark, sf_dir):
    return spark_view(spark, sf_dir, "v_spellings")


@query(f"""{SPELLINGS}, p AS (
  SELECT event_id, entrada, {INPUT} AS s FROM v_spellings
), q AS (
  SELECT event_id, entrada,
    CASE WHEN regexp_matches(s, {COLON}) THEN CAST(regexp_extract(s, {COLON}, 1) AS INT)
         WHEN regexp_matches(s, {DECIMAL}) THEN CAST(floor(CAST(s AS DOUBLE)) AS INT) END AS h,
    CASE WHEN regexp_matches(s, {COLON}) THEN
           CASE WHEN regexp_extract(s, {COLON}, 2) = '' THEN 0
                ELSE {sql.half_even(f"CAST(regexp_extract(s, {COLON}, 2) AS DOUBLE)")} END
         WHEN regexp_matches(s, {DECIMAL})
           THEN {sql.half_even("(CAST(s AS DOUBLE) - floor(CAST(s AS DOUBLE))) * 60")} END AS m
  FROM p
)
SELECT event_id, entrada,
  CAST(CASE WHEN h * 60 + m < 1440 AND m <= 60 THEN (h * 60 + m) // 60 * 100 + (h * 60 + m) % 60
       END AS INT) AS hhmm
FROM q""")
def q_parse_hour(spark, sf_dir):
    return _spellings(spark, sf_dir).select(
        "event_id", "entrada", clock.parse_hour_input(F.col("entrada")).alias("hhmm")
    )


@query(f"""{SPELLINGS} SELECT event_id, celda, CAST({sql.cell_hour('celda', 1)} AS INT) AS hour,
  CAST({sql.cell_hour('celda', 2)} AS INT) AS minute FROM v_spellings""")
def q_to_hour_minute(spark, sf_dir):
    cell = clock.to_hour_minute(F.col("celda"))
    return _spellings(spark, sf_dir).select(
        "event_id", "celda", clock.hour_of(cell).alias("hour"), clock.minute_of(cell).alias("minute")
    )


@query(f"{SPELLINGS} SELECT event_id, franja, {sql.midpoint('franja')} AS minuto FROM v_spellings")
def q_time_midpoint(spark, sf_dir):
    return _spellings(spark, sf_dir).select(
        "event_id", "franja", clock.time_midpoint(F.col("franja")).alias("minuto")
    )


@query(rf"""{SPELLINGS} SELECT event_id, fecha_texto,
  strftime({sql.stamp('fecha_texto')}, '%Y-%m-%d %H:%M:%S') AS momento,
  {sql.iso(sql.day('fecha_texto'))} AS dia,
  strftime(try_strptime(trim(fecha_texto), '%Y-%m-%d'), '%Y-%m-%d') AS iso,
  CASE WHEN fecha_texto = trim(fecha_texto) THEN
    strftime(try_strptime(fecha_texto, '%d/%m/%Y'), '%Y-%m-%d') END AS estricta
FROM v_spellings""")
def q_parse_dates(spark, sf_dir):
    c = F.col("fecha_texto")
    return _spellings(spark, sf_dir).select(
        "event_id", "fecha_texto",
        F.date_format(dates.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss").alias("momento"),
        dates.parse_date_iso_or_dayfirst(c).cast("string").alias("dia"),
        dates.parse_date_input(c).cast("string").alias("iso"),
        dates.parse_date_strict_dayfirst(c).cast("string").alias("estricta"),
    )


@query(f"""{SPELLINGS} SELECT event_id, ano, mes, dia, {sql.iso(sql.parts('ano', 'mes', 'dia'))}
  AS fecha FROM v_spellings""")
def q_date_parts(spark, sf_dir):
    made = dates.date_from_parts(F.col("ano"), F.col("mes"), F.col("dia"))
    return _spellings(spark, sf_dir).select(
        "event_id", "ano", "mes", "dia", made.cast("string").alias("fecha")
    )


@query(f"""{SPELLINGS} SELECT event_id, numero, {sql.number('numero')} AS punto,
  {sql.comma('numero')} AS coma FROM v_spellings""")
def q_decimal_comma(spark, sf_dir):
    return _spellings(spark, sf_dir).select(
        "event_id", "numero", numbers.coerce_number(F.col("numero")).alias("punto"),
        numbers.decimal_comma(F.col("numero")).alias("coma"),
    )


_DOC_FOLD = (r"strip_accents(lower(regexp_replace(coalesce(text, ''), "
             r"'^\s+|\s+$', '', 'g')))")


@query(f"SELECT doc_id, md5({_DOC_FOLD}) AS folded, {sql.fold('lang')} AS lang FROM documents")
def q_fold_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.md5(text.fold_text(F.col("text"))).alias("folded"),
        text.fold_text(F.col("lang")).alias("lang"),
    )


@query(f"""SELECT doc_id,
  md5(trim(regexp_replace({_DOC_FOLD}, '[^a-z0-9]+', '_', 'g'), '_')) AS slug,
  CASE WHEN trim(regexp_replace({sql.fold("regexp_replace(text, '[A-Za-z]+', '', 'g')")},
         '[^a-z0-9]+', '_', 'g'), '_') = '' THEN 'ubicacion'
       ELSE trim(regexp_replace({sql.fold("regexp_replace(text, '[A-Za-z]+', '', 'g')")},
         '[^a-z0-9]+', '_', 'g'), '_') END AS slug_or_default
FROM documents""")
def q_slug(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bare = F.regexp_replace("text", "[A-Za-z]+", "")
    return docs.select(
        "doc_id", F.md5(text.slug(F.col("text"))).alias("slug"),
        text.slug(bare, default="ubicacion").alias("slug_or_default"),
    )


@query(r"""SELECT c_custkey, CAST(c_custkey % 520 AS STRING) || CASE WHEN c_custkey % 7 = 0
    THEN '.0' WHEN c_custkey % 11 = 0 THEN 'x' ELSE '' END AS aqi,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL
       WHEN c_custkey % 520 <= 50 THEN 'Buena' WHEN c_custkey % 520 <= 100 THEN 'Moderada'
       WHEN c_custkey % 520 <= 150 THEN 'Perjudicial para grupos sensibles'
       WHEN c_custkey % 520 <= 200 THEN 'Mala' WHEN c_custkey % 520 <= 300 THEN 'Muy mala'
       WHEN c_custkey % 520 <= 500 THEN 'Peligrosa' END AS categoria
FROM customer""")
def q_aqi_category(spark, sf_dir):
    aqi = F.expr("""concat(CAST(c_custkey % 520 AS STRING), CASE WHEN c_custkey % 7 = 0
        THEN '.0' WHEN c_custkey % 11 = 0 THEN 'x' ELSE '' END)""")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", aqi.alias("aqi"))
    return customers.withColumn("categoria", air.aqi_category(F.col("aqi")))


_LABEL_CASE = " ".join(
    f"WHEN contains(lower(ruta), '{part}') THEN '{label}'"
    for part, label in [
        ("trafico", "trafico_historico"), ("traffic", "trafico_historico"),
        ("vehiculos", "vehiculos_por_distrito"), ("parking", "vehiculos_por_distrito"),
        ("transporte", "transporte_publico"), ("bus", "transporte_publico"),
        ("metro", "transporte_publico"), ("emergenc", "emergencias"), ("clima", "clima"),
        ("aemet", "clima"), ("radar", "radares"), ("camara", "radares"),
        ("calidad_aire", "calidad_aire"), ("accidente", "accidentes"),
    ]
)


@query(rf"""{with_views('v_paths')} SELECT doc_id, ruta, CASE {_LABEL_CASE}
  WHEN contains(ruta, '/') AND regexp_extract(lower(ruta), '([^/]*)/[^/]*$', 1) <> ''
    THEN regexp_extract(lower(ruta), '([^/]*)/[^/]*$', 1)
  ELSE regexp_extract(ruta, '([^/]+)\.[^.]*$', 1) END AS dataset FROM v_paths""")
def q_dataset_label(spark, sf_dir):
    paths = spark_view(spark, sf_dir, "v_paths")
    return paths.withColumn("dataset", labels.dataset_label(F.col("ruta")))


@query(r"""{v}, m AS (
  SELECT conv_id, turn, regexp_extract_all(registro,
    '(?i)((?:[A-Za-z]:\\|/)?[^\s"<>|]+?\.csv)', 1) AS found FROM v_logs
), e AS (
  SELECT conv_id, turn, i, replace(trim(trim(found[i], '"'), ''''), 'file:///', '') AS path
  FROM m, unnest(range(1, len(found) + 1)) AS r(i)
), f AS (
  SELECT conv_id, turn, path, min(i) AS first_at FROM e GROUP BY ALL
)
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY first_at) - 1
  AS INT) AS pos, path FROM f""".replace("{v}", with_views("v_logs")))
def q_csv_paths(spark, sf_dir):
    logs = spark_view(spark, sf_dir, "v_logs")
    return logs.select(
        "conv_id", "turn",
        F.posexplode(labels.extract_csv_paths(F.col("registro"))).alias("pos", "path"),
    )


@query(r"""SELECT o_orderkey,
  strftime(try_strptime(strftime(o_orderdate, '%d/%m/%Y') || ' ' || lpad(CAST(o_custkey % 24
    AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0'),
    '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS ts FROM orders""")
def q_date_and_hour_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fecha = F.date_format("o_orderdate", "dd/MM/yyyy")
    hora = F.concat_ws(":", (F.col("o_custkey") % 24).cast("string"),
                       F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"))
    stamp = dates.text_date_and_hour(fecha, hora)
    return orders.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm").alias("ts"))
