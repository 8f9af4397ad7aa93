"""Incident filters and jobs over the event table."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.bindings import query, sql
from callejero.bindings.views import spark_view, table, with_views
from callejero.functions.clock import hour_of, to_hour_minute
from callejero.functions.dates import date_argument, within_months
from callejero.operators import filters
from callejero.operators.aggregates import filter_funnel
from callejero.operators.ordering import preview
from callejero.operators.roles import as_timestamp, parse_ratios
from callejero.operators.timestamps import build_ts
from callejero.plans import incidents as jobs
from callejero.session import scratch_dir

TARGET, MONTHS, HOUR, MARGIN = "2024-01-20", 2, (8, 30), 60
INCIDENTS = with_views("v_incidents")
COUNTS = with_views("v_counts")
ROW = "event_id, fecha, hora, calle, distrito"
IN_WINDOW = sql.window(sql.day("fecha"), TARGET, MONTHS)
PARTS_IN_WINDOW = sql.window(sql.parts("ano", "mes", "dia"), TARGET, 3)
DATE_OR_PARTS = f"(coalesce({sql.window(sql.day('fecha'), TARGET, 3)}, false) " \
                f"OR coalesce({PARTS_IN_WINDOW}, false))"
CELL_H, CELL_M = sql.cell_hour("hora", 1), sql.cell_hour("hora", 2)
STAMP_H, STAMP_M = f"hour({sql.stamp('fecha')})", f"minute({sql.stamp('fecha')})"


def _hour_exact(h: int, m: int) -> str:
    """Exact match per column; a column without any exact row matches on the hour."""
    exact = f"(coalesce({CELL_H} = {h} AND {CELL_M} = {m}, false))"
    ts_exact = f"(coalesce({STAMP_H} = {h} AND {STAMP_M} = {m}, false))"
    usable = f"(SELECT avg(CASE WHEN {sql.stamp('fecha')} IS NULL THEN 0 ELSE 1 END) > 0.5 FROM v_incidents)"
    return f"""(CASE WHEN (SELECT max({exact}) FROM v_incidents) THEN {exact}
                     ELSE coalesce({CELL_H} = {h}, false) END
             OR ({usable} AND CASE WHEN (SELECT max({ts_exact}) FROM v_incidents) THEN {ts_exact}
                     ELSE coalesce({STAMP_H} = {h}, false) END))"""


def _incidents(spark, sf_dir):
    return spark_view(spark, sf_dir, "v_incidents")


@query(f"{INCIDENTS} SELECT {ROW} FROM v_incidents WHERE {DATE_OR_PARTS}")
def q_date_window(spark, sf_dir):
    return filters.date_window(_incidents(spark, sf_dir), TARGET, 3).select(*ROW.split(", "))


@query(f"{INCIDENTS} SELECT {ROW} FROM v_incidents "
       f"WHERE {sql.day('fecha')} IS NULL OR {IN_WINDOW}")
def q_date_window_keep_null(spark, sf_dir):
    df = _incidents(spark, sf_dir)
    kept = filters.date_window_keep_null(df, as_timestamp(df, "fecha"), TARGET, MONTHS)
    return kept.select(*ROW.split(", "))


@query(f"{INCIDENTS} SELECT {ROW} FROM v_incidents WHERE {_hour_exact(8, 30)}")
def q_hour_exact(spark, sf_dir):
    return filters.hour_exact_or_hour(_incidents(spark, sf_dir), (8, 30)).select(*ROW.split(", "))


@query(f"{INCIDENTS} SELECT {ROW} FROM v_incidents WHERE {_hour_exact(8, 61)}")
def q_hour_exact_fallback(spark, sf_dir):
    """No row has minute 61, so every column falls back to the hour."""
    return filters.hour_exact_or_hour(_incidents(spark, sf_dir), (8, 61)).select(*ROW.split(", "))


@query(f"""{INCIDENTS} SELECT {ROW} FROM v_incidents
WHERE abs(hour({sql.split_stamp('fecha', 'hora')}) * 60
          + minute({sql.split_stamp('fecha', 'hora')}) - 510) <= {MARGIN}""")
def q_hour_margin(spark, sf_dir):
    df = _incidents(spark, sf_dir)
    return filters.hour_within(df, HOUR, MARGIN).select(*ROW.split(", "))


@query(f"""{COUNTS} SELECT event_id, datetime_origen AS hora_texto, tramo FROM v_counts
WHERE abs({sql.midpoint("substr(fecha_hora, 12, 5)")} - 510) <= {MARGIN}""")
def q_hour_margin_columns(spark, sf_dir):
    """No row of the table has a timestamp, so the hour columns are tested by themselves."""
    df = spark_view(spark, sf_dir, "v_counts").select(
        "event_id", F.col("datetime_origen").alias("hora_texto"), "tramo",
        F.expr("substr(fecha_hora, 12, 5)").alias("hora"),
    )
    kept = filters.hour_within(df, HOUR, MARGIN)
    return kept.select("event_id", "hora_texto", "tramo")


@query(f"""{INCIDENTS} SELECT {ROW} FROM v_incidents
WHERE contains({sql.fold('calle')}, 'alcala') OR contains({sql.fold('distrito')}, 'alcala')""")
def q_location_any(spark, sf_dir):
    return filters.location_any(_incidents(spark, sf_dir), " ALCALÁ ", K.PLACE_KEYS).select(
        *ROW.split(", ")
    )


@query(f"{INCIDENTS} SELECT event_id, fecha FROM v_incidents")
def q_location_missing_all(spark, sf_dir):
    """A table without location columns is left unfiltered under that policy."""
    df = _incidents(spark, sf_dir).select("event_id", "fecha")
    return filters.location_any(df, "alcala", K.STATION_KEYS, on_missing="all")


@query(f"""{INCIDENTS} SELECT event_id, 'con calle' AS tabla FROM v_incidents
WHERE contains({sql.fold('calle')}, 'alcala')""")
def q_location_missing_empty(spark, sf_dir):
    """Of a table with and one without location columns, the second is emptied."""
    df = _incidents(spark, sf_dir)
    parts = [
        filters.location_any(table, "alcala", K.STREET_KEYS).select("event_id", F.lit(label).alias("tabla"))
        for label, table in (("con calle", df.select("event_id", "calle")),
                             ("sin calle", df.select("event_id", "fecha")))
    ]
    return parts[0].unionByName(parts[1])


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-31' AND DATE '1998-05-31'""")
def q_date_window_typed(spark, sf_dir):
    """A stored timestamp is compared as it is, so that the scan prunes by the window."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("fecha"))
    kept = filters.date_window(orders, "1998-05-31", 2)
    return kept.select("o_orderkey", F.date_format("fecha", "yyyy-MM-dd").alias("fecha"))


@query(f"""{INCIDENTS} SELECT {ROW} FROM v_incidents
WHERE regexp_matches({sql.fold('calle')}, '^(gran|plaza) ')
   OR regexp_matches({sql.fold('distrito')}, '^(gran|plaza) ')""")
def q_location_regex(spark, sf_dir):
    return filters.location_any(
        _incidents(spark, sf_dir), "^(gran|plaza) ", K.PLACE_KEYS, regex=True
    ).select(*ROW.split(", "))


@query(f"""{INCIDENTS} SELECT {ROW} FROM v_incidents
WHERE contains({sql.fold('calle')} || ' ' || {sql.fold('distrito')}, 'via chamberi')""")
def q_location_joined(spark, sf_dir):
    return filters.location_joined(_incidents(spark, sf_dir), "Vía Chamberí").select(
        *ROW.split(", ")
    )


@query(f"""{COUNTS} SELECT event_id, {sql.stamp('fecha_hora')} IS NOT NULL AS parsed,
  strftime({sql.stamp('fecha_hora')}, '%Y-%m-%d %H:%M') AS ts FROM v_counts""")
def q_build_ts(spark, sf_dir):
    df = spark_view(spark, sf_dir, "v_counts")
    stamp = build_ts(df)
    return df.select(
        "event_id", stamp.isNotNull().alias("parsed"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm").alias("ts"),
    )


@query(f"""{INCIDENTS} SELECT event_id,
  strftime({sql.split_stamp('fecha', 'hora')}, '%Y-%m-%d %H:%M') AS ts FROM v_incidents""")
def q_build_ts_split(spark, sf_dir):
    df = _incidents(spark, sf_dir)
    return df.select("event_id", F.date_format(build_ts(df), "yyyy-MM-dd HH:mm").alias("ts"))


@query(f"""{INCIDENTS} SELECT
  round(avg(CASE WHEN {sql.stamp('fecha')} IS NULL THEN 0.0 ELSE 1.0 END), 6) AS fecha,
  round(avg(CASE WHEN {sql.stamp('hora')} IS NULL THEN 0.0 ELSE 1.0 END), 6) AS hora
FROM v_incidents""")
def q_ts_parse_ratio(spark, sf_dir):
    ratios = parse_ratios(_incidents(spark, sf_dir), ["fecha", "hora"])
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


@query(f"""{INCIDENTS} SELECT count(*) AS n_rows,
  count(*) FILTER (coalesce({IN_WINDOW}, false)) AS n_dated,
  count(*) FILTER (coalesce({IN_WINDOW}, false) AND contains({sql.fold('calle')}, 'gran via'))
    AS n_located,
  count(*) FILTER (coalesce({IN_WINDOW}, false) AND contains({sql.fold('calle')}, 'gran via')
    AND coalesce({CELL_H} = 8, false)) AS n_timed
FROM v_incidents""")
def q_filter_funnel(spark, sf_dir):
    df = _incidents(spark, sf_dir)
    inside = within_months(
        as_timestamp(df, "fecha").cast("date"), date_argument(TARGET), MONTHS
    )
    return filter_funnel(
        df,
        {
            "n_dated": inside,
            "n_located": filters.location_test(df, "gran vía", ["calle"]).mask,
            "n_timed": hour_of(to_hour_minute(F.col("hora"))) == 8,
        },
    )


@query(f"""{with_views('v_incidents', 'v_monthly')}
SELECT 'incidents' AS tabla, count(*) AS n FROM v_incidents
UNION ALL SELECT 'monthly', count(*) FILTER (false) FROM v_monthly""")
def q_event_gate(spark, sf_dir):
    counted = []
    for label in ("incidents", "monthly"):
        df = spark_view(spark, sf_dir, f"v_{label}")
        counted.append(
            filters.event_level_gate(df).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(label).alias("tabla"), "n")
        )
    return counted[0].unionByName(counted[1])


@query(f"{INCIDENTS} SELECT event_id, fecha, calle FROM v_incidents "
       "ORDER BY calle, fecha, event_id LIMIT 12")
def q_topn_preview(spark, sf_dir):
    df = _incidents(spark, sf_dir).select("event_id", "fecha", "calle")
    return preview(df, 12, "calle", "fecha", "event_id")


# --- jobs -----------------------------------------------------------------------

@query(f"""{INCIDENTS},
page_a AS (SELECT *, 'pagina-a' AS o, 'a.csv' AS d FROM v_incidents WHERE false),
page_a2 AS (SELECT *, 'pagina-a' AS o, 'a.json' AS d FROM v_incidents
  WHERE {DATE_OR_PARTS} AND contains({sql.fold('calle')}, 'castellana') AND {_hour_exact(8, 30)})
SELECT {ROW}, valor, o AS __origen__, d AS __descarga__ FROM page_a2
UNION ALL
SELECT {ROW}, NULL, 'pagina-b', 'b.csv' FROM v_incidents
WHERE coalesce({sql.window(sql.day('fecha'), TARGET, 3)}, false)
  AND contains({sql.fold('calle')}, 'castellana') AND {_hour_exact(8, 30)}""")
def q_accidents(spark, sf_dir):
    """Page a's first download has no street column and yields nothing, so its second counts."""
    df = _incidents(spark, sf_dir)
    sources = [
        jobs.Source(df.drop("calle"), "a.csv", "pagina-a"),
        jobs.Source(df, "a.json", "pagina-a"),
        jobs.Source(df.select(*ROW.split(", ")), "b.csv", "pagina-b"),
    ]
    out = jobs.accidents(sources, TARGET, "castellana", "8:30")
    return out.select(*ROW.split(", "), "valor", "__origen__", "__descarga__")


def _na(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR trim(CAST({x} AS STRING)) = '' THEN 'NA' " \
           f"ELSE CAST({x} AS STRING) END AS {x}"


_SPLIT = sql.split_stamp("fecha", "hora")
_DIRECT = sql.stamp("fecha_hora")


def _minute_gap(stamp: str) -> str:
    return f"abs(hour({stamp}) * 60 + minute({stamp}) - 510) <= {MARGIN}"


@query(f"""{with_views('v_incidents', 'v_counts')},
a AS (SELECT event_id, fecha, hora, calle, distrito, NULL AS fecha_hora, NULL AS tramo,
        NULL AS pk, NULL AS intensidad, 'incidentes' AS __fuente FROM v_incidents
      WHERE (coalesce({sql.window(f'CAST({_SPLIT} AS DATE)', TARGET, 2)}, false)
             OR {_SPLIT} IS NULL) AND {_minute_gap(_SPLIT)}
        AND contains({sql.fold('calle')} || ' ' || {sql.fold('distrito')}, 'castellana')),
b AS (SELECT event_id, NULL AS fecha, NULL AS hora, NULL AS calle, NULL AS distrito, fecha_hora,
        tramo, pk, intensidad, 'conteos' AS __fuente FROM v_counts
      WHERE (coalesce({sql.window(f'CAST({_DIRECT} AS DATE)', TARGET, 2)}, false)
             OR {_DIRECT} IS NULL) AND {_minute_gap(_DIRECT)}
        AND contains({sql.fold('tramo')} || ' ' || {sql.fold('pk')}, 'castellana')),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT {', '.join(_na(c) for c in ['event_id', 'fecha', 'hora', 'calle', 'distrito', 'fecha_hora',
                                   'tramo', 'pk', 'intensidad', '__fuente'])} FROM u""")
def q_traffic(spark, sf_dir):
    """Three sources: split date and hour, one datetime column, one switched off."""
    counts = spark_view(spark, sf_dir, "v_counts")
    sources = [
        jobs.Source(_incidents(spark, sf_dir).select(*ROW.split(", ")), "incidentes"),
        jobs.Source(counts.drop("datetime_origen"), "conteos"),
        jobs.Source(counts, "apagada", enabled=False),
    ]
    return jobs.traffic(sources, day=TARGET, hour="8.5", place="Castellana", months=2)


def _steps(view: str, stamp: str, place: str, link: str) -> str:
    dated = f"(coalesce({sql.window(f'CAST({stamp} AS DATE)', TARGET, 2)}, false) OR {stamp} IS NULL)"
    timed = f"coalesce({_minute_gap(stamp)}, false)"
    return f"""SELECT '{link}' AS fuente, count(*) AS n_rows, count(*) FILTER ({dated}) AS n_dated,
      count(*) FILTER ({dated} AND {timed}) AS n_timed,
      count(*) FILTER ({dated} AND {timed} AND contains({place}, 'castellana')) AS n_placed FROM {view}"""


@query(f"""{with_views('v_incidents', 'v_counts')}
{_steps('v_incidents', _SPLIT, f"{sql.fold('calle')} || ' ' || {sql.fold('distrito')}", 'incidentes')}
UNION ALL {_steps('v_counts', _DIRECT, f"{sql.fold('tramo')} || ' ' || {sql.fold('pk')}", 'conteos')}""")
def q_traffic_funnel(spark, sf_dir):
    """Rows left after each filter of the traffic job, counted while the job writes its result."""
    tables = {"incidentes": _incidents(spark, sf_dir).select(*ROW.split(", ")),
              "conteos": spark_view(spark, sf_dir, "v_counts").drop("datetime_origen")}
    funnels = {link: Observation(f"traffic {link}") for link in tables}
    out = jobs.traffic([jobs.Source(t, link) for link, t in tables.items()], funnels, day=TARGET, hour="8.5",
                       place="Castellana", months=2)
    out.write.parquet(scratch_dir(spark, "traffic"))
    rows = [(link, *[seen.get[c] for c in ("n_rows", "n_1", "n_2", "n_3")]) for link, seen in funnels.items()]
    return spark.createDataFrame(rows, "fuente string, n_rows bigint, n_dated bigint, n_timed bigint, n_placed bigint")


_CALLS = ["event_id", "fecha", "hora", "distrito", "__fuente"]


@query(f"""{INCIDENTS},
f AS (SELECT event_id, fecha, hora, distrito, 'llamadas' AS __fuente FROM v_incidents
  WHERE {sql.window(f'CAST({_SPLIT} AS DATE)', TARGET, 2)} AND hour({_SPLIT}) = 8
    AND contains({sql.fold('distrito')}, 'centro'))
SELECT {', '.join(_na(c) for c in _CALLS)} FROM f""")
def q_emergencies(spark, sf_dir):
    """Date, hour and district; the monthly table is gated away."""
    calls = _incidents(spark, sf_dir).select("event_id", "fecha", "hora", "distrito")
    sources = [
        jobs.Source(calls, "llamadas"),
        jobs.Source(spark_view(spark, sf_dir, "v_monthly").select("ano", "mes"), "mensual"),
    ]
    out = jobs.emergencies(sources, day=TARGET, hour="8", place="Centro", months=2)
    return out.select(*_CALLS)


@query(f"""{INCIDENTS},
f AS (SELECT event_id, fecha, hora, distrito, 'llamadas' AS __fuente FROM v_incidents
  WHERE coalesce(hour({sql.stamp('fecha')}), {sql.cell_hour('fecha', 1)}) = 8
     OR coalesce(hour({sql.stamp('hora')}), {CELL_H}) = 8)
SELECT {', '.join(_na(c) for c in _CALLS)} FROM f""")
def q_emergencies_hour(spark, sf_dir):
    """Hour without a date: any time column may hold it."""
    calls = _incidents(spark, sf_dir).select("event_id", "fecha", "hora", "distrito")
    return jobs.emergencies([jobs.Source(calls, "llamadas")], hour="8").select(*_CALLS)


@query(f"""{INCIDENTS},
f AS (SELECT event_id, fecha, hora, distrito, 'llamadas' AS __fuente FROM v_incidents
  WHERE {sql.window(sql.day('fecha'), TARGET, 0)})
SELECT {', '.join(_na(c) for c in _CALLS)} FROM f""")
def q_emergencies_day(spark, sf_dir):
    """Date without an hour, window of zero months."""
    calls = _incidents(spark, sf_dir).select("event_id", "fecha", "hora", "distrito")
    return jobs.emergencies([jobs.Source(calls, "llamadas")], day=TARGET, months=0).select(*_CALLS)


@query(f"""{INCIDENTS} SELECT {', '.join(_na(c) for c in ['event_id', 'calle', 'distrito'])},
  CAST(CAST(floor(valor) AS BIGINT) AS STRING) AS valor FROM v_incidents
WHERE contains({sql.fold('calle')}, 'balboa') OR contains({sql.fold('distrito')}, 'balboa')""")
def q_cameras(spark, sf_dir):
    df = _incidents(spark, sf_dir).select(
        "event_id", "calle", "distrito", F.floor("valor").cast("bigint").alias("valor")
    )
    return jobs.cameras(df, "núñez de BALBOA".split()[-1])


@query(f"""{INCIDENTS} SELECT {', '.join(_na(c) for c in ['event_id', 'hora', 'calle', 'distrito'])}
FROM v_incidents""")
def q_fill_sentinel(spark, sf_dir):
    from callejero.operators.reshape import fill_sentinel

    return fill_sentinel(_incidents(spark, sf_dir).select("event_id", "hora", "calle", "distrito"))
