import datetime as dt

import pytest
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.operators import filters, joins, links, ordering, reshape, roles, transit
from callejero.operators.timestamps import build_ts
from callejero.plans import air, incidents, parking


def test_roles():
    assert roles.timestamp_columns(["Fecha", "HORA", "x"]) == ["Fecha"]
    assert roles.timestamp_columns(["Fecha", "HORA", "x"], wide=True) == ["Fecha", "HORA"]
    assert roles.date_parts(["AÑO", "Mes", "DIA"]) == ("AÑO", "Mes", "DIA")
    assert roles.date_parts(["ano", "mes"]) is None
    assert roles.coordinate_columns(["coordenada-x", "coordenada-y", "latitud", "longitud"]) == (
        "latitud", "longitud")
    assert not roles.is_event_level(["año", "mes", "total"])
    assert not roles.is_event_level(["franja"]) and roles.is_event_level(["franja"], True)


def test_unusable_date_columns_and_missing_ones(spark):
    rows = [("2024-01-10", "x"), ("x", "x"), ("x", "x")]
    df = spark.createDataFrame(rows, "fecha string, nota string")
    assert filters.date_window(df, "2024-01-20").count() == 0  # a third parses: not usable
    assert filters.date_window(df.select("nota"), "2024-01-20").count() == 0
    undated = filters.date_window_keep_null(df, roles.as_timestamp(df, "fecha"), "2024-01-20")
    assert undated.count() == 3


def test_hour_exact_falls_back_per_column(spark):
    df = spark.createDataFrame([("8:30", "8:10"), ("8:05", "9:00"), ("7:00", "8:45")],
                               "hora string, hora_acc string")
    # the first column has an exact row, the second only matches on the hour
    kept = {tuple(r) for r in filters.hour_exact_or_hour(df, (8, 30)).collect()}
    assert kept == {("8:30", "8:10"), ("7:00", "8:45")}
    assert filters.hour_exact_or_hour(df.select(F.lit(1).alias("n")), (8, 30)).count() == 3


def test_build_ts_skips_candidates_that_never_parse(spark):
    df = spark.createDataFrame([("x", "01/02/2024 08:30", "2020-01-01"), ("x", None, "2020-01-01")],
                               "datetime string, fecha_hora string, fecha string")
    got = [r.t for r in df.select(build_ts(df).alias("t")).collect()]
    assert got == [dt.datetime(2024, 2, 1, 8, 30), None]


def test_location_policies(spark):
    df = spark.createDataFrame([("Gran Vía", "Centro"), ("Mayor", "Sol")],
                               "calle string, distrito string")
    assert filters.location_any(df, "via", K.PLACE_KEYS).count() == 1
    assert filters.location_joined(df, "vía centro").count() == 1
    assert filters.location_any(df, "vi.", K.PLACE_KEYS).count() == 0
    assert filters.location_any(df, "vi.", K.PLACE_KEYS, regex=True).count() == 1
    bare = df.select(F.lit(1).alias("n"))
    assert filters.location_any(bare, "x", K.PLACE_KEYS).count() == 0
    assert filters.location_any(bare, "x", K.PLACE_KEYS, on_missing="all").count() == 2


def test_union_of_drifting_tables_keeps_every_row(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2.0)], "k string, b double")
    out = reshape.union_drifting([a, b])
    assert dict(out.dtypes) == {"k": "string", "a": "string", "b": "double"}
    assert out.count() == 2


def test_fill_sentinel(spark):
    df = spark.createDataFrame([(None, " \t", float("nan")), ("x", "y", 1.5)],
                               "a string, b string, c double")
    assert [tuple(r) for r in reshape.fill_sentinel(df).collect()] == [
        ("NA", "NA", "NA"), ("x", "y", "1.5")]


def test_first_nonempty_and_only_if_empty(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 3), ("b", 3, 4)],
                               "page string, rank int, v int")
    assert {r.v for r in reshape.first_nonempty(df, "page", "rank").collect()} == {1, 3, 4}
    none = df.where("v > 9")
    assert reshape.only_if_empty(df, none).count() == 4
    assert reshape.only_if_empty(df, df).count() == 0


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_spread_join_equals_plain_join_with_a_hot_key(spark, how):
    big = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"))
    small = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = joins.spread_join(big, small, ["k"], how)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, big.join(small, "k", how).collect()))


def test_left_join_hot_right_equals_plain_left_join(spark):
    left = spark.range(20).select(F.col("id").alias("k"), (F.col("id") + 1).alias("a"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).alias("k"),
                                    F.lit(1).alias("b"))
    got = joins.left_join_hot_right(left, right.where("k % 4 <> 1 or k = 5"), ["k"])
    want = left.join(right.where("k % 4 <> 1 or k = 5"), "k", "left")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_best_link_breaks_ties_by_position(spark):
    rows = [("p", 5, 2, "c"), ("p", 5, 1, "b"), ("p", 9, 0, "a")]
    df = spark.createDataFrame(rows, "page string, score int, pos int, href string")
    assert ordering.best_link(df, "page", "score", "pos").first().href == "b"


def test_sort_spread_orders_and_keeps_columns(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "x string")
    out = ordering.sort_spread(df, F.col("x").asc_nulls_last())
    assert out.columns == ["x"] and [r.x for r in out.collect()] == ["a", "a", "b", None]


def test_service_day(spark):
    day = dt.date(2025, 1, 6)  # a Monday
    flags = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
    rows = [("on", 1, 0, 0, 0, 0, 0, 0, 20250101, 20250131), ("off", 0, 1, 1, 1, 1, 1, 1, 20250101, 20250131),
            ("gone", 1, 0, 0, 0, 0, 0, 0, 20250101, 20250131), ("old", 1, 0, 0, 0, 0, 0, 0, 20240101, 20240131),
            ("both", 1, 0, 0, 0, 0, 0, 0, 20250101, 20250131)]
    calendar = spark.createDataFrame(rows, f"service_id string, {flags}, start_date int, end_date int")
    changes = spark.createDataFrame(
        [("gone", 20250106, 2), ("extra", 20250106, 1), ("both", 20250106, 1), ("both", 20250106, 2),
         ("on", 20250107, 2)], "service_id string, date int, exception_type int")
    got = {r.service_id for r in transit.active_services(calendar, changes, day).collect()}
    assert got == {"on", "extra", "both"}
    assert transit.active_services(calendar.where("false"), changes, day).count() == 0


def test_radius_box_never_cuts_the_circle(spark):
    points = spark.range(4000).select(
        (40.4168 + (F.rand(1) - 0.5) * 0.06).alias("latitud"),
        (-3.7038 + (F.rand(2) - 0.5) * 0.06).alias("longitud"))
    boxed = filters.within_radius(points).count()
    assert boxed == filters.with_distance(points).where("distancia_centro_km <= 1.5").count() > 0


def test_parking_falls_back_to_everything(spark):
    df = spark.createDataFrame([("p", "40.42", "-3.70"), ("q", "0", "-3.70"), ("r", "x", "1")],
                               "`Nombre` string, `Coordenada-Y` string, `Coordenada-X` string")
    near = parking.parking_or_all(df).collect()
    far = parking.parking_or_all(df, centre=(10.0, 10.0)).collect()
    assert [(r.nombre, r.scope) for r in near] == [("p", "radius")]
    assert [(r.nombre, r.scope) for r in far] == [("p", "all")]


def test_air_comparison_golden_rows(spark):
    """One page reading and no measurement: six rows, only CO measured."""
    page = spark.createDataFrame([("u", "2025-10-24", "18:55", "28 AQI CO 99 µg/m³")],
                                 "src string, fecha string, hora string, t string")
    snapshot = air.parse_snapshots(page, "t", "fecha", "hora", "src", "Panel")
    assert len(snapshot.columns) == 24
    empty = spark.createDataFrame([], "fecha string, magnitud string, valor string")
    out = air.air_comparison({"x.csv": empty}, snapshot)
    assert out.columns == K.COMPARISON_COLUMNS
    rows = {r.pollutant: tuple(r) for r in out.collect()}
    assert len(rows) == 6
    assert rows["co"] == ("2025-10-24", "co", "NA", "NA", "99.0", "99", "µg/m³", "28", "Buena", "NA")
    assert rows["o3"] == ("2025-10-24", "o3", "NA", "NA", "NA", "NA", "NA", "28", "Buena", "NA")


def test_air_delta_only_for_micrograms(spark):
    page = spark.createDataFrame([("u", "2025-10-24", "18:55", "28 AQI O3 50 ug/m3 CO 3 ug/m3")],
                                 "src string, fecha string, hora string, t string")
    snapshot = air.parse_snapshots(page, "t", "fecha", "hora", "src", "Panel")
    table = spark.createDataFrame([("24/10/2025", "9", "40,5"), ("24/10/2025", "6", "1")],
                                  "fecha string, magnitud string, valor string")
    rows = {r.pollutant: r for r in air.air_comparison({"x.csv": table}, snapshot).collect()}
    assert rows["o3"].delta_ugm3_acc_minus_open == "9.5"
    assert rows["co"].delta_ugm3_acc_minus_open == "NA"


def test_emergencies_sample(spark):
    df = spark.createDataFrame([("24/10/2025", "CENTRO"), ("01/01/2020", "CENTRO"), ("x", "SOL")],
                               "`Fecha Cita` string, Distrito string")
    out = incidents.emergencies([incidents.Source(df, "u")], day="2025-10-30", place="centro")
    assert [tuple(r) for r in out.collect()] == [("24/10/2025", "CENTRO", "u")]


def test_traffic_sorts_by_time_with_undated_last(spark):
    df = spark.createDataFrame([("x", "9"), ("02/01/2024", "8"), ("2024-01-01", "7")],
                               "fecha string, hora string")
    out = incidents.traffic([incidents.Source(df, "u"), incidents.Source(df, "v", enabled=False)])
    assert [r.fecha for r in out.collect()] == ["2024-01-01", "02/01/2024", "x"]


def test_overrides_and_disabled_pages(spark):
    pages = spark.createDataFrame([("http://a/id1", True), ("http://a/id2", None), ("z", False)],
                                  "page string, enabled boolean")
    out = links.override_links(links.enabled_pages(pages), {"id1": "f1", "id": "f2"})
    assert [r.forced for r in out.collect()] == ["f1", "f2"]


def test_first_source_is_filtered_once_and_the_rest_not_read(spark, tmp_path):
    from callejero.plans import incidents as jobs

    rows = [("2024-01-20", "Calle Mayor"), ("2024-01-19", "Calle Sol")]
    for name in ("a", "b"):
        spark.createDataFrame(rows, "fecha string, calle string").write.parquet(str(tmp_path / name))

    def source(name, page, street=True):
        read = spark.sparkContext.accumulator(0)

        @F.udf("string")
        def seen(text):
            read.add(1)
            return text

        df = spark.read.parquet(str(tmp_path / name)).withColumn("fecha", seen("fecha"))
        return jobs.Source(df if street else df.drop("calle"), name, page), read

    (first, _), (second, read_second), (third, read_third) = source("a", "p", street=False), source("b", "p"), source("a", "p")
    out = jobs.accidents([first, second, third], street="mayor")
    assert [(r.calle, r["__descarga__"]) for r in out.collect()] == [("Calle Mayor", "b")]
    out.collect()
    assert read_second.value <= 2 and read_third.value == 0
    assert jobs.accidents([first], street="mayor").collect() == []


def test_traffic_window_reaches_the_scan(spark, tmp_path):
    from callejero.plans import incidents as jobs

    path = str(tmp_path / "t")
    spark.range(400).select(
        F.col("id"), F.when(F.col("id") % 9 > 0, F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id as int))")).alias("fecha_hora"),
        F.lit("M-30").alias("tramo")).write.parquet(path)
    df = spark.read.parquet(path)
    kept = jobs.filter_traffic(df, day="2024-06-30", months=1)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert any("fecha_hora" in line and "GreaterThanOrEqual" in line for line in plan.splitlines() if "PushedFilters" in line)
    inside = "fecha_hora IS NULL OR cast(fecha_hora as date) BETWEEN date'2024-05-30' AND date'2024-06-30'"
    assert {r.id for r in kept.collect()} == {r.id for r in df.where(inside).collect()}


def test_funnel_counts_while_the_job_runs(spark):
    from pyspark.sql import Observation

    from callejero.operators import filters

    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("x"))
    seen = Observation("funnel")
    kept = filters.keep(df, filters.Test(F.col("x") > 20), filters.Test(F.col("y") % 2 == 0, {"y": F.col("x") + 1}), funnel=seen)
    assert kept.columns == ["id", "x"] and kept.count() == 40
    assert seen.get == {"n_rows": 100, "n_1": 72, "n_2": 40}


def test_sorts_of_cheap_inputs_have_one_exchange(spark, tmp_path):
    from callejero.operators.ordering import sort_spread

    path = str(tmp_path / "s")
    spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k")).write.parquet(path)
    out = sort_spread(spark.read.parquet(path).where("id < 900"), F.col("k").asc(), cheap=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    assert [r.k for r in out.collect()] == sorted(i % 3 for i in range(900))
    staged = sort_spread(spark.read.parquet(path), F.col("k").asc())
    assert [r.k for r in staged.collect()] == sorted(i % 3 for i in range(1000))
