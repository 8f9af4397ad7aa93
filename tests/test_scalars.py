import datetime as dt

import pytest
from pyspark.sql import functions as F

from callejero.functions import air, clock, dates, geo, labels, links, numbers, text


def test_parse_hour_input(values):
    cases = {
        "08": 800, "8:30": 830, "8h30": 830, "8h": 800, "8.5": 830, "8,25": 815, "8.999": 900,
        "23.999": None, "": None, "mañana": None, " 9 : 05 ": 905, "8:75": None, "24": None,
        "8:59.6": 900, "0": 0, "23:59": 2359,
    }
    assert values(clock.parse_hour_input, list(cases)) == list(cases.values())


def test_hour_argument_agrees_with_the_column_form(values):
    texts = ["08", "8:30", "8h30", "8h", "8.5", "8,25", "8.999", "7.75", "0", "23:59"]
    codes = [h * 100 + m for h, m in map(clock.hour_argument, texts)]
    assert values(clock.parse_hour_input, texts) == codes
    assert clock.hour_argument("") is None
    for bad in ("x", "24", "8:75", "23.999"):
        with pytest.raises(ValueError):
            clock.hour_argument(bad)


def test_to_hour_minute(values):
    cases = {
        "8.5": 830, "8.30": 818, "0830": 830, "830": 8300, "8.999": 860, "8 H 05": 805, "8": 800,
        "00008": 800, "2024-01-20 08:30": 830, "20/01/2024": 0, "20/01/2024 21:05:09": 2105,
        "a las 08:30 horas": 830, "1:15 pm": 1315, "12:10 a.m.": 10, "noche": None, None: None,
        "": None, "24.5": 2405, "08:00-09:00": 800,
    }
    assert values(clock.to_hour_minute, list(cases)) == list(cases.values())


def test_time_midpoint(values):
    cases = {
        "08:00-09:00": 510, "08:00-08:15": 487, "23:00-01:00": 720, "8h30": 510, "24": None,
        "x": None, None: None, "8,5": 510, "23.999": None, "8:75": None, "24:10": None, "7": 420,
        " 10:00 - 11:00 ": 630,
    }
    assert values(clock.time_midpoint, list(cases)) == list(cases.values())


def test_dates(values):
    stamp = dt.datetime
    cases = {
        "2024-01-20": stamp(2024, 1, 20), "20/01/2024": stamp(2024, 1, 20),
        "20-1-2024": stamp(2024, 1, 20), "1/2/2024 8:05": stamp(2024, 2, 1, 8, 5),
        "2024-01-20T08:30:15.5": stamp(2024, 1, 20, 8, 30, 15, 500000),
        "31/02/2024": None, "08:30": None, "2024": None, "ayer": None, None: None,
    }
    assert values(dates.parse_timestamp, list(cases)) == list(cases.values())
    assert values(dates.parse_date_strict_dayfirst, ["20/01/2024", "2024-01-20"]) == [
        dt.date(2024, 1, 20), None]
    assert values(dates.parse_date_input, ["2024-01-20", "20/01/2024"]) == [
        dt.date(2024, 1, 20), None]


def test_months_back_clamps_and_window_is_inclusive(spark):
    day = dt.date(2025, 5, 31)
    rows = spark.sql("select explode(sequence(date'2025-02-25', date'2025-06-02')) d")
    kept = [r.d for r in rows.where(dates.within_months(F.col("d"), day, 3)).collect()]
    assert min(kept) == dt.date(2025, 2, 28) and max(kept) == day


def test_date_arguments():
    assert dates.date_argument("2024-01-05") == dt.date(2024, 1, 5)
    assert dates.date_argument("") is None
    with pytest.raises(ValueError):
        dates.date_argument("05/01/2024")


def test_date_from_parts(spark):
    rows = [("2024", "2", "29"), ("2023", "2", "29"), ("2024", "13", "1"), ("2024", "enero", "1"),
            ("2024.0", "1", "7")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    made = df.select(dates.date_from_parts(F.col("y"), F.col("m"), F.col("d")).alias("x")).collect()
    assert [r.x for r in made] == [dt.date(2024, 2, 29), None, None, None, dt.date(2024, 1, 7)]


def test_fold_text(values):
    cases = {" GRAN VÍA ": "gran via", "Ñuñez": "nunez", None: "", "\tCalle ": "calle",
             "İstanbul": "istanbul", "plain": "plain"}
    assert values(text.fold_text, list(cases)) == list(cases.values())
    folded = values(text.fold_text, ["Méndez Álvaro"])
    assert values(text.fold_text, folded) == folded == [text.fold_literal("Méndez Álvaro")]


def test_slug(values):
    assert values(text.slug, ["Gran Vía, 12", "--"]) == ["gran_via_12", ""]
    assert values(lambda c: text.slug(c, "ubicacion"), ["--"]) == ["ubicacion"]


def test_numbers(values):
    assert values(numbers.decimal_comma, ["8,5", "-1.25", "1,5e1", "5f", "", "1.234,5", None]) == [
        8.5, -1.25, 15.0, None, None, None, None]
    assert values(numbers.coerce_int, ["8", " 8 ", "8.0", "x"]) == [8, 8, None, None]


def test_air_codes(values):
    assert values(air.aqi_category, ["50", "51", "300", "301", "501", "x"]) == [
        "Buena", "Moderada", "Muy mala", "Peligrosa", None, None]
    assert values(air.pollutant_from_code, ["8", "10", "99"]) == ["no2", "pm10", None]
    assert values(air.unit_for, ["co", "o3", "x"]) == ["mg/m³", "µg/m³", "NA"]


def test_pollutant_text_is_not_tried_when_the_code_parses(spark):
    df = spark.createDataFrame([("99", "ozono"), ("n/d", "ozono"), (None, "PM 2,5")],
                               "magnitud string, nota string")
    got = df.select(air.pollutant_of(df.columns).alias("p")).collect()
    assert [r.p for r in got] == [None, "o3", "pm25"]


def test_hour_columns_of_a_monthly_table_are_days():
    days = [f"V{i:02d}" for i in range(1, 32)]
    assert air.hourly_columns(["ANO", "MES", *days]) == []
    assert air.hourly_columns(["ANO", "MES", "DIA", "H01", "V01", "hora_02"]) == ["H01", "hora_02"]


def test_row_value_marks_missing_and_absent(spark):
    df = spark.createDataFrame([("1,5", "9"), ("", "9"), ("x", "9"), ("x", "y")],
                               "valor string, h01 string")
    got = [r.v for r in df.select(air.row_value(df.columns).alias("v")).collect()]
    assert got[0] == 1.5 and got[1] != got[1] and got[2] == 9.0 and got[3] is None


def test_haversine(spark):
    point = F.lit(40.418722788943874), F.lit(-3.7030734062842345)
    centre = F.lit(40.4168), F.lit(-3.7038)
    d, back, zero = spark.range(1).select(
        geo.haversine_km(*centre, *point), geo.haversine_km(*point, *centre),
        geo.haversine_km(*point, *point)).first()
    assert d == pytest.approx(0.2224768098158315, abs=1e-9) and d == pytest.approx(back)
    assert zero == 0.0


def test_links(values, spark):
    rows = [("x.csv", "Descarga"), ("x.json", ""), ("/download", "")]
    df = spark.createDataFrame(rows, "h string, l string")
    scores = df.select(links.link_score(F.col("h"), F.col("l")).alias("s")).collect()
    assert [r.s for r in scores] == [500, 750, 900]
    base = F.lit("https://a.example/b/c?d=1")
    assert values(lambda c: links.absolutize(base, c), ["/x.csv", "//h/y", "http://z", "rel"]) == [
        "https://a.example/x.csv", "https://h/y", "http://z", "rel"]


def test_labels(values):
    assert values(labels.month_name, ["1", "13", "14", None]) == [
        "Enero", "Promedio Anual", "Mes 14", "Mes N/D"]
    assert values(labels.dataset_label, ["/p/Trafico/Resultados/a.csv", "/p/otros/Casa/x.csv",
                                         "solo.csv"]) == ["trafico_historico", "casa", "solo"]
    assert values(labels.extract_csv_paths, ['ok "/a/b.csv" y /a/b.csv). luego c.CSV']) == [
        ["/a/b.csv", "c.CSV"]]
