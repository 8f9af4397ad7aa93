import datetime as dt
import io
import json
import zipfile

from pyspark.sql import functions as F

from callejero import constants as K
from callejero import sinks
from callejero.plans import climate, datasheet, transit
from callejero.sources import archives, delimited, documents, files, lazy, readers


def test_separator_sniffing(spark):
    cases = [
        (["a;b;c", "1,5;2,5;3", "4;5,1;6"], ";"),
        (["a,b", '"x;y",2', "3,4"], ","),
        (["a\tb", "1\t2"], "\t"),
        (["a|b|c", "1|2|3"], "|"),
        (["solo", "1"], ";"),
    ]
    df = spark.createDataFrame([(lines,) for lines, _ in cases], "lines array<string>")
    got = df.select(files.sniff_separator(F.col("lines")).alias("s")).collect()
    assert [r.s for r in got] == [s for _, s in cases]


def test_auto_reader_mixes_shapes_bom_and_latin1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufefffecha;calle\n2024-01-01;Alcalá\n".encode())
    (tmp_path / "b.csv").write_text("calle,valor\n\"Gran Vía, 1\",3\n", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c d.csv").write_text("fecha;calle\n2024-01-02;Sol\n")
    (tmp_path / "empty.csv").write_text("")
    df = readers.read_delimited_auto(spark, str(tmp_path))
    rows = {(r.fecha, r.calle, r.valor) for r in df.collect()}
    assert rows == {("2024-01-01", "Alcalá", None), (None, "Gran Vía, 1", "3"),
                    ("2024-01-02", "Sol", None)}


def test_header_names_are_unique():
    assert delimited.header_names('"a";b;a;', ";") == ["a", "b", "a.2", "_c3"]
    assert delimited.header_names("Nombre;nombre", ";") == ["Nombre", "nombre.1"]


def test_auto_reader_on_awkward_files(spark, tmp_path):
    (tmp_path / "a[1].csv").write_bytes("Nombre;nombre\nAlcalá;\"uno\ndos\"\n".encode("latin-1"))
    (tmp_path / "{b}*.csv").write_text("Nombre;nombre\nSol;tres\n")
    rows = {(r[0], r[1]) for r in readers.read_delimited_auto(spark, str(tmp_path)).collect()}
    assert rows == {("Alcalá", "uno\ndos"), ("Sol", "tres")}
    late = tmp_path / "late"
    late.mkdir()
    (late / "x.csv").write_bytes(b"calle\n" + b"plain text of a line\n" * 5000 + "Alcalá\n".encode("latin-1"))
    got = readers.read_delimited_auto(spark, str(late), encoding="ISO-8859-1")
    assert got.where("calle = 'Alcalá'").count() == 1 and got.count() == 5001
    assert readers.read_delimited(spark, str(late / "x.csv"), encoding="ISO-8859-1").where("calle = 'Alcalá'").count() == 1


def test_a_header_of_any_length_is_read_whole(spark, tmp_path):
    names = [f"column_number_{i}" for i in range(8000)]
    (tmp_path / "wide.csv").write_text(";".join(names) + "\n" + ";".join("1" * 8000) + "\n")
    heads = files.file_heads(files.list_files(spark, str(tmp_path), "*.csv")).collect()
    assert heads[0].lines[0] == ";".join(names) and heads[0].has_rows
    found = readers.file_shapes(files.list_files(spark, str(tmp_path), "*.csv"), str(tmp_path / "heads"))
    (row,) = readers.folder_shapes(found).collect()
    assert (row["shape"].separator, len(delimited.header_names(row["shape"].header, ";"))) == (";", 8000)


def test_shapes_know_which_folders_are_mixed(spark, tmp_path):
    for folder, texts in (("same", ["a;b\n1;2\n"] * 3), ("mixed", ["a;b\n1;2\n", "a,b\n1,2\n"])):
        (tmp_path / folder).mkdir()
        for i, text in enumerate(texts):
            (tmp_path / folder / f"{i}.csv").write_text(text)
    found = readers.file_shapes(files.list_files(spark, str(tmp_path), "*.csv"), str(tmp_path / "heads"))
    shapes = {r.folder.rsplit("/", 1)[1]: r["shape"] for r in readers.folder_shapes(found).collect()}
    assert shapes["mixed"] is None and tuple(shapes["same"]) == ("a;b", ";", "UTF-8")
    assert readers.read_delimited_auto(spark, str(tmp_path)).where("a = 1 and b = 2").count() == 5


def test_decoding_loses_nothing():
    assert delimited.decode(b"Alcal\xe1", whole=True) == ("Alcal\xe1", "ISO-8859-1")
    assert delimited.decode("Alcalá".encode()[:-1], whole=False) == ("Alcal", "UTF-8")
    assert delimited.decode(b"\xe1bc", whole=False) == ("\xe1bc", "ISO-8859-1")
    assert delimited.encoding_of(io.BytesIO("ñ".encode() * 700_000)) == "UTF-8"
    assert delimited.encoding_of(io.BytesIO(b"a" * 3_000_000 + b"\xe1")) == "ISO-8859-1"


def test_records_and_stray_quotes():
    def found(text, separators=";"):
        return list(delimited.records(delimited.lines_of(io.BytesIO(text.encode()), "utf-8"), separators))

    assert found('\ufeffa;b\r\n1;"x\r\ny"\n\n  \n2;"q""r"\n3;z') == ["a;b", '1;"x\r\ny"', '2;"q""r"', "3;z"]
    assert found('tubo;5" acero\n1;2\n') == ['tubo;5" acero', "1;2"]
    # a quote that never closes takes its own line only
    assert found('a;b\n"1;2\n3;4\n5;6') == ["a;b", '"1;2', "3;4", "5;6"]
    assert delimited.cells('"1;2', ";") == ['"1', "2"]
    assert delimited.cells('1;"x;\ny";"q""r"', ";") == ["1", "x;\ny", 'q"r']
    assert delimited.cells('"x" y";;"";', ";") == ['x" y', "", "", ""]
    assert delimited.cells('"a"b;c', ";") == ['"a"b', "c"]
    assert delimited.cells('tubo;5" acero', ";") == ["tubo", '5" acero']
    assert delimited.header_names('"a;b', ";") == ['"a', "b"]
    assert delimited.head_records("a;b\n1;2\n3", False, 9) == ["a;b", "1;2"]
    assert delimited.head_records("a;b\n1;2\n3", True, 9) == ["a;b", "1;2", "3"]


def test_many_stray_quotes_are_read_in_linear_time():
    import time

    line = "123;calle 5\" tubo;x\n"
    text = "n;via;z\n\"abierta;1;2\n" + line * 500_000
    started = time.perf_counter()
    rows = sum(1 for _ in delimited.records(iter(text.splitlines(True)), ";"))
    assert rows == 500_002 and time.perf_counter() - started < 10


def test_members_with_stray_quotes_and_latin1(spark, tmp_path):
    big = 'id;via\n' + '1;"abierta\n' + '2;tubo de 5" largo\n' * 200_000
    _zip(tmp_path / "a.zip", [("big.csv", big), ("latin.csv", b"id;via\n7;x\n8;Alcal\xe1"),
                              ("roto.csv", '"id;via\n9;y\n'), ("late.csv", "id;via\n" + "4;plain\n" * 200_000 + "5;é"),
                              ("late2.csv", b"id;via\n" + b"4;plain\n" * 200_000 + b"6;\xe9")])
    df = archives.read_csv_archives(spark, str(tmp_path))
    got = {r.member: r.n for r in df.groupBy("member").agg(F.count("*").alias("n")).collect()}
    assert got == {"big.csv": 200_001, "latin.csv": 2, "roto.csv": 1, "late.csv": 200_001, "late2.csv": 200_001}
    assert {r.via for r in df.where("id in (1, 5, 6, 8)").collect()} == {'"abierta', "é", "Alcal\xe1"}
    assert df.where("member = 'big.csv' and id = 2").select("via").distinct().collect()[0].via == 'tubo de 5" largo'
    assert df.where("member = 'roto.csv'").select('`"id`', "via").first()[:] == ("9", "y")


def test_five_hundred_shapes_are_one_scan(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(500):
        (folder / f"f{i:03d}.csv").write_text(f"id;propia_{i % 50};Comun\n{i};x{i};c\n" if i % 2 else f"comun,id\nc,{i}\n" + f"d,{i}\n" * (i % 3))
    df = readers.read_delimited_auto(spark, str(folder), with_path=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") + plan.count("Scan csv") == 1 and "Union" not in plan
    rows = df.collect()
    assert len(rows) == 250 + sum(1 + i % 3 for i in range(0, 500, 2))
    assert {r["propia_7"] for r in rows if r["propia_7"]} == {f"x{i}" for i in range(500) if i % 2 and i % 50 == 7}
    common = next(c for c in df.columns if c.lower() == "comun")
    assert {r[common] for r in rows} == {"c", "d"} and len([c for c in df.columns if c.lower() == "comun"]) == 1
    sheet = datasheet.datasheet(spark, str(folder))
    assert sheet.count() == len(rows) and sheet.where("source_file like 'f%.csv'").count() == len(rows)


def test_lazy_source_runs_nothing_before_an_action(spark, tmp_path):
    manifest = str(tmp_path / "manifest")
    (tmp_path / "x.csv").write_text("a;b\n1;\n\n;\"2\n3\"\n5\n6;7;8\n")
    spark.createDataFrame([(str(tmp_path / "x.csv"), None, ";", "a;b", "UTF-8"), (str(tmp_path / "gone.csv"), None, ";", "a;b", "UTF-8")],
                          "path string, member string, separator string, header string, encoding string").repartition(2).write.parquet(manifest)
    df = lazy.read_members(spark, manifest, ["a", "missing", "B"])   # the missing file is not looked at yet
    assert df.columns == ["a", "missing", "B"]
    (tmp_path / "gone.csv").write_text("a;b\n")
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("1", None, None), (None, None, "2\n3"), ("5", None, None), ("6", None, "7")], key=str)


def test_listing_is_unique_and_newest_first(spark, tmp_path):
    import os

    for i, name in enumerate(["x.csv", "y.csv", "z.txt"]):
        (tmp_path / name).write_text("a\n1\n")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    listing = readers.read_results(spark, [str(tmp_path), str(tmp_path)]).collect()
    assert [r.path.rsplit("/", 1)[1] for r in listing] == ["y.csv", "x.csv"]


def test_gtfs_folder_with_missing_files(spark, tmp_path):
    feed = tmp_path / "metro"
    feed.mkdir()
    (feed / "calendar.txt").write_bytes(
        b"\xef\xbb\xbfservice_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
        b"S,1,1,1,1,1,0,0,20250101,20251231\n")
    (feed / "trips.txt").write_text(
        "route_id,service_id,trip_id,trip_headsign,direction_id,extra\nR,S,T,Sol,0,x\n")
    loaded = transit.load_feed(spark, str(feed))
    assert loaded.calendar.first().service_id == "S"
    assert loaded.stops.count() == 0 and loaded.stops.columns == ["stop_id", "stop_name", "stop_lat", "stop_lon"]
    assert transit.day_schedule({"METRO": loaded}, dt.date(2025, 1, 6)).count() == 0
    (feed / "stop_times.txt").write_text(
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT,25:10:00,25:11:00,P,2\nT,25:00:00,25:01:00,Q,1\n")
    (feed / "stops.txt").write_text("stop_id,stop_name,stop_lat,stop_lon\nP,Sol,40.4,-3.7\nQ,Bad,x,-3.7\n")
    whole = transit.load_feed(spark, str(feed))
    rows = transit.day_schedule({"METRO": whole, "EMT": whole}, dt.date(2025, 1, 6)).collect()
    assert list(rows[0].asDict()) == K.TRANSIT_COLUMNS
    assert [(r.tipo_transporte, r.stop_id, r.arrival_time) for r in rows] == [
        ("EMT", "P", "25:10:00"), ("METRO", "Q", "25:00:00"), ("METRO", "P", "25:10:00")]
    assert transit.day_schedule({"METRO": whole}, dt.date(2025, 1, 5)).count() == 0  # a Sunday


def test_the_schedule_is_sorted_with_one_exchange_of_whole_rows(spark):
    """A second one in front of the sort wrote all columns of all rows once more, in no order."""
    day = dt.date(2025, 1, 6)
    feed = transit.Feed(
        trips=spark.createDataFrame([("r", "s", "t2", "h", 0), ("r", "s", "t1", "h", 1), ("r", "x", "t3", "h", 1)],
                                    "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int"),
        calendar=spark.createDataFrame([("s", 1, 20250101, 20251231)], "service_id string, monday int, start_date int, end_date int"),
        calendar_dates=spark.createDataFrame([], "service_id string, date int, exception_type int"),
        stop_times=spark.createDataFrame([(t, "10:00:00", "10:01:00", "p", n) for t in ("t1", "t2", "t3") for n in (2, 1)] + [("t1", "10:00:00", "10:01:00", "p", 1)],
                                         "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int"),
        stops=spark.createDataFrame([("p", "Sol", "40.4", "-3.7")], "stop_id string, stop_name string, stop_lat string, stop_lon string"))
    found = transit.day_schedule({"METRO": feed, "EMT": feed}, day)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    got = [(r.tipo_transporte, r.trip_id, r.stop_sequence) for r in found.collect()]
    assert got == [(m, t, n) for m in ("EMT", "METRO") for t, n in (("t1", 1), ("t1", 1), ("t1", 2), ("t2", 1), ("t2", 2))]



def _zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, raw in members:
            archive.writestr(name, raw)


def test_archives(spark, tmp_path):
    many = [(f"m{i:02d}.csv", f"id;dia\n{i};x\n") for i in range(10)]
    _zip(tmp_path / "trafico-09-2025.zip",
         [*many, ("2025_09_datos.csv", "id;dia\n99;septiembre\n"), ("leame.txt", "no")])
    _zip(tmp_path / "otro.zip", [("l.csv", "calle,id\nAlcalá,1\n".encode("latin-1")),
                                 ("vacio.csv", "")])
    df = archives.read_csv_archives(spark, str(tmp_path))
    rows = [r for r in df.collect() if r.archive.endswith("2025.zip")]
    assert {r.id for r in rows} == {"99", *map(str, range(10))}
    few = archives.read_csv_archives(spark, str(tmp_path), limit=8).collect()
    # the month's own member first, then seven more in stored order
    assert {r.id for r in few if r.archive.endswith("2025.zip")} == {"99", *map(str, range(7))}
    assert {r.calle for r in df.collect() if r.archive.endswith("otro.zip")} == {"Alcalá"}
    manifest = archives.archive_manifest(files.list_files(spark, str(tmp_path), "*.zip"))
    assert manifest.count() == 13
    small = archives.select_members(manifest, dt.date(2025, 9, 1), limit=1)
    assert {r.member for r in small.collect()} == {"2025_09_datos.csv", "l.csv"}
    assert archives.select_members(manifest, max_bytes=0).where("size > 0").count() == 0


def test_member_ranking_limits_before_the_shuffle(spark):
    manifest = spark.createDataFrame([("a", "m", 1, 1)], "archive string, member string, size long, pos long")
    plan = archives.select_members(manifest, limit=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_json_array_object_and_geojson(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1, "n": {"y": {"z": "v"}}}, {"x": 2}]))
    (tmp_path / "b.json").write_text(json.dumps({"x": 3}))
    rows = readers.read_json_records(spark, str(tmp_path / "*.json"))
    assert sorted(rows.columns) == ["n.y.z", "x"] and rows.count() == 3
    geo = tmp_path / "g.geojson"
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}},
        {"type": "Feature", "properties": {"a": 2}, "geometry": None}]}))
    got = readers.read_geojson_features(spark, str(geo))
    assert {"properties.a", "geometry.coordinates"} <= set(got.columns) and got.count() == 2


def test_monthly_climate_is_latin1_and_may_lack_months(spark, tmp_path):
    (tmp_path / "m.json").write_bytes(json.dumps([{"fecha": "2024-1", "tm_mes": "28.2", "hr": "año"}],
                                                 ensure_ascii=False).encode("latin-1"))
    row = climate.climate_monthly(readers.read_climate_json(spark, str(tmp_path), monthly=True), 2024).first()
    assert row["Año"] == 2024 and row["Nombre_Mes"] == "Mes N/D" and row["Humedad_Media_%"] == "año"
    assert row["Temp_Media_°C"] == "28.2" and row["Horas_Sol"] == "N/D"
    assert climate.climate_monthly(readers.read_climate_json(spark, str(tmp_path), monthly=True), 2023).count() == 0


def test_daily_climate_window_is_inclusive_and_newest_first(spark):
    days = spark.sql("select cast(d as string) fecha from (select explode(sequence(date'2024-10-01', date'2024-10-25')) d)")
    out = climate.climate_daily(days, "2024-10-20", 10).collect()
    assert len(out) == 11 and out[0].Fecha == "2024-10-20" and out[-1].Fecha == "2024-10-10"
    assert len(out[0]) == 16 and out[0].Estacion == "N/D"


def test_dcat(spark):
    head = ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
            'xmlns:dcat="http://www.w3.org/ns/dcat#" xmlns:dct="http://purl.org/dc/terms/">')
    dist = ('<dcat:Distribution><dct:title>{t}</dct:title>{m}'
            '<dcat:accessURL rdf:resource="{u}"/></dcat:Distribution>')
    json_dist = dist.format(t="j", m="", u="http://x/a.json")
    csv_dist = dist.format(t="c", m="<dcat:mediaType>text/CSV</dcat:mediaType>", u="http://x/b")
    nested = ("<dcat:Catalog><dcat:dataset><dcat:Dataset><dcat:distribution>" + csv_dist
              + "</dcat:distribution></dcat:Dataset></dcat:dataset></dcat:Catalog>")
    docs = spark.createDataFrame(
        [(1, head + json_dist + csv_dist + "</rdf:RDF>"), (2, head + nested + "</rdf:RDF>"),
         (3, "<roto"), (4, head + "</rdf:RDF>")], "d int, x string")
    got = [(r.doc, r.pos, r.title, r.href) for r in
           documents.extract_dcat_distributions(docs, "d", "x").orderBy("doc", "pos").collect()]
    assert got == [(1, 0, "c", "http://x/b"), (1, 1, "j", "http://x/a.json"), (2, 0, "c", "http://x/b")]
    deep = nested.replace("<dcat:dataset>", "<dcat:record>").replace("</dcat:dataset>", "</dcat:record>")
    other = csv_dist.replace("dcat:Distribution", "o:Distribution").replace(
        "<o:Distribution>", '<o:Distribution xmlns:o="http://other/">')
    docs = spark.createDataFrame([(1, head + deep + other + "</rdf:RDF>"), (2, None)], "d int, x string")
    assert [r.title for r in documents.extract_dcat_distributions(docs, "d", "x").collect()] == ["c"]


def test_anchors_and_data_attributes(spark):
    html = ("<!-- <a href='/no'>no</a> --><script>'<a href=\"/no\">x</a>'</script>"
            "<A class=x HREF='/a?b=1&amp;c=2'> Uno\n <b>dos</b>&nbsp;</A><a href=raw.csv>r</a><a name=z>n</a>"
            "<button data-href='/h' data-url=\"/u\">x</button>")
    pages = spark.createDataFrame([("https://h.example/p", html)], "url string, html string")
    got = [(r.pos, r.label, r.href) for r in documents.extract_anchors(pages).collect()]
    assert got == [(0, "Uno dos", "/a?b=1&c=2"), (1, "r", "raw.csv")]
    assert [r.href for r in documents.extract_data_attributes(pages).collect()] == ["/u"]
    html = """<a title="a > b" data-x='href=/no' href=/d.csv>N&oacute;mina &#233;</a><i title="data-url=no" data-href="/h?a&amp;b">"""
    pages = spark.createDataFrame([("https://h.example/p", html), ("x", None)], "url string, html string")
    assert [(r.label, r.href) for r in documents.extract_anchors(pages).collect()] == [("Nómina é", "/d.csv")]
    assert [r.href for r in documents.extract_data_attributes(pages).collect()] == ["/h?a&b"]


def test_sinks_and_datasheet(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([(1, " con; \"comillas\" ")], "dataset int, nota string")
    sinks.write_csv(df.coalesce(1), f"{root}/trafico/Resultados")
    sinks.write_header_only(spark, f"{root}/vacio/Resultados", ["__fuente"])
    sheet = datasheet.datasheet(spark, root)
    assert sheet.columns[:2] == ["dataset", "source_file"]
    row = sheet.first()
    assert (row.dataset, row.dataset_src, row.nota) == ("trafico_historico", "1", ' con; "comillas" ')
    assert row.source_file.startswith("trafico/Resultados/part-")
    empties = {r.dataset for r in datasheet.empty_inputs(spark, root).collect()}
    assert "resultados" in empties and "trafico_historico" not in empties
