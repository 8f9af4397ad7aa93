"""Rules of filters, unions and jobs that tables of one kind do not show."""

import datetime as dt

from pyspark.sql import functions as F

from callejero.functions.dates import parse_timestamp
from callejero.functions.labels import dataset_label
from callejero.operators import filters, ordering, reshape
from callejero.plans.incidents import Source, accidents, emergencies, traffic
from callejero.plans.parking import parking_or_all


def test_labels_are_not_cut(spark):
    folder = "carpeta_con_un_nombre_muy_largo_de_verdad"
    df = spark.createDataFrame([(f"/{folder}_1/a.csv",), (f"/{folder}_2/a.csv",)], "p string")
    assert sorted(r.l for r in df.select(dataset_label(F.col("p")).alias("l")).collect()) == [f"{folder}_1", f"{folder}_2"]


def test_any_number_of_days(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2022-01-01",)], "fecha string")
    assert filters.last_n_days(df, "2024-01-20", 400).count() == 1


def test_a_long_fraction_is_cut(spark):
    df = spark.createDataFrame([("2024-01-20 10:11:12.123456789",), ("2024-01-20 10:11:12.5",)], "x string")
    got = [r.t for r in df.select(parse_timestamp(F.col("x")).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 20, 10, 11, 12, 123456), dt.datetime(2024, 1, 20, 10, 11, 12, 500000)]


def test_names_that_differ_in_case_are_one_column(spark):
    a = spark.createDataFrame([("2024-01-20", 1)], "Fecha string, n int")
    b = spark.createDataFrame([(dt.date(2024, 1, 21), 2)], "fecha date, n int")
    out = reshape.union_drifting([a, b])
    assert out.columns == ["Fecha", "n"] and sorted(r.Fecha for r in out.collect()) == ["2024-01-20", "2024-01-21"]
    tagged = reshape.tag_source(spark.createDataFrame([("x",)], "Dataset string"), dataset="y")
    assert tagged.columns == ["dataset_src", "dataset"]


def test_jobs_without_sources(spark):
    off = Source(spark.createDataFrame([("2024-01-20",)], "fecha string"), "l", enabled=False)
    assert traffic([]).columns == traffic([off]).columns == emergencies([off]).columns == ["__fuente"]
    assert accidents([]).columns == ["__origen__", "__descarga__"] and accidents([]).count() == 0


def _pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PushedFilters" in line]


def test_typed_dates_are_pruned_in_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        "o_orderkey", F.col("o_orderdate").alias("fecha"))
    stamp = F.col("fecha").cast("timestamp_ntz")
    for kept in (filters.date_window(orders, "1998-05-31", 2), filters.last_n_days(orders, "1998-05-31", 30),
                 filters.date_window_keep_null(orders, "fecha", "1998-05-31", 2),
                 filters.keep(orders, filters.row_time_test(orders, dt.date(1998, 5, 31), 2, None))):
        assert any("GreaterThanOrEqual(o_orderdate" in line and "LessThan(o_orderdate" in line for line in _pushed(kept))
    want = orders.where(stamp.cast("date").between("1998-05-01", "1998-05-31")).count()
    assert filters.last_n_days(orders, "1998-05-31", 30).count() == want


def _records_read(spark, df):
    """Rows that scans of the run plan gave."""
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name.startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_parking_is_scanned_once(spark, tmp_path):
    spark.range(2000).select("id", (F.col("id") % 7 + 40).cast("double").alias("latitud"), F.lit(-3.7).alias("longitud")).write.parquet(str(tmp_path / "p"))
    out = parking_or_all(spark.read.parquet(str(tmp_path / "p")), extracted=F.lit("2024-01-20"))
    assert _records_read(spark, out) == 2000


def test_sorts_order_the_whole_table(spark):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(["2024-01-03", None, "2024-01-01", "2024-01-02"] * 50)], "fecha string, i int")
    dates = [r.fecha for r in ordering.sort_by_first_date_column(df.repartition(4)).collect()]
    assert dates == sorted(d for d in dates if d) + [None] * 50
    stamps = [r.fecha for r in ordering.sort_by_timestamp(df.repartition(4), F.col("fecha").try_cast("timestamp_ntz")).collect()]
    assert stamps == dates


def test_first_source_of_a_page_that_has_rows_wins(spark):
    def table(day, n):
        return spark.createDataFrame([(day, "Gran Vía")] * n, "fecha string, calle string")

    sources = [Source(table("1999-01-01", 3), "a", "p"), Source(table("2024-01-20", 2), "b", "p"),
               Source(table("2024-01-20", 5), "c", "p"), Source(table("2024-01-19", 1), "d", "q")]
    got = accidents(sources, day="2024-01-20").groupBy("__descarga__").count().collect()
    assert {(r[0], r[1]) for r in got} == {("b", 2), ("d", 1)}
