"""Duplicates and nulls, times, places, nearest neighbours and incident probability, against plain Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from callejero.bindings import risk as risk_queries
from callejero.operators import profile, timechecks
from callejero.operators.neighbours import DIGITS, knn
from callejero.operators.regions import locate, outside_declared
from callejero.plans import risk

SF = "/root/testdata/sf0.01"


# -- nearest neighbours ----------------------------------------------------------

def distance(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    half = math.radians(b[1]) - math.radians(a[1])
    arc = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(half / 2) ** 2
    return round(6371 * 2 * math.atan2(math.sqrt(arc), math.sqrt(max(1 - arc, 0))), DIGITS)


def nearest(queries, points, k, apart):
    out = set()
    for q, lat, lon in queries:
        if lat is None or lon is None:
            continue
        ranked = sorted((distance((lat, lon), (a, b)), i) for i, a, b in points if a is not None and b is not None and not (apart and i == q))
        out |= {(q, i, r, d) for r, (d, i) in enumerate(ranked[:k], 1)}
    return out


def city(seed, count):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        kind = draw.random()
        if kind < 0.35:    # a third at one crossing, to the last digit
            rows.append((i, 40.4168, -3.7038))
        elif kind < 0.6:   # a dense street
            rows.append((i, 40.42 + draw.random() * 1e-4, -3.70 + draw.random() * 1e-4))
        elif kind < 0.9:
            rows.append((i, 40.3 + draw.random() * 0.3, -3.9 + draw.random() * 0.4))
        else:              # far out: the poles, the antimeridian, the other side
            rows.append((i, draw.choice([89.99, -89.99, 0.0, -40.4, 40.4]), draw.choice([179.999, -179.999, 180.0, 0.0, 176.3])))
    return rows + [(count, None, 1.0), (count + 1, 2.0, None)]


@pytest.mark.parametrize("seed, k, apart", [(1, 1, False), (2, 3, True), (3, 7, True)])
def test_knn_equals_all_pairs(spark, seed, k, apart):
    rows = city(seed, 240)
    df = spark.createDataFrame(rows, "id long, lat double, lon double").repartition(3)
    got = {(r["query"], r.neighbour, r["rank"], r.distance_km) for r in knn(df, df, k, "id", "lat", "lon", apart).collect()}
    want = nearest(rows, rows, k, apart)
    assert {g[:3] for g in got} == {w[:3] for w in want}
    assert sum(g[3] for g in got) == pytest.approx(sum(w[3] for w in want), abs=1e-6)


def test_knn_of_fewer_points_than_asked(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, -80.0, 170.0)], "id long, lat double, lon double")
    queries = spark.createDataFrame([(7, 40.0, -3.0), (1, 0.0, 0.0)], "id long, lat double, lon double")
    got = {(r["query"], r.neighbour, r["rank"]) for r in knn(queries, points, 5, "id", "lat", "lon").collect()}
    assert got == {(7, 1, 1), (7, 2, 2), (1, 1, 1), (1, 2, 2)}
    assert {(r["query"], r.neighbour) for r in knn(queries, points, 5, "id", "lat", "lon", apart=True).collect()} == {(7, 1), (7, 2), (1, 2)}
    assert knn(queries, points.filter("false"), 2, "id", "lat", "lon").count() == 0


def test_knn_meets_no_far_pairs(spark):
    """Candidates stay in proportion to the points, though one place holds a third of them."""
    df = spark.createDataFrame(city(5, 900), "id long, lat double, lon double")
    plan = knn(df, df, 3, "id", "lat", "lon")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# -- places ------------------------------------------------------------------------

SQUARE = [[0.0, 0.0], [0.04, 0.0], [0.04, 0.04], [0.0, 0.04], [0.0, 0.0]]
HOLE = [[0.01, 0.01], [0.03, 0.01], [0.03, 0.03], [0.01, 0.03]]   # not closed
STAR = [[0.1 + 0.02 * (2 if i % 2 else 1) * math.cos(i * math.pi / 5), 0.02 * (2 if i % 2 else 1) * math.sin(i * math.pi / 5)] for i in range(10)]


def inside(rings, x, y):
    """Even-odd rule by ray casting; the edges belong to the inside."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (cross > 0 if y2 > y1 else cross < 0):
                odd = not odd
    return odd


def shapes(spark):
    rows = [("a", [SQUARE, HOLE]), ("b", [STAR]), ("b", [[[0.3, 0.3], [0.31, 0.3], [0.3, 0.31]]]), ("c", []), ("d", [[[0.02, 0.02]]])]
    return rows, spark.createDataFrame(rows, "id string, rings array<array<array<double>>>")


def probes():
    draw = random.Random(3)
    near = [(0.0, 0.0), (0.04, 0.02), (0.01, 0.02), (0.02, 0.02), (0.03, 0.03), (0.02, 0.04), (0.305, 0.305), (0.0400001, 0.02), (0.3, 0.3)]
    near += [tuple(p) for p in STAR] + [(draw.uniform(-0.01, 0.16), draw.uniform(-0.05, 0.06)) for _ in range(600)]
    return [(i, y, x) for i, (x, y) in enumerate(near)] + [(9000, None, 0.0), (9001, 0.02, None)]


def test_points_in_polygons(spark):
    rows, polygons = shapes(spark)
    points = spark.createDataFrame(probes(), "pk long, lat double, lon double").repartition(3)
    got = {(r.pk, r.id) for r in locate(points, polygons, "lat", "lon", "id", "rings").collect()}
    want = {(i, k) for i, y, x in probes() if x is not None and y is not None for k, rings in rows if inside(rings, x, y)}
    assert got == want
    assert {(0, "a"), (2, "a"), (4, "a")} <= got and (3, "a") not in got   # corner, edge of the hole, its corner; in the hole


def test_points_outside_what_they_declare(spark):
    rows, polygons = shapes(spark)
    declared = [(i, y, x, "abcx"[i % 4] if i % 9 else None) for i, y, x in probes()]
    points = spark.createDataFrame(declared, "pk long, lat double, lon double, id string")
    # the same file twice: repeated rows are judged each
    twice = points.unionAll(points)
    got = sorted(r.pk for r in outside_declared(twice, polygons, "lat", "lon", "id", "id", "rings").collect())
    want = sorted(2 * [i for i, y, x, d in declared if None not in (x, y) and d in ("a", "b", "c")
                       and not any(inside(rings, x, y) for k, rings in rows if k == d)])
    assert got == want


def test_points_outside_are_judged_without_rows_of_pairs(spark):
    """A point met some hundred cells, and all of these pairs were sorted for an aggregate over whole points."""
    _, polygons = shapes(spark)
    points = spark.createDataFrame([(1, 0.001, 0.001, "a", "x"), (2, 0.02, 0.02, "a", None), (2, 0.02, 0.02, "a", None)],
                                   "pk long, lat double, lon double, id string, note string")
    found = outside_declared(points, polygons, "lat", "lon", "id", "id", "rings")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortAggregate" not in plan and "any_value" not in plan
    assert [tuple(r) for r in found.collect()] == [(2, 0.02, 0.02, "a", None)] * 2


# -- times ---------------------------------------------------------------------------

def stamp(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def judged(rows, limit):
    out = {}
    for source in {s for _, s, _, _ in rows}:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: r[0])
        late, latest = 0, None
        for _, _, t, _ in own:
            late += t is not None and latest is not None and t < latest
            latest = t if latest is None or (t is not None and t > latest) else latest
        gaps, overlaps, islands, ended = [], 0, 0, None
        for _, _, t, length in sorted((r for r in own if r[2] is not None), key=lambda r: (r[2], r[0])):
            if ended is None or (t - ended) * 60 > limit:
                islands += 1
                gaps += [] if ended is None else [(t - ended) * 60]
            overlaps += ended is not None and t < ended
            ended = t + length if ended is None else max(ended, t + length)
        out[source] = (len(own), late, sum(r[2] is None for r in own), len(gaps), max(gaps, default=None), overlaps, islands)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_time_consistency_of_a_hot_source(spark, seed):
    draw = random.Random(seed)
    rows = [(i, "hot" if draw.random() < 0.6 else draw.choice([None, "a", "b"]),
             None if draw.random() < 0.05 else draw.choice([i, i, i + 40, max(i - 90, 0), 7]), draw.choice([0, 1, 30])) for i in range(900)]
    df = spark.createDataFrame([(i, s, stamp(t), n * 60) for i, s, t, n in rows], "id long, src string, at timestamp, s long").repartition(5)
    got = {r.src: (r.n_rows, r.n_out_of_order, r.n_undated, r.n_gaps, r.longest_gap_s, r.n_overlaps, r.n_islands)
           for r in timechecks.consistency(df, "src", "id", "at", F.col("s"), 1200).collect()}
    assert got == judged(rows, 1200)


def test_a_hot_source_is_more_than_one_window(spark):
    df = spark.range(20_000).select("id", F.lit("one").alias("src"), F.timestamp_seconds(F.col("id") * 60).alias("at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # small partitions are put together else
    try:
        found = timechecks.with_earlier_max(df, "src", ["id"], F.col("at"), "before")
        assert found.filter("before >= at OR (before IS NULL AND id > 0)").count() == 0
        assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# -- profile -------------------------------------------------------------------------

def test_sketches_are_within_their_bounds(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("k"), F.concat(F.lit("v"), F.col("id") % 7_001).alias("t"),
        (F.col("id") * 7919 % 60_000 / 3).alias("x"), F.array(F.col("id") % 5).alias("many"), F.lit(None).cast("string").alias("none"))
    found = {r.column_name: r for r in profile.with_estimates(profile.columns_profile(df)).collect()}
    for name, exact in (("k", 20_000), ("t", 7_001), ("x", 60_000), ("many", 5)):
        assert abs(found[name].n_distinct_about - exact) <= max(0.03 * exact, 1)
    for q in (25, 50, 75):
        assert abs(found["x"][f"q{q}"] - q / 100 * 20_000) <= 0.01 * 20_000
    assert found["none"].n_null == 60_000 and found["none"].n_distinct_about == 0 and found["t"].q50 is None


def test_profiles_of_parts_merge(spark):
    df = spark.range(1_000).select((F.col("id") - 500).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("t"))
    whole = profile.columns_profile(df)
    parts = [profile.columns_profile(df.filter(f"k % 2 = {r} OR k % 2 = -{r}")) for r in (0, 1)]
    exact = ["column_name", "kind", "n_rows", "n_null", "n_empty", "n_nan", "least", "most", "n_distinct_about"]
    rows = [sorted(map(tuple, profile.with_estimates(p).select(*exact).collect())) for p in (whole, profile.merge(*parts))]
    assert rows[0] == rows[1]
    assert rows[0][0][6:8] == ("-500", "499")


def test_profile_is_one_pass_and_handles_any_table(spark):
    df = spark.createDataFrame([], "a int, b string, c struct<x:int>, d map<string,int>, `e.f` double")
    rows = profile.with_estimates(profile.columns_profile(df)).collect()
    assert [(r.column_name, r.n_rows, r.n_null, r.least) for r in rows] == [(n, 0, 0, None) for n in ("a", "b", "c", "d", "e.f")]
    counted = spark.read.parquet(f"{SF}/orders.parquet")
    plan = profile.columns_profile(counted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert profile.duplicates(df, ["a"]).first().asDict() == {
        "n_rows": 0, "n_repeated_rows": 0, "n_repeated_keys": 0, "n_rows_of_repeated_keys": 0}


def test_duplicates_tell_null_from_empty(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (1, ""), (2, "x"), (None, "x"), (None, "x")], "a int, b string")
    got = profile.duplicates(df, ["a"]).first()
    assert (got.n_rows, got.n_repeated_rows, got.n_repeated_keys, got.n_rows_of_repeated_keys) == (6, 2, 2, 5)


# -- incident probability ------------------------------------------------------------

def test_forest_ranks_held_out_days(spark):
    scored = risk_queries.held_out(spark, SF).cache()
    assert risk.auc(scored) > 0.85
    rows = scored.agg(F.min("probability"), F.max("probability"), F.count("*")).first()
    assert 0 <= rows[0] < rows[1] <= 1 and rows[2] > 1000


def test_features_look_back_only(spark):
    hour = dt.timedelta(hours=1)
    base = dt.datetime(2024, 3, 1, 0, 30)
    counts = spark.createDataFrame([("a", base + i * hour, 10 * i) for i in (0, 1, 25, 30)] + [("a", None, 1)], "place string, stamp timestamp, intensity int")
    hits = spark.createDataFrame([("a", base), ("a", base + hour), ("a", base + 25 * hour), ("b", base)], "place string, stamp timestamp")
    weather = spark.createDataFrame([(base.date(), 10.0), (base.date(), 12.0)], "day date, temperature double")
    rows = risk.incident_features(counts, hits, weather).orderBy("slot").collect()
    assert [(r.recent_incidents, r.recent_intensity, r.label, r.temperature, r.hour) for r in rows] == [
        (0, 0.0, 1, 11.0, 0), (1, 0.0, 1, 11.0, 1), (1, 10.0, 1, None, 1), (1, 250.0, 0, None, 6)]


def test_places_not_seen_in_training(spark):
    rows = [("a" if i % 2 else "b", i, None, 1, 5.0 + i % 2, 5, i % 24, 1, None, 0, 0.0, i % 2) for i in range(40)]
    schema = ("place string, slot long, day date, n_counts long, mean_intensity double, max_intensity int, hour int, weekday int,"
              "temperature double, recent_incidents long, recent_intensity double, label int")
    known = spark.createDataFrame(rows, schema)
    model = risk.fit(known, trees=5, depth=3)
    new = spark.createDataFrame([("z", *rows[1][1:]), (None, *rows[0][1:])], schema)
    got = risk.probabilities(model, new).collect()
    assert len(got) == 2 and all(0 <= r.probability <= 1 for r in got) and got[0].temperature in (None, -1.0)
