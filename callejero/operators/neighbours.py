"""Exact k nearest neighbours on the sphere, by grids of many sizes.

Cells of a grid are halved from level to level, so a dense place is searched in small
cells and an empty one in large ones. For each query the counts of the cells say which
level is the finest whose three by three cells hold enough points; the k-th of those is
at most as far as the k-th of all. Where that distance is inside the cells searched, the
result is final; else the finest level whose cells reach that far is searched once more.
So there are two joins on cells, whatever the data, and no pair of far points is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callejero.constants import EARTH_RADIUS_KM
from callejero.functions.geo import haversine_km
from callejero.session import scratch_dir

#: level 0 is the whole world; a cell of the finest level is about 19 m high
LEVELS = 20
#: distances are compared to this many digits of a kilometre, ties go to the lower id
DIGITS = 9


def _cell(value: Column, low: float, span: float) -> Column:
    """Number of the finest cell along one axis."""
    cells = 1 << LEVELS
    return F.least(F.floor((value - low) / span * cells), F.lit(cells - 1)).cast("bigint")


def _gridded(df: DataFrame) -> DataFrame:
    # cells are as wide as high, in degrees: latitudes fill the lower half of the rows
    return df.withColumns({"y": _cell(F.col("lat"), -90.0, 360.0), "x": _cell(F.col("lon"), -180.0, 360.0)})


def _around(level: str) -> Column:
    """The three by three cells around a point; over the antimeridian they go on."""
    y, x = (f"shiftright({axis}, {LEVELS} - {level})" for axis in "yx")
    return F.expr(f"""array_distinct(flatten(transform(sequence(-1, 1), dy -> transform(sequence(-1, 1), dx ->
        struct({level} AS l, {y} + dy AS cy, pmod({x} + dx, shiftleft(1L, {level})) AS cx)))))""")


def _margin(level: Column, lat: Column) -> Column:
    """No point outside the three by three cells is nearer than this; the coarsest have no outside."""
    size = F.radians(F.least(F.lit(360.0) / F.pow(F.lit(2.0), level), F.lit(90.0)))
    # a little less than the arcs, which are computed with rounding
    across = F.asin(F.cos(F.radians(lat)) * F.sin(size))
    return F.when(level <= 1, F.lit(float("inf"))).otherwise(
        EARTH_RADIUS_KM * F.least(size, across) * (1 - 1e-9))


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k least of each query; the limit per group is taken before the shuffle, too."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _found(cells: DataFrame, points: DataFrame, k: int, apart: bool) -> DataFrame:
    """Candidates (query, id, distance) of queries whose cells are listed, the k best of each."""
    joined = cells.join(points, ["l", "cy", "cx"])
    if apart:
        joined = joined.filter("query <> id")
    distance = F.round(haversine_km(F.col("qlat"), F.col("qlon"), F.col("lat"), F.col("lon")), DIGITS)
    return _nearest(joined.withColumn("distance", distance), k)


def knn(queries: DataFrame, points: DataFrame, k: int, key: str, lat: str, lon: str, apart: bool = False) -> DataFrame:
    """query, neighbour, rank, distance_km: the ``k`` points nearest to each query, ties to the lower id.

    ``apart`` leaves out the point of the query's own id. Queries without coordinates have no
    neighbours, points without them are none. Ids must be unique in either table.
    """
    spark, folder = queries.sparkSession, scratch_dir(queries.sparkSession, "knn")
    wanted = k + 1 if apart else k

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    located = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon")
    rows = points.select(F.col(key).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    # of many points at one place only the first ids can be among the nearest
    same = Window.partitionBy("lat", "lon").orderBy("id")
    rows = rows.filter(located).withColumn("n", F.row_number().over(same)).filter(F.col("n") <= wanted).drop("n")
    rows = kept(_gridded(rows), "points")
    asked = _gridded(queries.select(
        F.col(key).alias("query"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).filter(located))
    asked = kept(asked, "queries")

    # points of each cell on every level, summed up per task first; then of three by three cells
    finest = rows.groupBy("y", "x").agg(F.count("*").alias("n"))
    counts = finest.select("y", "x", "n", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("l")).groupBy(
        "l", F.expr(f"shiftright(y, {LEVELS} - l)").alias("cy"), F.expr(f"shiftright(x, {LEVELS} - l)").alias("cx")).agg(
        F.sum("n").alias("n"))
    near = F.expr("""array_distinct(flatten(transform(sequence(-1, 1), dy -> transform(sequence(-1, 1), dx ->
        struct(l, cy + dy AS cy, pmod(cx + dx, shiftleft(1L, l)) AS cx)))))""")
    blocks = counts.select(F.explode(near).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n")).filter(F.col("n") >= wanted)
    enough = kept(blocks.select("c.*"), "enough")

    places = asked.select("y", "x").distinct().select("y", "x", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("l"))
    places = places.selectExpr("y", "x", "l", f"shiftright(y, {LEVELS} - l) AS cy", f"shiftright(x, {LEVELS} - l) AS cx")
    chosen = places.join(enough, ["l", "cy", "cx"]).groupBy("y", "x").agg(F.max("l").alias("l"))
    # fewer points than asked for: the whole world is one cell
    asked = kept(asked.join(chosen, ["y", "x"], "left").withColumn("l", F.coalesce("l", F.lit(0))), "levels")

    def cells(df: DataFrame) -> DataFrame:
        return df.select("query", F.col("lat").alias("qlat"), F.col("lon").alias("qlon"), F.explode(_around("l")).alias("c")).select(
            "query", "qlat", "qlon", "c.*")

    def points_at(levels: DataFrame) -> DataFrame:
        """Points in the cells of the levels in use only (there are at most ``LEVELS`` + 1)."""
        used = [r["l"] for r in levels.select("l").distinct().collect()]
        listed = F.explode(F.array([F.lit(n) for n in sorted(used)]).cast("array<int>"))
        return rows.select("id", "lat", "lon", "y", "x", listed.alias("l")).selectExpr(
            "id", "lat", "lon", "l", f"shiftright(y, {LEVELS} - l) AS cy", f"shiftright(x, {LEVELS} - l) AS cx")

    first = kept(_found(cells(asked), points_at(asked), k, apart), "first")
    reach = first.groupBy("query").agg(F.max("distance").alias("reach"), F.count("*").alias("found"))
    unsure = asked.join(reach, "query").filter(
        (F.col("found") < k) & (F.col("l") > 0) | (F.col("reach") > _margin(F.col("l"), F.col("lat"))))
    # the finest level that reaches far enough; margins grow twofold from level to level
    reaching = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(LEVELS)), lambda n: (
        F.when(F.col("found") < k, F.lit(float("inf"))).otherwise(F.col("reach")) <= _margin(n, F.col("lat")))))
    unsure = kept(unsure.withColumn("l", F.coalesce(reaching, F.lit(0))), "unsure")
    second = _found(cells(unsure), points_at(unsure), k, apart) if not unsure.isEmpty() else first.limit(0)
    sure = first.join(unsure.select("query"), "query", "left_anti")
    return sure.select("query", "id", "rank", "distance").unionByName(second.select("query", "id", "rank", "distance")).select(
        "query", F.col("id").alias("neighbour"), "rank", F.col("distance").alias("distance_km"))
