"""Points in polygons: a covering by cells, and ray casting only where an edge runs.

Each polygon's box is cut into cells of its own size (``CELLS`` along the longer side). A
cell that no edge touches is wholly inside or outside, as its middle is; only points in
the other cells are tested, against the edges that a ray to the east from that cell can
meet. Rings follow the even-odd rule, so holes are outside; a point on an edge, also on
that of a hole, counts as inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callejero.operators.joins import spread_key

CELLS = 16
#: cells of the grid that points and polygons meet in, in degrees
GRID = 0.01
SALTS = 16


def edges_of(rings: Column) -> Column:
    """Edges (x1, y1, x2, y2) of rings of [longitude, latitude]; a ring need not be closed."""
    def of_ring(ring: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ring)), lambda i: F.struct(
            ring[i - 1][0].alias("x1"), ring[i - 1][1].alias("y1"),
            ring[i % F.size(ring)][0].alias("x2"), ring[i % F.size(ring)][1].alias("y2")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), of_ring))


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Whether a point is on one of the edges, or has an odd number of them to its east."""
    def cross(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def on(e: Column) -> Column:
        return ((cross(e) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))

    def east(e: Column) -> Column:
        # upward edges have an inside point on their left, downward ones on their right
        crosses = (e["y1"] > y) != (e["y2"] > y)
        return crosses & F.when(e["y2"] > e["y1"], cross(e) > 0).otherwise(cross(e) < 0)

    parity = F.aggregate(edges, F.lit(False), lambda odd, e: odd != east(e))
    return F.exists(edges, on) | parity


def covering(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """key, box of a cell and what it is: ``edges`` that a ray from it can meet, or none where it is wholly inside.

    ``polygons`` has one row per polygon, ``rings`` its outline and holes.
    """
    cut = polygons.select(key, edges_of(F.col(rings)).alias("edges")).filter(F.size("edges") > 0)
    boxes = cut.select(
        key, "edges", *[F.array_min(F.transform("edges", lambda e: F.least(e[f"{a}1"], e[f"{a}2"]))).alias(f"low_{a}") for a in "xy"],
        *[F.array_max(F.transform("edges", lambda e: F.greatest(e[f"{a}1"], e[f"{a}2"]))).alias(f"high_{a}") for a in "xy"])
    side = F.greatest(F.col("high_x") - F.col("low_x"), F.col("high_y") - F.col("low_y")) / CELLS
    sized = boxes.withColumn("side", F.when(side > 0, side).otherwise(F.lit(1e-9)))
    for a in "xy":
        count = F.least(F.ceil((F.col(f"high_{a}") - F.col(f"low_{a}")) / F.col("side")), F.lit(CELLS)).cast("int")
        sized = sized.withColumn(f"n{a}", F.greatest(count, F.lit(1)))
    cells = sized.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    for a, place in (("x", "i"), ("y", "j")):
        # neighbours share a border; the outer ones end where the polygon does
        cells = cells.withColumn(f"c0{a}", F.col(f"low_{a}") + F.col(place) * F.col("side")).withColumn(
            f"c1{a}", F.when(F.col(place) == F.col(f"n{a}") - 1, F.col(f"high_{a}")).otherwise(
                F.col(f"low_{a}") + (F.col(place) + 1) * F.col("side")))

    def meets(e: Column) -> Column:
        # the boxes touch: more than needed, never less
        return ((F.least(e["x1"], e["x2"]) <= F.col("c1x")) & (F.greatest(e["x1"], e["x2"]) >= F.col("c0x"))
                & (F.least(e["y1"], e["y2"]) <= F.col("c1y")) & (F.greatest(e["y1"], e["y2"]) >= F.col("c0y")))

    def ray(e: Column) -> Column:
        return ((F.greatest(e["x1"], e["x2"]) >= F.col("c0x")) & (F.least(e["y1"], e["y2"]) <= F.col("c1y"))
                & (F.greatest(e["y1"], e["y2"]) >= F.col("c0y")))

    touched = F.exists("edges", meets)
    middle = contains(F.col("edges"), (F.col("c0x") + F.col("c1x")) / 2, (F.col("c0y") + F.col("c1y")) / 2)
    return cells.filter(touched | middle).select(
        key, "c0x", "c1x", "c0y", "c1y", F.when(touched, F.filter("edges", ray)).alias("edges"))


def _grid(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(F.floor(low / GRID), F.floor(high / GRID)))


def _met(points: DataFrame, polygons: DataFrame, lat: str, lon: str, key: str, rings: str,
         salts: int) -> tuple[DataFrame, DataFrame, Column, Column]:
    """Points, cells, whether the two are of one square, and whether the point is in that cell's polygon.

    Points and cells meet in the squares of a common grid. A square that holds a third of
    the points is shared by ``salts`` tasks.
    """
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    cells = covering(polygons, key, rings).select(F.col(key).alias("__key"), "c0x", "c1x", "c0y", "c1y", "edges", _grid(
        F.col("c0x"), F.col("c1x")).alias("__cx"))
    cells = cells.select("*", _grid(F.col("c0y"), F.col("c1y")).alias("__cy")).withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = points.withColumns({
        "__x": x, "__y": y, "__gx": F.floor(x / GRID), "__gy": F.floor(y / GRID),
        "__salt": F.pmod(spread_key(points), F.lit(salts)).cast("int")})
    met = (F.col("__gx") == F.col("__cx")) & (F.col("__gy") == F.col("__cy")) & (F.col("__salt") == F.col("__part"))
    inside = F.col("edges").isNull() | contains(F.col("edges"), F.col("__x"), F.col("__y"))
    hit = F.col("__x").between(F.col("c0x"), F.col("c1x")) & F.col("__y").between(F.col("c0y"), F.col("c1y")) & inside
    return placed, cells, met, hit


def locate(points: DataFrame, polygons: DataFrame, lat: str, lon: str, key: str, rings: str, salts: int = SALTS) -> DataFrame:
    """Every point once for each region that holds it: the point's columns and ``key``."""
    placed, cells, met, hit = _met(points, polygons, lat, lon, key, rings, salts)
    found = placed.withColumn("__place", F.monotonically_increasing_id()).join(cells, met & hit)
    # a point on the border of two cells is found in both
    return found.dropDuplicates(["__place", "__key"]).select(
        *[F.col(f"`{c}`") for c in points.columns], F.col("__key").alias(key))


def outside_declared(points: DataFrame, polygons: DataFrame, lat: str, lon: str, declared: str, key: str,
                     rings: str, salts: int = SALTS) -> DataFrame:
    """Points with coordinates that lie in no polygon of the region they declare.

    A point that declares no region, or one without polygons, is not judged. A point is
    dropped at the first cell that holds it, so pairs of points and cells are never rows.
    """
    known = polygons.select(F.col(key).alias(declared)).distinct()
    asked = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).join(known, declared, "left_semi").select(
        *[F.col(f"`{c}`") for c in points.columns])
    placed, cells, met, hit = _met(asked, polygons, lat, lon, key, rings, salts)
    own = F.col("__declared") == F.col("__key")
    return placed.withColumn("__declared", F.col(f"`{declared}`")).join(cells, met & own & hit, "left_anti").select(
        *[F.col(f"`{c}`") for c in points.columns])
