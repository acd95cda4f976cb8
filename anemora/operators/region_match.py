"""Nearest grid point per region for many locations (problem 1).

Every region's reach is covered by square cells of several sizes. A cell is *interior* when one grid point is the
answer for every place in it, and *boundary* when several grid points (or none) may be. Boundary cells are halved
once, and again as long as more than LEAVE candidates are left in them. Locations meet the cover by an equi-join on
(level, cell): an interior cell gives the grid point at once, a boundary cell's few candidates are measured exactly. No
location is compared with a whole grid. A cover too large to be broadcast stands under SALTS keys a cell, so that a cell
with a third of all locations is several tasks' work.

Nulls, impossible coordinates: a location without usable coordinates has no row in the result. Cells sent twice and
repeated locations count once. Empty inputs give an empty result. Extra columns of either input are not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.session import written

#: Size of the coarsest cells in degrees; it divides 360, and every further level halves it.
CELL_SIZE = 0.1
#: Halvings at most, and candidates up to which a cell that was halved once is left as it is.
DEPTH = 6
LEAVE = 4
SALTS = 8
MAX_DIST = 0.2
#: Cells of a cover that are broadcast, at most; a cell takes some 300 bytes.
COVER_ROWS = 300_000
EPS = 1e-9


def lon_gap(a: Column, b: Column) -> Column:
    """Difference of two longitudes in degrees, the shorter way round."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def usable(lat: Column, lon: Column) -> Column:
    """Neither null nor NaN, latitude within ±90, longitude within ±540."""
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return ok & (F.abs(lat) <= 90) & (F.abs(lon) <= 540)


def _cell_ids(size: float, lat: Column, lon: Column) -> tuple[Column, Column]:
    return F.floor((lat + 90.0) / size).cast("int"), F.pmod(F.floor((lon + 180.0) / size).cast("int"), F.lit(round(360 / size)))


def _classify(pairs: DataFrame, size: float, max_dist: float) -> DataFrame:
    """One row per (region, cell): the grid points that may be nearest somewhere in it, and whether that settles it.

    pairs: region, kind, idx0, idx1, lat, lon, ci, cj; every grid point that can be nearest in the cell must be there.
    """
    h = size / 2
    rotated = F.col("kind") == "rotated_pole"
    r = F.when(rotated, h * 2**0.5).otherwise(h)

    def gaps(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
        a = F.abs(lat - ((F.col("ci") + 0.5) * size - 90.0))
        b = lon_gap(lon, (F.col("cj") + 0.5) * size - 180.0)
        return a, b, F.when(rotated, F.sqrt(a * a + b * b)).otherwise(F.greatest(a, b))

    dlat, dlon, far = gaps(F.col("lat"), F.col("lon"))
    cells = (
        pairs.filter(far <= max_dist + r + EPS)
        .groupBy("region", "kind", "ci", "cj")
        .agg(F.collect_list(F.struct("idx0", "idx1", "lat", "lon")).alias("near"), F.min(dlat).alias("a"), F.min(dlon).alias("b"), F.min(far).alias("d"))
    )

    # of a regular grid the nearest latitude and the nearest longitude are sought apart, of a rotated one the nearest point
    def keep(p: Column) -> Column:
        a, b, d = gaps(p["lat"], p["lon"])
        return F.when(rotated, d < F.col("d") + 2 * r - EPS).otherwise((a < F.col("a") + 2 * h - EPS) & (b < F.col("b") + 2 * h - EPS))

    one = F.element_at("near", 1)
    return cells.withColumn("near", F.filter("near", keep)).select(
        "region", "kind", "ci", "cj", "near", ((F.size("near") == 1) & (gaps(one["lat"], one["lon"])[2] + r <= max_dist + EPS)).alias("interior")
    )


def _reach(points: DataFrame, max_dist: float) -> DataFrame:
    """points with how far in latitude (reach0) and longitude (reach1) a place can be that has the point as its nearest.

    Half the gap to the next latitude and longitude of a regular grid; the gap to the four neighbours of a rotated one,
    whose nearest places all lie within it; max_dist at a border, and never more.
    """
    gap = lambda other: F.sqrt(F.pow(F.col("lat") - other["lat"], 2) + F.pow(lon_gap(F.col("lon"), other["lon"]), 2))
    here = F.struct("lat", "lon")
    rows = Window.partitionBy("region", "idx1")
    cols = Window.partitionBy("region", "idx0")
    rotated = F.col("kind") == "rotated_pole"
    along = {}
    for n, (part, axis, index) in enumerate(((rows, "lat", "idx0"), (cols, "lon", "idx1"))):
        order = part.orderBy(F.when(rotated, F.col(index)).otherwise(F.col(axis)), index)
        along[f"gap{n}"] = F.greatest(*[F.coalesce(gap(f(here).over(order)), F.lit(2 * max_dist)) for f in (F.lag, F.lead)])
    out = points.withColumns(along)
    both = F.greatest("gap0", "gap1")
    return out.select(*points.columns, *[F.least(F.when(rotated, both).otherwise(F.col(f"gap{n}") / 2) + EPS, F.lit(max_dist)).alias(f"reach{n}") for n in (0, 1)])


def cover(grid: DataFrame, max_dist: float = MAX_DIST, size: float = CELL_SIZE, occupied: DataFrame | None = None, leave: int = LEAVE, depth: int = DEPTH) -> tuple[DataFrame, list[float]]:
    """The cells of every region's reach (level, ci, cj, region, kind, interior, near: candidates, one if interior) and the sizes of the levels.

    Only in the coarsest cells (ci, cj) of `occupied`, if given.
    """
    points = (
        grid.select("region", F.col("grid_kind").alias("kind"), "idx0", "idx1", "lat", F.col("lon").cast("double"))
        .filter(F.col("region").isNotNull() & F.col("idx0").isNotNull() & F.col("idx1").isNotNull() & usable(F.col("lat"), F.col("lon")))
        .withColumn("lon", F.pmod(F.col("lon") + 180.0, F.lit(360.0)) - 180.0)
        .distinct()
    )
    s0 = size
    span = lambda x, low, reach: F.sequence(*[F.floor((F.col(x) + low + d * F.col(reach)) / s0).cast("int") for d in (-1, 1)])
    pairs = (
        _reach(points, max_dist)
        .withColumn("ci", F.explode(span("lat", 90.0, "reach0")))
        .withColumn("cj", F.explode(span("lon", 180.0, "reach1")))
        .withColumn("cj", F.pmod("cj", F.lit(round(360 / s0))))
        .drop("reach0", "reach1")
    )
    if occupied is not None:
        pairs = pairs.join(occupied, ["ci", "cj"], "left_semi")
    out, sizes = [], [size]
    for level in range(depth + 1):
        cells = written(_classify(pairs, sizes[-1], max_dist).withColumn("level", F.lit(level)), "cover")
        halve = ~F.col("interior") & (F.size("near") > (leave if level else 0))
        if level == depth or not cells.filter(halve).limit(1).count():
            out.append(cells)
            break
        out.append(cells.filter(~halve))
        pairs = (
            cells.filter(halve)
            .select("region", "kind", "ci", "cj", F.explode("near").alias("p"))
            .select("region", "kind", "p.idx0", "p.idx1", "p.lat", "p.lon", "ci", "cj")
            .withColumn("ci", F.explode(F.array(F.col("ci") * 2, F.col("ci") * 2 + 1)))
            .withColumn("cj", F.explode(F.array(F.col("cj") * 2, F.col("cj") * 2 + 1)))
        )
        sizes.append(sizes[-1] / 2)
    return reduce(DataFrame.unionByName, out).select("level", "ci", "cj", "region", "kind", "interior", "near"), sizes


def nearest_in_regions(
    places: DataFrame,
    grid: DataFrame,
    id_col: str = "match_id",
    max_dist: float = MAX_DIST,
    size: float = CELL_SIZE,
    broadcast_rows: int = COVER_ROWS,
) -> DataFrame:
    """(id, region, idx0, idx1, dist_deg, interior): the nearest grid point of every region within max_dist of a place.

    The cover is made where there are places, and grows with the grid, never with the places. It is counted and broadcast
    only up to broadcast_rows; beyond that the join shuffles by cell and salt.
    """
    rows = places.select(F.col(id_col).alias("id"), F.col("lat").cast("double").alias("plat"), F.col("lon").cast("double").alias("plon"))
    rows = rows.filter(usable(F.col("plat"), F.col("plon")) & F.col("id").isNotNull())
    at = rows.groupBy("id").agg(F.min(F.struct("plat", "plon")).alias("at")).select("id", F.col("at.plat").alias("plat"), F.col("at.plon").alias("plon"))
    ci, cj = _cell_ids(size, F.col("plat"), F.col("plon"))
    occupied = rows.select(ci.alias("ci"), cj.alias("cj")).distinct()
    cells, sizes = cover(grid, max_dist, size, occupied)
    keys = F.array(*[F.struct(F.lit(n).alias("level"), *[c.alias(a) for c, a in zip(_cell_ids(s, F.col("plat"), F.col("plon")), ("ci", "cj"))]) for n, s in enumerate(sizes)])
    at = at.withColumn("key", F.explode(keys)).select("id", "plat", "plon", "key.level", "key.ci", "key.cj")
    if cells.count() <= broadcast_rows:
        joined = at.join(F.broadcast(cells), ["level", "ci", "cj"])
    else:
        salted = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = at.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["level", "ci", "cj", "salt"])

    def measure(p: Column) -> Column:
        a, b = F.abs(p["lat"] - F.col("plat")), lon_gap(p["lon"], F.col("plon"))
        rotated = F.col("kind") == "rotated_pole"
        d = F.when(rotated, F.sqrt(a * a + b * b)).otherwise(F.greatest(a, b))
        return F.struct(F.when(rotated, d).otherwise(a + b).alias("rank"), p["idx0"].alias("idx0"), p["idx1"].alias("idx1"), F.round(d, 9).alias("dist_deg"))

    exact = F.array_min(F.transform("near", measure))
    best = F.when(F.col("interior"), measure(F.element_at("near", 1))).otherwise(exact)
    return (
        joined.withColumn("best", best)
        .select(F.col("id").alias(id_col), "region", "best.idx0", "best.idx1", "best.dist_deg", "interior")
        .filter(F.col("dist_deg") <= max_dist)
    )
