"""Stations on grids: nearest and bilinear matching, weighted gathering, threshold lookup, grid comparison.

Regular grids are matched axis by axis, without moving a station: each axis is laid out in bins of its mean step, and a
station looks at the few values that can answer in its bin. Two-dimensional grids meet the stations by an equi-join on degree tiles. Of equally near values the one with the smaller index wins.
Stations without coordinates have no row in a match. Empty grids give empty matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.session import small, written

#: Degrees within which a station counts as lying on its cell.
MAX_DIST = 0.15


def lon_diff(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def axes(cells: DataFrame) -> DataFrame:
    """(region, lats, lons): each regular grid's axes as arrays of (g, i), coordinate and index. One short row per region."""
    regular = cells.filter((F.col("grid_kind") == "regular_latlon") & F.col("region").isNotNull())
    axis = lambda g, i: F.array_sort(F.collect_set(F.struct(F.col(g).alias("g"), F.col(i).alias("i"))))
    return regular.groupBy("region").agg(axis("lat", "idx0").alias("lats"), axis("lon", "idx1").alias("lons"))


#: Values of all axes together up to which the bins are broadcast; some 50 bytes each.
AXIS_VALUES = 1_000_000
EPS = 1e-6


def _axis_bins(values: DataFrame, name: str, bracket: bool, circular: bool) -> DataFrame:
    """(region, <name>): an axis as struct(x0, step, bins); bins[k] holds the values (g, i, and of the next one ng, ni) that can answer between x0 + k * step and the next bin.

    values: region, g, i. Answers are the nearest value, or with bracket the last one at or below. A circular axis goes on
    beyond both its ends; of another one the first and last bin also stand for everything beyond.
    """
    own = values.groupBy("region", F.round("g", 9).alias("r")).agg(F.min(F.struct("i", "g")).alias("m")).select("region", "m.g", "m.i")
    if circular:
        own = own.withColumn("g", F.pmod(F.col("g") + 180.0, F.lit(360.0)) - 180.0).withColumn("g", F.explode(F.array(*[F.col("g") + d for d in (-360.0, 0.0, 360.0)])))
    order, whole = Window.partitionBy("region").orderBy("g"), Window.partitionBy("region")
    own = own.withColumns({"pg": F.lag("g").over(order), "ng": F.lead("g").over(order), "ni": F.lead("i").over(order), "a": F.min("g").over(whole), "b": F.max("g").over(whole), "n": F.count(F.lit(1)).over(whole)})
    step = F.when(F.col("n") > 1, (F.col("b") - F.col("a")) / (F.col("n") - 1)).otherwise(1.0)
    last = F.col("n").cast("int") + 1
    k = lambda x: F.greatest(F.lit(0), F.least(last, F.floor((x - F.col("a")) / step).cast("int") + 1))
    low = k((F.col("g") if bracket else (F.col("g") + F.col("pg")) / 2) - EPS)
    high = k((F.col("ng") if bracket else (F.col("g") + F.col("ng")) / 2) + EPS)
    low, high = F.when(F.col("pg").isNull(), 0).otherwise(low), F.when(F.col("ng").isNull(), last).otherwise(high)
    spread = own.select("region", "a", step.alias("step"), F.struct("g", "i", "ng", "ni").alias("v"), F.explode(F.sequence(low, high)).alias("k"))
    bins = spread.groupBy("region", "a", "step", "k").agg(F.collect_list("v").alias("v")).groupBy("region", "a", "step").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("bins"))
    return bins.select("region", F.struct((F.col("a") - F.col("step")).alias("x0"), "step", F.transform("bins", lambda x: x["v"]).alias("bins")).alias(name))


def _in_bin(axis: str, x: Column) -> Column:
    """The values of an axis that can answer for x."""
    k = F.floor((x - F.col(f"{axis}.x0")) / F.col(f"{axis}.step")).cast("int")
    return F.element_at(F.col(f"{axis}.bins"), F.greatest(F.lit(0), F.least(F.size(f"{axis}.bins") - 1, k)) + 1)


def _axis_values(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    regular = cells.filter((F.col("grid_kind") == "regular_latlon") & F.col("region").isNotNull())
    return tuple(regular.select("region", F.col(g).alias("g"), F.col(i).alias("i")).distinct() for g, i in (("lat", "idx0"), ("lon", "idx1")))


def _with_bins(stations: DataFrame, cells: DataFrame, bracket: bool) -> DataFrame:
    """Stations with their region's axes (lats, lons) in bins. The table of axes is counted, and broadcast up to AXIS_VALUES values."""
    lats, lons = _axis_values(cells)
    both = written(_axis_bins(lats, "lats", bracket, False).join(_axis_bins(lons, "lons", bracket, True), "region"), "axes")
    n = both.agg(F.sum(F.size("lats.bins") + F.size("lons.bins"))).first()[0] or 0
    return stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(small(both, n, AXIS_VALUES), "region")


def _on_axes(stations: DataFrame, cells: DataFrame) -> DataFrame:
    """Stations with their region's axes as arrays (see axes)."""
    table = written(axes(cells), "axes")
    n = table.agg(F.sum(F.size("lats") + F.size("lons"))).first()[0] or 0
    return stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(small(table, n, AXIS_VALUES), "region")


def nearest_regular(stations: DataFrame, cells: DataFrame, key: str = "station", max_dist: float = MAX_DIST) -> DataFrame:
    """(key, region, idx0, idx1, dist_deg, valid): nearest latitude and longitude of the station's region, apart.

    stations: key, region, lat, lon. dist_deg is the larger of the two differences. No station row is shuffled.
    """
    near = lambda axis, x, d: F.array_min(F.transform(_in_bin(axis, x), lambda v: F.struct(F.round(d(v["g"]), 9).alias("d"), v["i"].alias("i"))))
    lat, lon = F.col("lat"), F.col("lon")
    both = _with_bins(stations, cells, False).select(key, "region", near("lats", lat, lambda g: F.abs(g - lat)).alias("a"), near("lons", F.pmod(lon + 180.0, F.lit(360.0)) - 180.0, lambda g: lon_diff(g, lon)).alias("b"))
    return both.select(key, "region", F.col("a.i").alias("idx0"), F.col("b.i").alias("idx1"), F.greatest("a.d", "b.d").alias("dist_deg")).withColumn("valid", F.col("dist_deg") <= max_dist)


def nearest_2d(stations: DataFrame, cells: DataFrame, key: str = "station", reach: float = 0.5) -> DataFrame:
    """(key, region, idx0, idx1, dist_deg): nearest cell of two-dimensional grids within reach, without a seam at ±180.

    Cells are put into every tile of `reach` degrees that a station near them can be in, stations into their own.
    """
    tile = lambda c, d=0: (F.floor(c / reach) + d).cast("int")
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    spread = (
        cells.filter(F.col("grid_kind") == "rotated_pole").select("region", "idx0", "idx1", F.col("lat").alias("glat"), F.col("lon").alias("glon")).distinct()
        .withColumn("y", F.explode(F.transform(around, lambda d: tile(F.col("glat")) + d)))
        .withColumn("x", F.explode(F.transform(around, lambda d: tile(F.col("glon")) + d)))
    )
    at = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(key, "lat", "lon", tile(F.col("lat")).alias("y"), tile(F.col("lon")).alias("x"))
    d = F.round(F.sqrt(F.pow(F.col("lat") - F.col("glat"), 2) + F.pow(F.col("lon") - F.col("glon"), 2)), 9)
    best = at.join(spread, ["y", "x"]).withColumn("d", d).filter(F.col("d") <= reach).groupBy(key, "region").agg(F.min(F.struct("d", "idx0", "idx1")).alias("m"))
    return best.select(key, "region", "m.idx0", "m.idx1", F.col("m.d").alias("dist_deg"))


def nearest_2d_own(stations: DataFrame, cells: DataFrame, key: str = "station", max_dist: float = MAX_DIST, reach: float = 0.5) -> DataFrame:
    """(key, region, idx0, idx1, dist_deg, valid): the nearest cell of the station's own two-dimensional grid, however far it lies.

    stations: key, region, lat, lon. Those without a cell within reach look on in tiles four times as large, and so on; a
    search ends where no station is left, at the latest with tiles larger than the globe.
    """
    grid = cells.filter((F.col("grid_kind") == "rotated_pole") & F.col("region").isNotNull()).select("region", "idx0", "idx1", F.col("lat").alias("glat"), F.col("lon").alias("glon")).distinct()
    left = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(key, "region", "lat", "lon").join(grid.select("region").distinct(), "region", "left_semi")
    found = []
    while True:
        tile = lambda c, d=0, size=reach: (F.floor(F.col(c) / size) + d).cast("int")
        around = lambda c: F.explode(F.array(*[tile(c, d) for d in (-1, 0, 1)]))
        d = F.round(F.sqrt(F.pow(F.col("lat") - F.col("glat"), 2) + F.pow(F.col("lon") - F.col("glon"), 2)), 9)
        near = left.withColumns({"y": tile("lat"), "x": tile("lon")}).join(grid.withColumn("y", around("glat")).withColumn("x", around("glon")), ["region", "y", "x"]).withColumn("d", d).filter(F.col("d") <= reach)
        best = near.groupBy(key, "region").agg(F.min(F.struct("d", "idx0", "idx1")).alias("m"))
        found.append(written(best.select(key, "region", "m.idx0", "m.idx1", F.col("m.d").alias("dist_deg")), "near"))
        left = written(left.join(found[-1].select(key, "region"), [key, "region"], "left_anti"), "left")
        if reach > 540 or not left.limit(1).count():
            break
        reach *= 4
    return reduce(DataFrame.unionByName, found).withColumn("valid", F.col("dist_deg") <= max_dist)


def bilinear(stations: DataFrame, cells: DataFrame, key: str = "station") -> DataFrame:
    """(key, region, corner, idx0, idx1, weight): the four surrounding cells, in the order SW, SE, NW, NE.

    Latitudes beyond the grid are held at its border, longitudes go round. Weights add up to 1. A station whose region is a
    two-dimensional grid raises an error when its row is read.
    """
    kinds = cells.filter("region is not null").groupBy("region").agg(F.max((F.col("grid_kind") == "rotated_pole").cast("int")).alias("turned"))
    fault = F.raise_error(F.lit("bilinear weights need a regular grid")).cast("double")
    stations = stations.join(kinds, "region", "left").withColumn("lat", F.when(F.col("turned") == 1, fault).otherwise(F.col("lat"))).drop("turned")
    round_ = lambda x: F.pmod(x, F.lit(360.0))
    both = _with_bins(stations, cells, True).withColumn("lon", round_(F.col("lon") + 180.0) - 180.0)
    held = lambda axis, c: F.coalesce(F.array_max(F.filter(_in_bin(axis, F.col(c)), lambda v: v["g"] <= F.col(c))), F.array_min(_in_bin(axis, F.col(c))))
    both = both.withColumns({"y": held("lats", "lat"), "x": held("lons", "lon")})
    # before the first latitude both neighbours are the first, beyond the last one both the last
    inside = (F.col("y.g") <= F.col("lat")) & F.col("y.ng").isNotNull()
    pair = lambda g, i: F.struct(g.alias("g"), i.alias("i"))
    both = both.select(
        key, "region", "lat", "lon", pair(F.col("y.g"), F.col("y.i")).alias("s"), pair(F.when(inside, F.col("y.ng")).otherwise(F.col("y.g")), F.when(inside, F.col("y.ni")).otherwise(F.col("y.i"))).alias("n"),
        pair(F.col("x.g"), F.col("x.i")).alias("w"), pair(F.col("x.ng"), F.col("x.ni")).alias("e"),
    )
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    span = round_(F.col("e.g") - F.col("w.g"))
    fy = clip(F.coalesce(F.try_divide(F.col("lat") - F.col("s.g"), F.col("n.g") - F.col("s.g")), F.lit(0.0)))
    fx = clip(F.coalesce(F.try_divide(round_(F.col("lon") - F.col("w.g")), span), F.lit(0.0)))
    both = both.withColumns({"fy": fy, "fx": fx})
    corner = lambda n, y, x, w: F.struct(F.lit(n).alias("corner"), F.col(f"{y}.i").alias("idx0"), F.col(f"{x}.i").alias("idx1"), w.alias("weight"))
    fy, fx = F.col("fy"), F.col("fx")
    four = F.array(corner(0, "s", "w", (1 - fy) * (1 - fx)), corner(1, "s", "e", (1 - fy) * fx), corner(2, "n", "w", fy * (1 - fx)), corner(3, "n", "e", fy * fx))
    return both.select(key, "region", F.inline(four))


def nearest_valid(matched: DataFrame, stations: DataFrame, cells: DataFrame, valid: DataFrame, key: str = "station", rings: int = 3) -> DataFrame:
    """(key, region, idx0, idx1, ring): the matched cell if valid, else a valid one of the nearest square ring around it.

    In a ring the smallest dist_deg wins, then the smaller idx0, then idx1. Longitude indexes go round, latitude ones do
    not. valid: region, idx0, idx1. The first `rings` rings are looked up cell by cell, farther ones along the grid's rows; a
    station has no row only where its grid has no valid cell at all.
    """
    good = valid.select("region", "idx0", "idx1").distinct()
    cols = [key, "region", "idx0", "idx1"]
    standing = matched.select(*cols).join(good, ["region", "idx0", "idx1"], "left_semi").select(*cols, F.lit(0).alias("ring"))
    matched = matched.select(*cols).join(good, ["region", "idx0", "idx1"], "left_anti")
    step = F.sequence(F.lit(-rings), F.lit(rings))
    near = _on_axes(matched.select(key, "region", F.col("idx0").alias("i0"), F.col("idx1").alias("j0")).join(stations.select(key, "lat", "lon"), key), cells)
    near = near.withColumn("width", F.array_max(F.transform("lons", lambda x: x["i"])) + 1)
    near = near.withColumn("di", F.explode(step)).withColumn("dj", F.explode(step))
    near = near.withColumns({"idx0": F.col("i0") + F.col("di"), "idx1": F.pmod(F.col("j0") + F.col("dj"), F.col("width")), "ring": F.greatest(F.abs("di"), F.abs("dj"))})
    at = lambda axis, i: F.try_element_at(F.filter(axis, lambda x: x["i"] == F.col(i)), F.lit(1))["g"]
    dist = F.greatest(F.abs(at("lats", "idx0") - F.col("lat")), lon_diff(at("lons", "idx1"), F.col("lon")))
    near = near.withColumn("d", F.round(dist, 9)).select(key, "region", "idx0", "idx1", "ring", "d").filter(F.col("d").isNotNull())
    near = near.join(good, ["region", "idx0", "idx1"])
    best = near.groupBy(key, "region").agg(F.min(F.struct("ring", "d", "idx0", "idx1")).alias("m"))
    best = written(best.select(key, "region", "m.idx0", "m.idx1", "m.ring"), "rings")
    return standing.unionByName(best).unionByName(_beyond_rings(matched.join(best, [key, "region"], "left_anti"), stations, cells, valid, key))


def _beyond_rings(left: DataFrame, stations: DataFrame, cells: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """nearest_valid for stations whose first rings hold no valid cell.

    The ring comes from each matched cell once, over the rows of its grid; then the stations measure the cells of that ring.
    """
    regular = cells.filter(F.col("grid_kind") == "regular_latlon")
    lats, lons = regular.groupBy("region", "idx0").agg(F.min("lat").alias("glat")), regular.groupBy("region", "idx1").agg(F.min("lon").alias("glon"))
    width = regular.groupBy("region").agg((F.max("idx1") + 1).alias("width"))
    rows = valid.select("region", "idx0", "idx1").distinct().join(lats, ["region", "idx0"]).join(lons, ["region", "idx1"])
    rows = rows.groupBy("region", F.col("idx0").alias("i"), "glat").agg(F.collect_list(F.struct(F.col("idx1").alias("j"), F.col("glon").alias("g"))).alias("row"))
    ring = lambda j: F.greatest(F.abs(F.col("i") - F.col("i0")), F.least(F.pmod(j - F.col("j0"), F.col("width")), F.pmod(F.col("j0") - j, F.col("width"))))
    left = left.select(key, "region", F.col("idx0").alias("i0"), F.col("idx1").alias("j0"))
    at = left.select("region", "i0", "j0").distinct().join(width, "region").join(rows, "region")
    rings = at.groupBy("region", "i0", "j0", "width").agg(F.min(F.array_min(F.transform("row", lambda x: ring(x["j"])))).alias("ring"))
    own = left.join(stations.select(key, "lat", "lon"), key).join(rings, ["region", "i0", "j0"]).join(rows, "region").filter(F.abs(F.col("i") - F.col("i0")) <= F.col("ring"))
    d = lambda x: F.round(F.greatest(F.abs(F.col("glat") - F.col("lat")), lon_diff(x["g"], F.col("lon"))), 9)
    inside = F.filter("row", lambda x: ring(x["j"]) == F.col("ring"))
    best = own.select(key, "region", "ring", F.array_min(F.transform(inside, lambda x: F.struct(d(x).alias("d"), F.col("i").alias("idx0"), x["j"].alias("idx1")))).alias("m"))
    return best.groupBy(key, "region", "ring").agg(F.min("m").alias("m")).select(key, "region", "m.idx0", "m.idx1", "ring")


def gather(bridge: DataFrame, cube: DataFrame, value: str = "v", key: str = "station", how: str = "renormalise") -> DataFrame:
    """(key, t, value) from a cube (region, idx0, idx1, t, value) over a bridge (key, region, idx0, idx1, weight).

    how: 'renormalise' takes the mean over the corners that have a value, 'strict' is missing if any corner is.
    A bridge without weight counts each cell once.
    """
    if "weight" not in bridge.columns:
        bridge = bridge.withColumn("weight", F.lit(1.0))
    both = cube.join(bridge, ["region", "idx0", "idx1"]).withColumn("p", F.col("weight") * F.col(value))
    total = F.sum("p")
    if how == "renormalise":
        out = F.try_divide(total, F.sum(F.when(F.col(value).isNotNull(), F.col("weight"))))
    else:
        out = F.when(F.count(value) == F.count(F.lit(1)), total)
    return both.groupBy(key, "t").agg(out.alias(value))


def lookup_sparse(stations: DataFrame, thresholds: DataFrame, key: str = "station", tolerance: float = 1e-5) -> DataFrame:
    """(key, row, dist_deg): the threshold row of the same type within tolerance in both coordinates; the nearest, then smallest.

    Both sides meet on coordinates rounded to four decimals; the thresholds also stand under the neighbouring ones.
    """
    q = lambda c, d=0: (F.round(c * 1e4) + d).cast("bigint")
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    t = thresholds.select("tech", "row", F.col("lat").alias("tlat"), F.col("lon").alias("tlon"))
    t = t.withColumn("y", F.explode(F.transform(around, lambda d: q(F.col("tlat")) + d))).withColumn("x", F.explode(F.transform(around, lambda d: q(F.col("tlon")) + d)))
    s = stations.select(key, "tech", "lat", "lon", q(F.col("lat")).alias("y"), q(F.col("lon")).alias("x"))
    d = F.greatest(F.abs(F.col("lat") - F.col("tlat")), F.abs(F.col("lon") - F.col("tlon")))
    best = s.join(t, ["tech", "y", "x"]).withColumn("d", d).filter(F.col("d") <= tolerance).groupBy(key).agg(F.min(F.struct("d", "row")).alias("m"))
    return best.select(key, "m.row", F.col("m.d").alias("dist_deg"))


def grid_differences(a: DataFrame, b: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(region, idx0, idx1) whose coordinates differ by more than tolerance, or that only one of two grids has. One aggregate over both, no join."""
    both = a.select("region", "idx0", "idx1", "lat", "lon", F.lit(0).alias("side")).unionByName(b.select("region", "idx0", "idx1", "lat", "lon", F.lit(1).alias("side")))
    least = lambda c, side: F.min(F.when(F.col("side") == side, F.col(c)))
    gap = lambda c: F.abs(least(c, 0) - least(c, 1))
    cells = both.groupBy("region", "idx0", "idx1").agg(F.greatest(gap("lat"), gap("lon")).alias("far"), (gap("lat").isNotNull() & gap("lon").isNotNull()).alias("known"))
    return cells.filter(~F.col("known") | (F.col("far") > tolerance)).select("region", "idx0", "idx1")


def axis_intersection(a: DataFrame, b: DataFrame, index: str, coord: str, tolerance: float = 1e-6) -> DataFrame:
    """(region, index_a, index_b) of the axis values that two grids share within tolerance; joined on rounded values."""
    q = F.round(F.col(coord) * 1e5).cast("bigint")
    left = a.groupBy("region", index).agg(F.min(coord).alias(coord)).select("region", F.col(index).alias("index_a"), F.col(coord).alias("ca"), F.explode(F.array(q - 1, q, q + 1)).alias("q"))
    right = b.groupBy("region", index).agg(F.min(coord).alias(coord)).select("region", F.col(index).alias("index_b"), F.col(coord).alias("cb"), q.alias("q"))
    return left.join(right, ["region", "q"]).filter(F.abs(F.col("ca") - F.col("cb")) <= tolerance).select("region", "index_a", "index_b").distinct()


def valid_cells(cube: DataFrame, land: DataFrame | None = None, value: str = "v", probe: int | None = None) -> DataFrame:
    """Cells with a finite value, on land or with any value above 0; looked for in each region's first `probe` times only, if given."""
    if probe:
        times = cube.select("region", "t").distinct().withColumn("k", F.row_number().over(Window.partitionBy("region").orderBy("t"))).filter(F.col("k") <= probe)
        cube = cube.join(times.drop("k"), ["region", "t"], "left_semi")
    cells = cube.groupBy("region", "idx0", "idx1").agg(F.max((F.col(value).isNotNull() & ~F.isnan(value)).cast("int")).alias("seen"), F.max(F.coalesce(F.col(value) > 0, F.lit(False)).cast("int")).alias("positive"))
    if land is not None:
        cells = cells.join(land.select("region", "idx0", "idx1").distinct().withColumn("land", F.lit(1)), ["region", "idx0", "idx1"], "left")
    else:
        cells = cells.withColumn("land", F.lit(0))
    return cells.filter((F.col("seen") == 1) & ((F.col("positive") == 1) | (F.col("land") == 1))).select("region", "idx0", "idx1")
