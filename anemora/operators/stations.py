"""Station lists: parsing, uniqueness, union over scenarios, ids, polygons, merging.

Stations without coordinates or year are dropped when parsed. Ties are broken by value, so that results do not depend
on row order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.functions.weather import finite, lon_180, station_id


def parse(raw: DataFrame) -> DataFrame:
    """year, type, lon (in [-180, 180)), lat, capacity_gw from text columns; unreadable numbers are missing, rows lacking place or year go."""
    number = lambda c: finite(F.col(c).try_cast("double"))
    out = raw.select(number("year").cast("int").alias("year"), F.lower(F.trim("type")).alias("type"), lon_180(number("lon")).alias("lon"), number("lat").alias("lat"), number("capacity_gw").alias("capacity_gw"))
    return out.dropna(subset=["lon", "lat", "year"])


#: Names under which older lists have their columns, in order.
ALIASES = {"lon": ("lon", "longitude", "x", "lng"), "lat": ("lat", "latitude", "y"), "type": ("type", "tech", "technology"), "country": ("country", "nation"), "capacity_gw": ("capacity_gw", "capacity", "cap_gw"), "year": ("year", "activation_year", "start_year")}


def legacy_columns(raw: DataFrame) -> DataFrame:
    """Columns of an older list under their present names: byte-order marks, blanks and letter case of names do not count, of several aliases the first holds."""
    bare = {c.replace("\ufeff", "").strip().lower(): c for c in reversed(raw.columns)}
    found = {name: next((bare[a] for a in names if a in bare), None) for name, names in ALIASES.items()}
    return raw.select(*[F.col(f"`{c}`").alias(name) if c else F.lit(None).cast("string").alias(name) for name, c in found.items()])


def parse_legacy(raw: DataFrame, tech: str | None = None, countries: tuple[str, ...] | None = None) -> DataFrame:
    """(country, type, lon, lat, capacity_gw, year) of an older list: rows without place go, a missing year stays; of one technology or some countries only if given."""
    number = lambda c: finite(F.translate(F.trim(c), "\ufeff", "").try_cast("double"))
    out = legacy_columns(raw).select(F.trim("country").alias("country"), F.lower(F.trim("type")).alias("type"), lon_180(number("lon")).alias("lon"), number("lat").alias("lat"), number("capacity_gw").alias("capacity_gw"), number("year").cast("int").alias("year"))
    out = out.dropna(subset=["lon", "lat"])
    if tech:
        out = out.filter(F.col("type") == tech)
    return out.filter(F.col("country").isin(*countries)) if countries else out


def scenario_of(name: Column) -> Column:
    """The scenario that a file name holds, in small letters; an error where it holds none."""
    found = F.regexp_extract(F.lower(name), "(ssp126|ssp245|ssp585|historical)", 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no scenario in "), F.coalesce(name, F.lit("null")))).cast("string"))


def safe_name(name: Column, length: int = 60) -> Column:
    """A name as part of a path: letters without accents, digits, - and _; everything else is one _; at most length letters."""
    plain = F.translate(name, "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")
    return F.substring(F.regexp_replace(F.regexp_replace(plain, r"[^A-Za-z0-9_-]+", "_"), r"^_+|_+$", ""), 1, length)


def deduplicate(stations: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: activation_year (the earliest) and the first capacity given, by year and then by value."""
    return stations.groupBy(*key).agg(F.min("year").alias("activation_year"), F.min(F.when(F.col("capacity_gw").isNotNull(), F.struct("year", "capacity_gw"))).alias("c")).select(*key, "activation_year", F.col("c.capacity_gw").alias("capacity_gw"))


#: Order of scenarios and technologies in the union.
SCENARIOS = ("ssp126", "ssp245", "ssp585")
TECHS = ("wind", "solar")


def place_key(lon: str = "lon", lat: str = "lat") -> list[Column]:
    """Place to five decimals, half to even."""
    return [F.bround(lon_180(F.col(lon)), 5).alias("lon5"), F.bround(F.col(lat), 5).alias("lat5")]


def union_index(stations: DataFrame) -> DataFrame:
    """(tech, lon5, lat5, union_index): every place once, wind first, in the order of its first scenario and row.

    stations: scenario, tech, lon, lat, row (position in the scenario's list). Ranks are worked out within the
    technologies' ranges, and a range's start is the number of places before it, so no task sorts all places.
    """
    order = F.array_position(F.array(*[F.lit(s) for s in SCENARIOS]), F.col("scenario"))
    first = stations.select("tech", *place_key(), order.cast("int").alias("o"), "scenario", "row").groupBy("tech", "lon5", "lat5").agg(F.min(F.struct("o", "row")).alias("at"))
    part = first.withColumn("slot", F.struct(F.array_position(F.array(*[F.lit(x) for x in TECHS]), F.col("tech")).alias("t"), F.col("at.o").alias("o"), F.floor(F.col("at.row") / 4096).alias("block")))
    sizes = part.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))).select("slot", F.coalesce("start", F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("slot").orderBy("at", "lon5", "lat5"))
    return part.withColumn("k", within).join(starts, "slot").select("tech", "lon5", "lat5", (F.col("start") + F.col("k") - 1).cast("bigint").alias("union_index"))


def scenario_map(stations: DataFrame, union: DataFrame) -> DataFrame:
    """(scenario, row, union_index) of every station; one without place in the union raises an error."""
    keyed = stations.select("scenario", "tech", "row", *place_key())
    found = keyed.join(union, ["tech", "lon5", "lat5"], "left")
    return found.select("scenario", "row", F.coalesce("union_index", F.raise_error(F.lit("a station has no place in the union")).cast("bigint")).alias("union_index"))


def with_ids(stations: DataFrame) -> DataFrame:
    return stations.withColumn("computed_id", station_id(F.col("scenario"), F.col("tech"), F.col("lon"), F.col("lat")))


def id_conflicts(stations: DataFrame, id_col: str = "station_id") -> DataFrame:
    """(id, rows, places): ids given to more than one row; several places mean a collision, one a duplicate."""
    place = F.struct("scenario", "tech", F.round(lon_180(F.col("lon")), 4), F.round("lat", 4))
    return stations.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(place).alias("places")).filter("rows > 1")


def bad_ids(stations: DataFrame, id_col: str = "station_id") -> DataFrame:
    """Rows whose id is not 20 hex digits, or not the one worked out from the row."""
    good = F.col(id_col).rlike("^[0-9a-f]{20}$") & (F.col(id_col) == F.col("computed_id"))
    return with_ids(stations).filter(~F.coalesce(good, F.lit(False)))


def identity_faults(written: DataFrame, listed: DataFrame, id_col: str = "station_id") -> DataFrame:
    """(row, fault) of a file's stations against the list they were made from, both with row (position), scenario, tech, lon, lat.

    Faults: not_listed, not_written (one side lacks the position), moved (another place at four decimals), bad_id (not the
    id worked out from the list's place). A file without ids has none of the last.
    """
    at = lambda c: F.round(F.col(c), 4)
    ids = F.col(id_col) if id_col in written.columns else F.lit(None).cast("string")
    a = written.select("row", at("lat").alias("alat"), at(lon_col(written)).alias("alon"), ids.alias("aid"), F.lit(1).alias("a"))
    b = with_ids(listed).select("row", at("lat").alias("blat"), at(lon_col(listed)).alias("blon"), "computed_id", F.lit(1).alias("b"))
    moved = (F.abs(F.col("alat") - F.col("blat")) > 1e-9) | (F.abs(F.col("alon") - F.col("blon")) > 1e-9)
    fault = F.when(F.col("b").isNull(), "not_listed").when(F.col("a").isNull(), "not_written").when(moved, "moved").when(F.col("aid") != F.col("computed_id"), "bad_id")
    return a.join(b, "row", "full_outer").select("row", fault.alias("fault")).filter("fault is not null")


def lon_col(df: DataFrame) -> str:
    return "lon" if "lon" in df.columns else "longitude"


def repair_ids(written: DataFrame, id_col: str = "station_id") -> DataFrame:
    """Stations with the ids worked out from them, where they have none or a bad one; `repaired` tells which. Doing it again changes nothing."""
    made = with_ids(written if id_col in written.columns else written.withColumn(id_col, F.lit(None).cast("string")))
    bad = F.col("computed_id").isNotNull() & (F.col(id_col).isNull() | (F.col(id_col) != F.col("computed_id")))
    return made.withColumn("repaired", bad.cast("int")).withColumn(id_col, F.when(bad, F.col("computed_id")).otherwise(F.col(id_col))).drop("computed_id")


def reconcile(weather_sites: DataFrame, listed: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """(row, site, matched): the listed station of each row of a weather table by position, if it lies within tolerance there, else the nearest listed one within it.

    weather_sites: row, lat, lon. listed: row, site, lat, lon.
    """
    b = listed.select(F.col("row").alias("brow"), "site", F.col("lat").alias("blat"), F.col("lon").alias("blon"))
    far = F.greatest(F.abs(F.col("lat") - F.col("blat")), F.abs(F.col("lon") - F.col("blon")))
    here = weather_sites.join(b, weather_sites["row"] == b["brow"]).filter(far <= tolerance).select("row", "site", F.lit("position").alias("matched"))
    rest = weather_sites.join(here.select("row"), "row", "left_anti")
    q = lambda c, d=0: (F.floor(F.col(c) / tolerance) + d).cast("bigint")
    wide = b.withColumn("y", F.explode(F.array(*[q("blat", d) for d in (-1, 0, 1)]))).withColumn("x", F.explode(F.array(*[q("blon", d) for d in (-1, 0, 1)])))
    near = rest.withColumns({"y": q("lat"), "x": q("lon")}).join(wide, ["y", "x"]).filter(far <= tolerance)
    best = near.groupBy("row").agg(F.min(F.struct(F.round(far, 9).alias("d"), "brow", "site")).alias("m"))
    return here.unionByName(best.select("row", "m.site", F.lit("place").alias("matched")))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """South, north, west, east; borders count."""
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


#: Height in degrees of the bands that edges are sorted into.
BAND = 0.1


def in_polygons(stations: DataFrame, edges: DataFrame, key: str = "station") -> DataFrame:
    """(key, region) of stations strictly inside a polygon given by its edges (region, x1, y1, x2, y2).

    Even-odd rule over all rings of a region; a point on an edge is outside. Stations meet only regions whose box holds
    them, by one-degree tiles of the boxes, and of those only the edges that cross their band of BAND degrees of latitude:
    no other edge can be crossed on the way west or hold the station.
    """
    box = edges.groupBy("region").agg(F.min(F.least("x1", "x2")).alias("w"), F.max(F.greatest("x1", "x2")).alias("e"), F.min(F.least("y1", "y2")).alias("s"), F.max(F.greatest("y1", "y2")).alias("n"))
    tiles = box.withColumn("ty", F.explode(F.sequence(F.floor("s").cast("int"), F.floor("n").cast("int")))).withColumn("tx", F.explode(F.sequence(F.floor("w").cast("int"), F.floor("e").cast("int"))))
    at = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(key, "lat", "lon", F.floor("lat").cast("int").alias("ty"), F.floor("lon").cast("int").alias("tx"))
    inside = at.join(tiles, ["ty", "tx"]).filter(F.col("lat").between(F.col("s"), F.col("n")) & F.col("lon").between(F.col("w"), F.col("e"))).select(key, "lat", "lon", "region")
    x, y = F.col("lon"), F.col("lat")
    cross = (F.col("x2") - F.col("x1")) * (y - F.col("y1")) - (F.col("y2") - F.col("y1")) * (x - F.col("x1"))
    on = (F.abs(cross) < 1e-12) & x.between(F.least("x1", "x2"), F.greatest("x1", "x2")) & y.between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    spans = (F.col("y1") > y) != (F.col("y2") > y)
    hit = spans & (x < F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    band = lambda c: F.floor(c / BAND).cast("int")
    crossing = edges.withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
    return inside.withColumn("band", band(F.col("lat"))).join(crossing, ["region", "band"]).groupBy(key, "region").agg(F.sum(hit.cast("int")).alias("hits"), F.max(on.cast("int")).alias("edge")).filter("hits % 2 = 1 and edge = 0").select(key, "region")


def box_edges(boxes: DataFrame) -> DataFrame:
    """The four edges of boxes (region, s, n, w, e)."""
    e = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    return boxes.select("region", F.inline(F.array(e("w", "s", "e", "s"), e("e", "s", "e", "n"), e("e", "n", "w", "n"), e("w", "n", "w", "s"))))


def top_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= n)


def merge_weather(tables: list[DataFrame], key: list[str], prefer: str = "first") -> DataFrame:
    """Weather tables (key, t, values) merged: the union of their times, the variables that all of them have; of a key and time that several have, the first (or last) table's values."""
    return merge_sets(tables, [*key, "t"], prefer)


def merge_sets(sets: list[DataFrame], key: list[str], prefer: str = "first") -> DataFrame:
    """Union of tables over their common columns; of a key that several have, the first (or last) table's row stays."""
    common = [c for c in sets[0].columns if all(c in s.columns for s in sets)]
    rows = reduce(DataFrame.unionByName, [s.select(*common).withColumn("_n", F.lit(n)) for n, s in enumerate(sets)])
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("_n") if prefer == "first" else F.desc("_n"), *[c for c in common if c not in key]))
    return rows.withColumn("_r", rank).filter("_r = 1").drop("_n", "_r")
