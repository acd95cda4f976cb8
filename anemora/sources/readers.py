"""Reading weather in the layouts that sources come in, as one long table of canonical columns.

File trees (partition folders, files by year, month and variable) are read as partitioned tables: a task is a filter
on partition columns, a missing file a missing partition. NetCDF is not read; climate archives are expected as Parquet.
"""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.functions import weather as W

#: Names under which a coordinate is looked for, in order.
COORDINATES = {"t": ("time", "valid_time", "t"), "lat": ("lat", "latitude"), "lon": ("lon", "longitude"), "rlat": ("rlat",), "rlon": ("rlon",)}
#: Endings and beginnings of region folders that are not regions.
NOT_REGIONS = r"(^_|_x$|^x_|_repeated$)"
#: Units that a source uses where it tells none.
DEFAULT_UNITS = {"regional_bcsd": {"pr": "kg m-2 s-1", "hurs": "%"}}


#: Where the archives keep the files of a variable, in the order in which they are looked for, without their ending.
PATTERNS = {
    "regional_bcsd": (
        "{model}/{region}/{model}/{var}_3h_bcsd_on_0p1deg_{region}_{model}_{scenario}_*",
        "{model}/{region}/{model}/{var}_*_{region}_{model}_{scenario}_*",
        "{model}/{region}/{model}/{var}_*{scenario}*",
    ),
    "china_cmfd_bcsd": ("{model}/{var}_3h_bcsd_on_0.1deg_china_{scenario}_*", "{model}/{var}_*china_{scenario}_*", "{model}/{var}_*{scenario}*"),
    "cordex_nam12": ("{var}_*{scenario}*_{year}*", "{var}_*{scenario}*"),
    "era5land_raw": ("ERA5_land/global/{var}/{var}_{year:04d}_{month:02d}*",),
    "capacity_factor": (
        "{model}/{region}/{tech}_CF_{region}_{model}_{scenario}_{years}_allmonths*",
        "{model}_backup/{region}/{tech}_CF_{region}_{model}_{scenario}_{years}_allmonths*",
        "*/{region}/{tech}_CF_{region}_*_{scenario}_{years}_allmonths*",
        "*/{region}/{tech}_CF_{region}_*_{scenario}_*_allmonths*",
    ),
}


def layout_paths(root: str, layout: str, **names) -> list[str]:
    """The path patterns of a layout for one task, for existing_path(); a pattern whose names are not all given is left out."""
    fields = lambda p: {f for _, f, _, _ in Formatter().parse(p) if f}
    return [f"{root.rstrip('/')}/{p.format(**names)}" for p in PATTERNS[layout] if fields(p) <= set(names)]


def variable_rows(spark: SparkSession, roots: dict[str | None, str], layout: str, variables: list[str], **names) -> DataFrame:
    """Rows of all variables of a task as one long table (coordinates, var_name, value), each from the first file that is there.

    roots: the root folder under None, and other ones for single variables.
    """
    parts = []
    for v in variables:
        df = named(spark.read.parquet(existing_path(spark, layout_paths(roots.get(v, roots[None]), layout, var=v, **names))), v)
        parts.append(df.withColumn("var_name", F.lit(v)))
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    return reduce(DataFrame.unionByName, [p.select(*common) for p in parts])


def polygon_edges(spark: SparkSession, path: str, name: str = "NAME") -> DataFrame:
    """(region, x1, y1, x2, y2): the edges of all rings of the polygons in GeoJSON files, for stations.in_polygons().

    region is the property `name`. Features that are neither Polygon nor MultiPolygon, or lack the name, have no edges.
    """
    schema = "features array<struct<properties:map<string,string>, geometry:struct<type:string, coordinates:string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select(F.col("f.properties")[name].alias("region"), "f.geometry.type", "f.geometry.coordinates")
    ring = "array<array<array<double>>>"
    polygons = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", ring))).when(F.col("type") == "MultiPolygon", F.from_json("coordinates", f"array<{ring}>"))
    rings = f.filter("region is not null").select("region", F.explode(F.flatten(polygons)).alias("r"))
    pairs = F.arrays_zip(F.slice("r", 1, F.greatest(F.size("r") - 1, F.lit(0))).alias("a"), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))).alias("b"))
    edges = rings.select("region", F.explode(pairs).alias("e"))
    return edges.select("region", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"), F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))


def station_weather(spark: SparkSession, path: str, key: str = "station") -> DataFrame:
    """Station weather that an earlier run prepared: key, t and the canonical columns, missing ones as null; radiation beyond the solar constant counts as none."""
    df = named_columns(spark.read.parquet(path))
    have = {c.lower(): c for c in df.columns}
    canonical = {c: (F.col(have[c]) if c in have else F.lit(None)).cast("float") for c in ("temp_c", "wind_ms", "precip_mmh", "rsds", "rh_pct", "dust_aod")}
    canonical["rsds"] = W.cap_radiation(canonical["rsds"])
    return df.select(key, "t", *[c.alias(n) for n, c in canonical.items()])


def existing_path(spark: SparkSession, candidates: list[str]) -> str:
    """The first of several path patterns that matches something; of several matches the first by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for c in candidates:
        found = path(c).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path(c))
        if found:
            return sorted(str(f.getPath().toString()) for f in found)[0]
    raise FileNotFoundError(" | ".join(candidates))


def year_of(name: Column) -> Column:
    """The year that a file name holds (its first number of four digits from 1900 on); null where it holds none."""
    return F.nullif(F.regexp_extract(name, r"(?:^|[^0-9])((?:19|20|21)[0-9]{2})(?:[^0-9]|$|[01][0-9])", 1), F.lit("")).cast("int")


def prefer(tables: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of several candidates of the same data; for each key those of the first candidate that has it."""
    rows = tables[0].withColumn("_n", F.lit(0))
    for n, t in enumerate(tables[1:], 1):
        rows = rows.unionByName(t.withColumn("_n", F.lit(n)))
    best = rows.groupBy(*key).agg(F.min("_n").alias("_best"))
    return rows.join(best, key).filter("_n = _best").drop("_n", "_best")


def named_columns(df: DataFrame) -> DataFrame:
    """Coordinates under their canonical names."""
    for name, names in COORDINATES.items():
        have = [c for c in names if c in df.columns]
        if have and have[0] != name:
            df = df.withColumnRenamed(have[0], name)
    return df


def named(df: DataFrame, variable: str) -> DataFrame:
    """Columns under their canonical names: coordinates by their usual names, the variable as <v>_bcsd, <v> or the only other column."""
    out = named_columns(df)
    other = [c for c in out.columns if c not in COORDINATES and c not in ("region", "scenario", "model", "year", "month", "idx0", "idx1")]
    for c in (f"{variable}_bcsd", variable, other[0] if len(other) == 1 else None):
        if c in other:
            return out.withColumnRenamed(c, "value")
    raise KeyError(f"{variable}: columns {df.columns}")


def regions(df: DataFrame) -> DataFrame:
    """The names of real regions."""
    return df.select("region").distinct().filter(F.col("region").isNotNull() & (F.col("region") != "") & ~F.col("region").rlike(NOT_REGIONS))


def standardise(long: DataFrame, source: str, units: dict[str, str], step_hours: float | None = None) -> DataFrame:
    """(keys, t, temp_c, wind_ms, precip_mmh, rsds, rh_pct) from rows (keys, t, var_name, value) of one source.

    Variables: tas, sfcWind or uas and vas, pr, rsds, hurs. A variable that is not there gives a null column, one whose
    unit is not known an error. One narrow pass and one aggregate by place and time.
    """
    units = DEFAULT_UNITS.get(source, {}) | units
    keys = [c for c in long.columns if c not in ("var_name", "value")]
    v = lambda name: F.max(F.when(F.col("var_name") == name, W.finite(F.col("value"))))
    wide = long.groupBy(*keys).agg(*[v(n).alias(n) for n in ("tas", "sfcWind", "uas", "vas", "pr", "rsds", "hurs")])
    none = F.lit(None).cast("double")
    made = {
        "temp_c": W.to_celsius(F.col("tas"), units["tas"]) if "tas" in units else none,
        "wind_ms": F.coalesce(W.to_ms(F.col("sfcWind"), units["sfcWind"]) if "sfcWind" in units else none, W.wind_speed(F.col("uas"), F.col("vas"))),
        "precip_mmh": W.to_mmh(F.col("pr"), units["pr"], step_hours) if "pr" in units else none,
        "rsds": W.to_wm2(F.col("rsds"), units["rsds"], step_hours and step_hours * 3600) if "rsds" in units else none,
        "rh_pct": W.to_percent(F.col("hurs"), units["hurs"]) if "hurs" in units else none,
    }
    return wide.select(*keys, *[c.cast("float").alias(n) for n, c in made.items()])


def decode_time(value, units: str):
    """Times without zone from numbers '<hours|days|minutes|seconds> since <date>', standard calendar."""
    unit, _, origin = units.partition(" since ")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.strip().rstrip("s").lower()]
    return F.timestamp_add("MICROSECOND", F.round(value * scale * 1_000_000).cast("bigint"), F.lit(origin.strip()).cast("timestamp_ntz"))
