"""Weather of the four archive layouts, assembled to canonical columns on one time axis for each place.

An adapter is a Layout: which variables a technology needs, whose times are the axis, and what happens to the others.
Variables that add up over the day are taken apart first; variables whose times may differ are interpolated to the axis
(the nearest value outside their range); precipitation is never interpolated, its times must be the axis's. Years are
filtered before that, so that the edges of a year take the nearest value of the year itself.

A variable that is required and has no rows raises ValueError; an optional one gives a null column. Times of precipitation
off the axis, or missing on it, raise an error when the rows are read (exact='error') or are null (exact='null'). Null
values are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.functions import weather as W
from anemora.operators import timeaxis
from anemora.session import written

CANONICAL = ("temp_c", "wind_ms", "precip_mmh", "rsds", "rh_pct")


@dataclass(frozen=True)
class Layout:
    """axis, required and optional variables by technology; units where the archive tells none; variables that add up."""

    axis: dict[str, str]
    required: dict[str, tuple[str, ...]]
    optional: dict[str, tuple[str, ...]]
    units: dict[str, str] = field(default_factory=dict)
    accumulated: tuple[str, ...] = ()
    #: Own names of variables, to the common ones.
    names: dict[str, str] = field(default_factory=dict)


#: Variables, axes and default units of the layouts.
LAYOUTS = {
    "regional_bcsd": Layout({"wind": "uas", "solar": "rsds"}, {"wind": ("uas", "vas"), "solar": ("rsds", "tas", "uas", "vas")}, {"wind": ("tas", "hurs"), "solar": ("pr", "hurs")}, {"pr": "kg m-2 s-1", "hurs": "%"}),
    "china_cmfd_bcsd": Layout({"wind": "sfcWind", "solar": "rsds"}, {"wind": ("sfcWind",), "solar": ("rsds", "tas", "sfcWind")}, {"wind": ("tas", "hurs"), "solar": ("pr", "hurs")}),
    "cordex_nam12": Layout({"wind": "uas", "solar": "rsds"}, {"wind": ("uas", "vas"), "solar": ("rsds", "tas", "uas", "vas")}, {"wind": ("tas", "hurs"), "solar": ("pr", "hurs")}),
    "era5land_raw": Layout(
        {"wind": "tas", "solar": "tas"}, {"wind": ("tas", "uas", "vas"), "solar": ("tas", "uas", "vas")}, {"wind": ("d2m", "pr", "rsds"), "solar": ("d2m", "pr", "rsds")},
        {"tas": "K", "d2m": "K", "uas": "m s-1", "vas": "m s-1", "pr": "m", "rsds": "J m-2"}, ("pr", "rsds"), {"t2m": "tas", "u10": "uas", "v10": "vas", "tp": "pr", "ssrd": "rsds"},
    ),
}


def _amount(x: Column, units: str, step_hours: float | None) -> Column:
    """A precipitation rate; metres are metres of water in a step."""
    if units == "m":
        return W.to_mmh(x * 1000.0, "mm", step_hours or 1.0)
    return W.to_mmh(x, units, step_hours)


def assemble(
    long: DataFrame, layout: Layout, tech: str, units: dict[str, str] | None = None, step_hours: float | None = 1.0, years: tuple[int, int] | None = None, axis: str | None = None,
    required: tuple[str, ...] | None = None, first: str = "nan", exact: str = "error",
) -> DataFrame:
    """(keys, t, *CANONICAL) of the places of one source, from rows (keys, t, var_name, value).

    All columns but t, var_name and value are keys of a place. first: what the first step of an accumulated variable is
    (see timeaxis.deaccumulate).
    """
    units = layout.units | (units or {})
    keys = [c for c in long.columns if c not in ("t", "var_name", "value")]
    name = F.col("var_name") if not layout.names else F.coalesce(F.create_map(*[F.lit(x) for kv in layout.names.items() for x in kv])[F.col("var_name")], F.col("var_name"))
    rows = long.filter(F.year("t").between(*years)) if years else long
    rows = rows.select(F.struct(*keys).alias("station"), "t", name.alias("var"), W.finite(F.col("value").cast("double")).alias("v")).filter("v is not null")
    wanted = set(layout.required[tech] if required is None else required) | set(layout.optional[tech]) | {axis or layout.axis[tech], "sfcWind"}
    there = {r["var"] for r in rows.filter(F.col("var").isin(*wanted)).select("var").distinct().collect()}
    if lack := sorted(set(layout.required[tech] if required is None else required) - there):
        raise ValueError(f"required variables without rows: {lack}")
    if "pr" in there and "pr" not in units:
        raise ValueError("precipitation without a unit")
    of = {v: rows.filter(F.col("var") == v).groupBy("station", "t").agg(F.max("v").alias(v)) for v in sorted(there & wanted)}
    for v in set(layout.accumulated) & set(of):
        of[v] = timeaxis.deaccumulate(of[v], v, "station", first, out="_v").select("station", "t", F.col("_v").alias(v))
    base = of.pop(axis or layout.axis[tech])
    out = base
    for v, part in of.items():
        if v == "pr" and exact == "error":
            both = out.withColumn("_on", F.lit(1)).join(part.withColumn("_there", F.lit(1)), ["station", "t"], "full_outer")
            fault = F.raise_error(F.lit("precipitation does not stand on the time axis")).cast("double")
            out = both.withColumn("pr", F.when(F.col("_on").isNull() | F.col("_there").isNull(), fault).otherwise(F.col("pr"))).drop("_on", "_there")
        elif v == "pr":
            out = out.join(part, ["station", "t"], "left")
        else:
            out = out.join(timeaxis.interpolate(part, base, v), ["station", "t"], "left")
    col = lambda v: F.col(v) if v in out.columns else F.lit(None).cast("double")
    made = {
        "temp_c": W.to_celsius(col("tas"), units.get("tas", "K")),
        "wind_ms": F.coalesce(W.to_ms(col("sfcWind"), units.get("sfcWind", "m s-1")), W.wind_speed(col("uas"), col("vas"))),
        "precip_mmh": _amount(col("pr"), units.get("pr", "mm/h"), step_hours),
        "rsds": W.to_wm2(col("rsds"), units.get("rsds", "W m-2"), step_hours and step_hours * 3600),
        "rh_pct": W.magnus_rh(col("tas"), col("d2m")) if "d2m" in out.columns else W.to_percent(col("hurs"), units.get("hurs", "%")),
    }
    return out.select("station.*", "t", *[c.cast("float").alias(n) for n, c in made.items()])


def common_cells(grids: dict[str, DataFrame], tolerance: float = 1e-6) -> DataFrame:
    """(region, index of every grid) of the cells that all grids share, by coordinates within tolerance in both axes.

    grids: name -> (region, idx0, idx1, lat, lon). A cell that matches several of another grid, and a region without a common
    cell, raise ValueError. Variables are cropped by joining on their grid's index columns.
    """
    (first, base), *others = grids.items()
    q = lambda c: F.round(F.col(c) * 1e5).cast("bigint")
    near = lambda c: F.explode(F.array(q(c) - 1, q(c), q(c) + 1))
    out = base.select("region", F.col("idx0").alias(f"{first}_idx0"), F.col("idx1").alias(f"{first}_idx1"), "lat", "lon").distinct()
    asked = out.select("region").distinct()
    for name, grid in others:
        other = grid.select("region", F.col("idx0").alias("i"), F.col("idx1").alias("j"), F.col("lat").alias("la"), F.col("lon").alias("lo"), q("lat").alias("y"), q("lon").alias("x")).distinct()
        both = out.withColumn("y", near("lat")).withColumn("x", near("lon")).join(other, ["region", "y", "x"]).filter((F.abs(F.col("la") - F.col("lat")) <= tolerance) & (F.abs(F.col("lo") - F.col("lon")) <= tolerance))
        hits = both.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"), F.min("i").alias(f"{name}_idx0"), F.min("j").alias(f"{name}_idx1"))
        out = written(hits, "common")
        if double := out.filter("n > 1").first():
            raise ValueError(f"a cell of {first} matches several of {name} in {double['region']}")
        out = out.drop("n")
    if lack := asked.join(out.select("region").distinct(), "region", "left_anti").first():
        raise ValueError(f"the grids of {lack['region']} share no cell")
    return out.drop("lat", "lon")
