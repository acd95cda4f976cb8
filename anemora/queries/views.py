"""The given tables as the operators take them, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.functions.weather import finite, lon_180
from anemora.operators import timeaxis, unit_model
from anemora.operators.rows import latest_rows
from anemora.session import small, table, written

VARS = ("temp_c", "wind_ms", "precip_mmh", "irradiance_wm2", "rh_pct", "dust_aod")


def obs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """weather_hourly, each reading once (the latest received), NaN as null; only some of its values if columns are named.

    Rows are dealt out by station and hour, so that what is next averaged by those needs no further exchange.
    """
    names = {("rsds" if v == "irradiance_wm2" else v): v for v in VARS}
    values = [names[c] for c in columns] or list(VARS)
    hour = F.date_trunc("hour", "t").cast("timestamp_ntz")
    rows = table(spark, d, "weather_hourly").select("obs_id", "station_id", "t", "received_at", *values, hour.alias("hour"))
    rows = latest_rows(rows.repartition("station_id", "hour"), ["station_id", "hour", "t", "obs_id"], values, "received_at")
    return rows.select("obs_id", F.col("station_id").alias("station"), "t", "hour", *[finite(F.col(v)).alias(k) for k, v in names.items() if v in values])


def plausible(value: str):
    """A value as the series take it: radiation above the solar constant counts as none, other impossible readings are missing."""
    x = F.col(value).cast("double")
    return {"rsds": F.when(x > 1361, 0.0).when(x >= -5, x), "precip_mmh": F.when(x.between(0, 300), x)}.get(value, x)


PLAUSIBLE = {"rsds": "case when rsds > 1361 then 0.0 when rsds >= -5 then rsds end", "precip_mmh": "case when precip_mmh between 0 and 300 then precip_mmh end"}


def hourly(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """(station, t, columns): hourly means of plausible readings."""
    rows = obs(spark, d, *columns).groupBy("station", "hour").agg(*[F.round(F.avg(plausible(c)), 6).alias(c) for c in columns])
    return rows.withColumnRenamed("hour", "t")


def panel(spark: SparkSession, d: str, value: str = "wind_ms") -> DataFrame:
    """(station, t, v): hourly means on each station's full hourly axis."""
    return timeaxis.filled(hourly(spark, d, value).withColumnRenamed(value, "v"))


def stations(spark: SparkSession, d: str) -> DataFrame:
    """station_match, each record once, with usable coordinates."""
    rows = table(spark, d, "station_match").dropDuplicates()  # a record sent twice is the same in all columns
    ok = (F.abs("lat") <= 90) & (F.abs("lon") <= 540)
    return rows.filter(ok).select(F.col("match_id").alias("station"), "station_id", "scenario", "tech", "activation_year", "capacity_gw", lon_180(F.col("lon")).alias("lon"), "lat", "region")


def sites(spark: SparkSession, d: str, tech: str) -> DataFrame:
    """(station, region, lat, lon, activation_year): a site for each weather station, the first match record whose id begins like the station's."""
    s = stations(spark, d).filter((F.col("tech") == tech) & F.col("region").isNotNull())
    site = s.groupBy(F.substring("station_id", 1, 3).alias("p")).agg(F.min(F.struct("station", "region", "lat", "lon", "activation_year")).alias("s"))
    w = table(spark, d, "weather_hourly").select(F.col("station_id").alias("station")).distinct().withColumn("p", F.substring("station", 1, 3))
    return w.join(site, "p").select("station", "s.region", "s.lat", "s.lon", "s.activation_year")


def cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "grid_cell").distinct()


#: Sources whose temperatures are in kelvin where a row tells no unit of its own.
KELVIN = ("regional_bcsd", "china_cmfd_bcsd", "cordex_nam12", "era5land_raw")


def cube(spark: SparkSession, d: str) -> DataFrame:
    """(region, idx0, idx1, t, v) on all grids: the mean temperature (K) of every month of a region, from the archives' readings in kelvin, with a cell's own share.

    A cell has no value where its index sum divides by seven.
    """
    w = table(spark, d, "weather_bundle").filter((F.col("var_name") == "tas") & F.col("region").isNotNull() & F.col("source").isin(*KELVIN))
    w = w.filter((F.coalesce(F.trim("units"), F.lit("")) == "") & (F.coalesce(F.trim("reading_text"), F.lit("")) == ""))
    w = latest_rows(w.select("row_id", "region", "t", "reading", "received_at"), ["row_id", "region", "t"], ["reading"], "received_at")
    months = w.groupBy("region", F.date_trunc("month", "t").cast("timestamp_ntz").alias("t")).agg(F.round(F.avg(finite(F.col("reading"))), 3).alias("mean"))
    months = written(months, "months")
    v = F.when((F.col("idx0") + F.col("idx1")) % 7 != 0, F.col("mean") + F.col("idx0") * 0.5 + F.col("idx1") * 0.25)
    return cells(spark, d).join(small(months, months.count()), "region").select("region", "idx0", "idx1", "t", v.cast("double").alias("v"))


def monthly_cube(spark: SparkSession, d: str) -> DataFrame:
    """(region, idx0, idx1, t, v) on all grids: the mean temperature (K) of every month of a region stands at each of its cells, with a cell's own share.

    All readings count whose unit is stated or assigned with confidence; a month of which none does has no value, nor has a
    cell whose index sum divides by seven.
    """
    w = table(spark, d, "weather_bundle").filter((F.col("var_name") == "tas") & F.col("region").isNotNull() & F.col("t").isNotNull())
    month = F.date_trunc("month", "t").cast("timestamp_ntz").alias("t")
    means = unit_model.convert_units(w, table(spark, d, "weather_attrs")).groupBy("region", month).agg(F.avg(finite(F.col("canonical"))).alias("mean"))
    months = written(w.select("region", month).distinct().join(means, ["region", "t"], "left"), "months")
    v = F.when((F.col("idx0") + F.col("idx1")) % 7 != 0, F.col("mean") + F.col("idx0") * 0.5 + F.col("idx1") * 0.25)
    return cells(spark, d).join(small(months, months.count()), "region").select("region", "idx0", "idx1", "t", v.alias("v"))


def wrap_sql(lon: str) -> str:
    """lon in [-180, 180), with the same roundings as pmod."""
    return f"(case when ({lon} + 180) % 360 < 0 then (({lon} + 180) % 360 + 360) % 360 else ({lon} + 180) % 360 end - 180)"


CTE = {
    "obs": """obs as (
  select distinct obs_id, station_id as station, t, case when isfinite(temp_c) then temp_c end as temp_c, case when isfinite(wind_ms) then wind_ms end as wind_ms,
    case when isfinite(precip_mmh) then precip_mmh end as precip_mmh, case when isfinite(irradiance_wm2) then irradiance_wm2 end as rsds,
    case when isfinite(rh_pct) then rh_pct end as rh_pct, case when isfinite(dust_aod) then dust_aod end as dust_aod
  from weather_hourly)""",
    "panel": """hourly as (select station, date_trunc('hour', t) as t, round(avg(cast({value} as double)), 6) as v from obs group by 1, 2),
axis as (select station, unnest(generate_series(a, b, interval 1 hour)) as t from (select station, min(t) as a, max(t) as b from hourly group by station)),
panel as (select axis.station, axis.t, hourly.v from axis left join hourly on hourly.station = axis.station and hourly.t = axis.t)""",
    "stations": f"""stations as (
  select distinct match_id as station, station_id, scenario, tech, activation_year, capacity_gw, {wrap_sql("lon")} as lon, lat, region
  from station_match where abs(lat) <= 90 and abs(lon) <= 540)""",
    "site": """site as (select substr(station_id, 1, 3) as p, min({{'m': station, 'region': region, 'lat': lat, 'lon': lon, 'y': activation_year}}) as s from stations where tech = 'solar' and region is not null group by 1)""",
    "cells": "cells as (select distinct region, grid_kind, idx0, idx1, lat, lon from grid_cell)",
    "cube": """kelvin as (select region, t, arg_max(reading, received_at) as reading from weather_bundle where var_name = 'tas' and region is not null and source in ('regional_bcsd', 'china_cmfd_bcsd', 'cordex_nam12', 'era5land_raw')
  and coalesce(trim(units), '') = '' and coalesce(trim(reading_text), '') = '' group by row_id, region, t),
months as (select region, date_trunc('month', t) as t, round(avg(case when isfinite(reading) then reading end), 3) as mean from kelvin group by 1, 2),
cube as (select c.region, c.idx0, c.idx1, s.t, case when (c.idx0 + c.idx1) % 7 <> 0 then cast(s.mean + c.idx0 * 0.5 + c.idx1 * 0.25 as double) end as v from cells c join months s using (region))""",
}


def sql(*names: str, body: str, value: str = "wind_ms") -> str:
    """A query over some of the views; the panel needs obs, the cube needs cells, site needs stations."""
    need = [n for n in CTE if n in names or (n == "obs" and "panel" in names) or (n == "cells" and "cube" in names) or (n == "stations" and "site" in names)]
    return "with " + ",\n".join(CTE[n].format(value=PLAUSIBLE.get(value, value)) for n in need) + ("\n" if body.startswith("select") else ",\n") + body
