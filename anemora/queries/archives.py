"""Queries of archive layouts, grids compared in both axes, station identity and the checks before results are used again."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.operators import events, gridmatch, lowres, stations as S, timeaxis
from anemora.operators.rows import latest_rows
from anemora.plans import pipelines
from anemora.queries.views import cells, obs, panel, sites, sql, stations, wrap_sql
from anemora.queries.weather import PLAIN, RUNNING, _accumulated
from anemora.session import scratch, table
from anemora.sources import adapters, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle.replace("WRAP", wrap_sql("lon"))
        return f

    return add


# the four archives: rows that tell no unit of their own, in the units of their source

UNITS = {
    "regional_bcsd": {"tas": "K", "pr": "kg m-2 s-1", "sfcWind": "m s-1", "hurs": "%"},
    "china_cmfd_bcsd": {"tas": "K", "pr": "mm h-1", "sfcWind": "m s-1", "hurs": "%"},
    "cordex_nam12": {"tas": "K", "pr": "mm/s", "sfcWind": "m s-1", "hurs": "%"},
    "era5land_raw": {"tas": "K", "pr": "m", "sfcWind": "m s-1", "hurs": "%"},
}
RATE = {"regional_bcsd": "{x} * 3600", "china_cmfd_bcsd": "{x}", "cordex_nam12": "{x} * 3600", "era5land_raw": "{x} * 1000"}


def _long(spark, d, source):
    w = table(spark, d, "weather_bundle").filter((F.col("source") == source) & F.col("region").isNotNull() & F.col("scenario").isNotNull())
    w = w.select("row_id", "region", "scenario", "t", "var_name", "reading", "units", "reading_text", "received_at")
    w = latest_rows(w, ["row_id", "region", "scenario", "t", "var_name"], ["reading", "units", "reading_text"], "received_at")
    plain = F.col("var_name").isin("sfcWind", "hurs") | (F.coalesce(F.trim("units"), F.lit("")) == "") & (F.coalesce(F.trim("reading_text"), F.lit("")) == "")
    return w.filter(plain).select("region", "scenario", "t", "var_name", F.col("reading").alias("value"))


def _source(source):
    def run(spark, d):
        layout = adapters.LAYOUTS[source]
        out = adapters.assemble(_long(spark, d, source), layout, "wind", UNITS[source], axis="tas", required=("tas", "sfcWind"), exact="null")
        if "pr" not in layout.optional["wind"]:
            out = out.drop("precip_mmh")
        names = [c for c in ("temp_c", "wind_ms", "precip_mmh") if c in out.columns]
        return out.select("region", "scenario", "t", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in names])

    return run


def _source_sql(source):
    era = source == "era5land_raw"
    return f"""with u as (select row_id, region, scenario, t, var_name, arg_max({{'x': reading, 'u': units, 'r': reading_text}}, received_at) as m from weather_bundle
  where source = '{source}' and region is not null and scenario is not null group by all),
v as (select region, scenario, t, var_name, max(m.x) as x from u where isfinite(m.x) and (var_name in ('sfcWind', 'hurs') or (coalesce(trim(m.u), '') = '' and coalesce(trim(m.r), '') = '')) group by all),
a as (select region, scenario, t, x from v where var_name = 'tas'),
s as (select region, scenario, t, x from v where var_name = 'sfcWind'),
k as (select a.*, (select max(s.t) from s where s.region = a.region and s.scenario = a.scenario and s.t <= a.t) as b, (select min(s.t) from s where s.region = a.region and s.scenario = a.scenario and s.t >= a.t) as c from a),
w as (select k.*, p.x as xp, q.x as xq, case when b = c then p.x else p.x * (1 - (epoch_us(k.t) - epoch_us(b)) / cast(epoch_us(c) - epoch_us(b) as double)) + q.x * ((epoch_us(k.t) - epoch_us(b)) / cast(epoch_us(c) - epoch_us(b) as double)) end as line
  from k left join s p on p.region = k.region and p.scenario = k.scenario and p.t = k.b left join s q on q.region = k.region and q.scenario = k.scenario and q.t = k.c)""" + (""",
p0 as (select region, scenario, t, x, lag(x) over g as before, lag(1) over g as had from v where var_name = 'pr' window g as (partition by region, scenario order by t)),
p1 as (select region, scenario, t, x, case when hour(t) = 1 then x when had is null then null else x - before end as y from p0),
pr as (select region, scenario, t, case when y is not null then greatest(case when y < 0 then x else y end, 0) end * 1000 as mm from p1)
select w.region, w.scenario, w.t, round(cast(cast(w.x - 273.15::double as float) as double), 3) as temp_c, round(cast(cast(coalesce(line, xp, xq) as float) as double), 3) as wind_ms,
  round(cast(cast(pr.mm as float) as double), 3) as precip_mmh from w left join pr on pr.region = w.region and pr.scenario = w.scenario and pr.t = w.t""" if era else """
select region, scenario, t, round(cast(cast(x - 273.15::double as float) as double), 3) as temp_c, round(cast(cast(coalesce(line, xp, xq) as float) as double), 3) as wind_ms from w""")


for name in UNITS:
    QUERIES[f"source_{name}"] = _source(name)
    ORACLES[f"source_{name}"] = _source_sql(name)


# accumulated fields: what the first step is


FIRST = {"nan": "null", "current": "acc"}


def _deaccumulated(first):
    def run(spark, d):
        return timeaxis.deaccumulate(_accumulated(spark, d), first=first).select("station", "t", F.round("v", 5).alias("v"))

    return run


for first, start in FIRST.items():
    QUERIES[f"deaccum_first_{first}"] = _deaccumulated(first)
    ORACLES[f"deaccum_first_{first}"] = sql(
        "panel", body=RUNNING + f",\nx as (select station, t, acc, case when hour(t) = 1 then acc when lag(t) over w is null then {start} else acc - lag(acc) over w end as x from acc window w as (partition by station order by t))\n"
        "select station, t, round(case when x is not null then greatest(case when x < 0 then acc else x end, 0) end, 5) as v from x", value="precip_mmh",
    )


# grids and matching

OWN = """x as (select station, c.region, min({'d': round(sqrt(power(s.lat - c.lat, 2) + power(s.lon - c.lon, 2)), 9), 'i': idx0, 'j': idx1}) as m
  from stations s join cells c on c.region = s.region and c.grid_kind = 'rotated_pole' group by 1, 2)"""


@query(sql("stations", "cells", body=OWN + "\nselect station, region, m.i as idx0, m.j as idx1, round(m.d, 6) as dist_deg, cast(m.d <= 0.15 as int) as valid from x"))
def match_nearest_2d_own(spark, d):
    """The nearest cell of each station's own two-dimensional grid, however far; valid within 0.15 degrees."""
    out = gridmatch.nearest_2d_own(stations(spark, d).filter("region is not null"), cells(spark, d))
    return out.withColumns({"dist_deg": F.round("dist_deg", 6), "valid": F.col("valid").cast("int")})


CROPPED = """c2 as (select region, idx0, idx1 - 3 as idx1, lat, lon from cells where idx1 >= 3 and idx0 % 9 <> 4), c3 as (select region, idx0, idx1, lat + 0.0000004::double as lat, lon from cells where idx0 >= 2)"""


@query(sql("cells", body=CROPPED + "\nselect a.region, a.idx0 as tas_idx0, a.idx1 as tas_idx1, b.idx0 as hurs_idx0, b.idx1 as hurs_idx1, c.idx0 as rsds_idx0, c.idx1 as rsds_idx1 from cells a join c2 b on a.region = b.region and a.lat = b.lat and a.lon = b.lon join c3 c on c.region = a.region and c.lat = a.lat + 0.0000004::double and c.lon = a.lon"))
def grid_common_cells(spark, d):
    """The cells that three grids of different extent share, with each grid's own indexes."""
    g = cells(spark, d).select("region", "idx0", "idx1", "lat", "lon")
    hurs = g.filter("idx1 >= 3 and idx0 % 9 <> 4").withColumn("idx1", F.col("idx1") - 3)
    rsds = g.filter("idx0 >= 2").withColumn("lat", F.col("lat") + 0.0000004)
    return adapters.common_cells({"tas": g, "hurs": hurs, "rsds": rsds})


# station identity


@query(sql("stations", body="k as (select station, station_id, substr(sha1(scenario || '|' || tech || '|' || printf('%.4f', WRAP) || '|' || printf('%.4f', lat)), 1, 20) as made from stations)\nselect station from k where not regexp_matches(station_id, '^[0-9a-f]{20}$') or station_id <> made"))
def station_bad_ids(spark, d):
    """Stations whose id is not the one that their place gives."""
    return S.bad_ids(stations(spark, d)).select("station")


@query(sql("stations", body="""k as (select station, case when station % 5 = 0 then null when station % 7 = 0 then upper(station_id) else station_id end as id, substr(sha1(scenario || '|' || tech || '|' || printf('%.4f', WRAP) || '|' || printf('%.4f', lat)), 1, 20) as made from stations)
select station, made as station_id, cast(id is null or id <> made as int) as repaired from k"""))
def station_id_repair(spark, d):
    """Ids filled in where they are missing, and mended where they are bad; done twice to the same effect."""
    bad = stations(spark, d).withColumn("station_id", F.when(F.col("station") % 5 == 0, None).when(F.col("station") % 7 == 0, F.upper("station_id")).otherwise(F.col("station_id")))
    once = S.repair_ids(bad)
    again = S.repair_ids(once.drop("repaired")).select("station", F.col("station_id").alias("again"))
    return once.join(again, "station").select("station", F.col("again").alias("station_id"), "repaired")


@query(sql("stations", body="""w as (select station, scenario, tech, lat + case when station % 11 = 0 then 0.5 else 0 end as lat, lon, case when station % 13 = 0 then 'x' else substr(sha1(scenario || '|' || tech || '|' || printf('%.4f', WRAP) || '|' || printf('%.4f', lat)), 1, 20) end as id from stations where station % 17 <> 0)
select s.station as row, case when w.station is null then 'not_written' when abs(w.lat - s.lat) > 0.1 then 'moved' else 'bad_id' end as fault from stations s left join w on w.station = s.station where w.station is null or abs(w.lat - s.lat) > 0.1 or w.id = 'x'"""))
def station_identity_faults(spark, d):
    """A file's stations against their list: rows left out, moved, and with other ids."""
    listed = stations(spark, d).withColumn("row", F.col("station"))
    written = S.with_ids(listed).filter("row % 17 <> 0").withColumns({"lat": F.when(F.col("row") % 11 == 0, F.col("lat") + 0.5).otherwise(F.col("lat")), "station_id": F.when(F.col("row") % 13 == 0, F.lit("x")).otherwise(F.col("computed_id"))})
    return S.identity_faults(written.drop("computed_id"), listed)


@query(sql("stations", body="""a as (select station as row, lat, lon from stations), b as (select case when station % 9 = 0 then station + 10000000 else station end as row, station as site, lat + case when station % 4 = 0 then 0.0004::double else 0 end as lat, lon from stations),
p as (select a.row, b.site from a join b on a.row = b.row where greatest(abs(a.lat - b.lat), abs(a.lon - b.lon)) <= 0.001::double),
q as (select a.row, min({'d': round(greatest(abs(a.lat - b.lat), abs(a.lon - b.lon)), 9), 'r': b.row, 's': b.site}) as m from a join b on b.lat between a.lat - 0.0011 and a.lat + 0.0011 and b.lon between a.lon - 0.0011 and a.lon + 0.0011
  where greatest(abs(a.lat - b.lat), abs(a.lon - b.lon)) <= 0.001::double and a.row not in (select row from p) group by 1)
select row, site, 'position' as matched from p union all select row, m.s, 'place' from q"""))
def station_reconcile(spark, d):
    """Weather rows tied to listed stations by position, and where the list has moved by place within a thousandth of a degree."""
    s = stations(spark, d)
    listed = s.select(F.when(F.col("station") % 9 == 0, F.col("station") + 10_000_000).otherwise(F.col("station")).alias("row"), F.col("station").alias("site"), (F.col("lat") + F.when(F.col("station") % 4 == 0, 0.0004).otherwise(0.0)).alias("lat"), "lon")
    return S.reconcile(s.select(F.col("station").alias("row"), "lat", "lon"), listed)


@query(sql("stations", body="select station, tech as type, round(lon, 6) as lon, round(lat, 6) as lat, region as country from stations where tech = 'wind' and region in ('NX-11', 'Norhavn', 'Brannoc')"))
def station_parse_legacy(spark, d):
    """The list under an older list's column names, wind sites of three countries only."""
    s = stations(spark, d)
    raw = s.select(F.col("lon").cast("string").alias("﻿Longitude"), F.col("lat").cast("string").alias(" LAT "), F.upper("tech").alias("Technology"), F.col("region").alias("nation"), F.col("station").cast("string").alias("cap_gw"))
    out = S.parse_legacy(raw, "wind", ("NX-11", "Norhavn", "Brannoc"))
    return out.select(F.col("capacity_gw").cast("bigint").alias("station"), "type", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "country")


# merging weather and thresholds used again


@query(sql("obs", body="""a as (select station, date_trunc('hour', t) as t, round(avg(cast(temp_c as double)), 6) as temp_c, round(avg(cast(wind_ms as double)), 6) as wind_ms from obs where month(t) <= 7 group by 1, 2),
b as (select station, date_trunc('hour', t) as t, round(avg(cast(temp_c as double)), 6) + 1 as temp_c, round(avg(cast(wind_ms as double)), 6) as wind_ms from obs where month(t) >= 6 group by 1, 2)
select coalesce(a.station, b.station) as station, coalesce(a.t, b.t) as t, round(case when a.station is not null then a.temp_c else b.temp_c end, 6) as temp_c, case when a.station is not null then a.wind_ms else b.wind_ms end as wind_ms from a full join b on a.station = b.station and a.t = b.t"""))
def merge_weather_times(spark, d):
    """Two weather tables with other times and variables: union of times, common variables, the first holds."""
    x = obs(spark, d, "temp_c", "wind_ms", "rh_pct")
    mean = lambda df, *c: df.groupBy("station", F.col("hour").alias("t")).agg(*[F.round(F.avg(F.col(k).cast("double")), 6).alias(k) for k in c])
    a = mean(x.filter(F.month("t") <= 7), "temp_c", "wind_ms", "rh_pct")
    b = mean(x.filter(F.month("t") >= 6), "temp_c", "wind_ms").withColumn("temp_c", F.col("temp_c") + 1)
    return S.merge_weather([a, b], ["station"]).withColumn("temp_c", F.round("temp_c", 6))


@query("""with g as (select tech, lat_idx, lon_idx, pctl, threshold, valid_count from (select distinct * from threshold_grid)),
n as (select tech, lat_idx, lon_idx, pctl, count(*) as n from g group by all)
select tech, lat_idx, lon_idx, pctl, 'missing' as fault from g where threshold is null or isnan(threshold)
union all select tech, lat_idx, lon_idx, pctl, 'uncounted' from g where valid_count is null or valid_count <= 0
union all select tech, lat_idx, lon_idx, pctl, 'doubled' from n where n > 1
union all select distinct tech, lat_idx, lon_idx, cast(null as smallint), 'incomplete' from (select tech, lat_idx, lon_idx from g group by all having count(distinct pctl) < 4)""")
def thr_compatibility(spark, d):
    """What keeps recorded thresholds from being used again."""
    g = table(spark, d, "threshold_grid").distinct()
    return pipelines.compatibility_faults(g, ["tech", "lat_idx", "lon_idx"], "pctl", 4)


@query(sql("panel", body=",\n".join(PLAIN[:4]) + "\nselect count(*) as stations, round(min(threshold), 6) as low, round(median(threshold), 6) as middle, round(max(threshold), 6) as high, (select min(year(t)) from panel where v is not null) as first_year, (select max(year(t)) from panel where v is not null) as last_year from p"))
def thr_summary(spark, d):
    """Lowest, median and highest threshold, and the years that the series cover."""
    rolled = lowres.rolling(panel(spark, d))
    each = lowres.own_anomalies(rolled).groupBy("station").agg(F.percentile("anom", F.lit(0.05)).alias("threshold"), F.min(F.when(F.col("v").isNotNull(), F.year("t"))).alias("a"), F.max(F.when(F.col("v").isNotNull(), F.year("t"))).alias("b"))
    r = lambda c, n: F.round(c, 6).alias(n)
    return each.agg(F.count(F.lit(1)).alias("stations"), r(F.min("threshold"), "low"), r(F.median("threshold"), "middle"), r(F.max("threshold"), "high"), F.min("a").cast("bigint").alias("first_year"), F.max("b").cast("bigint").alias("last_year"))


# what is there, what is written


@query(sql("obs", body="\nunion all ".join(f"select '{e}' as event, {reason} as reason, {n} as usable from obs" for e, reason, n in (
    ("freezing_rain", "cast(null as varchar)", "count(case when temp_c is not null and precip_mmh is not null then 1 end)"), ("dust", "'dust_aod'", "cast(0 * count(*) as bigint)"), ("rainstorm", "cast(null as varchar)", "count(precip_mmh)"),
    ("high_humidity", "cast(null as varchar)", "count(rh_pct)"), ("cold_highwind", "cast(null as varchar)", "count(case when temp_c is not null and wind_ms is not null then 1 end)"), ("icing", "cast(null as varchar)", "count(case when temp_c is not null and rh_pct is not null then 1 end)"))) ))
def evt_readiness(spark, d):
    """Of each solar event the column it lacks and the readings it can be told from, in a table without dust."""
    return events.readiness(obs(spark, d, "temp_c", "precip_mmh", "rh_pct", "wind_ms"), "solar")


@query(sql("obs", body="""g as (select station, t, count(*) as n, count(wind_ms) as k from obs group by 1, 2), l as (select *, epoch_us(t) - epoch_us(lag(t) over (partition by station order by t)) as gap from g)
select station, cast(sum(n) as bigint) as rows, cast(sum(n - 1) as bigint) as doubled, count(case when gap <> 3600000000 then 1 end) as gaps, cast(sum(n - k) as bigint) as missing from l group by 1"""))
def dq_series(spark, d):
    """Times that come again, gaps and missing values of every station's wind."""
    return timeaxis.faults(obs(spark, d, "wind_ms"), "wind_ms")


@query(sql("panel", body=RUNNING + """,
odd as (select * from acc where month(t) % 2 = 1),
x as (select station, t, acc, case when hour(t) = 1 then acc when lag(t) over w is null or lag(t) over w <> t - interval 1 hour then null else acc - lag(acc) over w end as x from odd window w as (partition by station order by t))
select station, t, round(case when x is not null then greatest(case when x < 0 then acc else x end, 0) end, 5) as v from x""", value="precip_mmh"))
def deaccum_missing_month(spark, d):
    """Totals of every other month only: the first step after a missing month has no predecessor."""
    some = _accumulated(spark, d).filter(F.month("t") % 2 == 1)
    return timeaxis.deaccumulate(some, first="nan", step_hours=1.0).select("station", "t", F.round("v", 5).alias("v"))


@query(sql("obs", body="select obs_id, station, year(t) as year, cast(coalesce(wind_ms > 18, false) as int) as high_wind, cast(coalesce(temp_c > 35, false) as int) as high_temp from obs"))
def sink_signals(spark, d):
    """Wind signals written by year and read back."""
    at = scratch(spark, "signals")
    rows = events.with_signals(obs(spark, d, "temp_c", "wind_ms", "rh_pct"), "wind").withColumn("year", F.year("t"))
    sinks.write_signals(rows.select("obs_id", "station", "year", "signal_high_wind", "signal_high_temp"), at)
    back = spark.read.parquet(at)
    return back.select("obs_id", "station", F.col("year").cast("bigint").alias("year"), F.col("signal_high_wind").cast("int").alias("high_wind"), F.col("signal_high_temp").cast("int").alias("high_temp"))


@query(sql("obs", "site", body="""s as (select station, t, max(cast(coalesce(precip_mmh > 2, false) as int)) as rainstorm from obs group by 1, 2)
select s.station, s.t, s.rainstorm, site.s.region as region, round(site.s.lat, 6) as lat from s join site on site.p = substr(s.station, 1, 3)"""))
def sink_station_tables(spark, d):
    """Station signals and their stations written as two tables, read back and joined."""
    at = scratch(spark, "station_signals")
    known = sites(spark, d, "solar")
    rows = events.with_signals(obs(spark, d, "precip_mmh"), "solar").groupBy("station", "t").agg(F.max("signal_rainstorm").alias("signal_rainstorm"))
    sinks.write_station_signals(rows.join(known.select("station"), "station", "left_semi"), known, at)
    back = spark.read.parquet(f"{at}/signals").join(spark.read.parquet(f"{at}/stations"), "station")
    return back.select("station", "t", F.col("signal_rainstorm").cast("int").alias("rainstorm"), "region", F.round("lat", 6).alias("lat"))


@query(sql("panel", body=",\n".join(PLAIN[:4]) + "\nselect p.station, round(cast(cast(p.threshold as float) as double), 4) as threshold, cast(valid_count as int) as valid_count, count(c.clim) as cells from p left join c on c.station = p.station group by all"))
def sink_thresholds(spark, d):
    """Climatology and thresholds written with their schema, read back and joined."""
    at = scratch(spark, "thresholds")
    clim, thr = pipelines.precompute_thresholds(panel(spark, d))
    sinks.write_thresholds(clim, thr, at)
    cells = spark.read.parquet(f"{at}/clim").groupBy("station").agg(F.count("clim").alias("cells"))
    out = spark.read.parquet(f"{at}/thr").join(cells, "station", "left")
    return out.select("station", F.round(F.col("threshold").cast("double"), 4).alias("threshold"), "valid_count", F.coalesce("cells", F.lit(0)).alias("cells"))
