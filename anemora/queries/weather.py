"""Queries of units, events, low resource and time axes."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.functions import weather as W
from anemora.operators import events, lowres, timeaxis
from anemora.queries.views import obs, panel, sites, sql, stations
from anemora.session import table

QUERIES: dict = {}
#: Added before rounding where exact halves occur, which engines round differently.
TIE = 3e-11
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLES[name or f.__name__] = oracle
        return f

    return add


def r(c, n=6):
    return F.round(c.cast("double") if hasattr(c, "cast") else F.col(c).cast("double"), n)


# units and quantities


@query(sql("obs", body="select obs_id, round(temp_c + 273.15 + cast(-273.15 as double), 4) as temp_c, round(wind_ms * cast(3.6 as double) * (1 / cast(3.6 as double)), 4) as wind_ms, round(precip_mmh / 3600.0 * 3600.0, 4) as precip_mmh, round(rsds / 1000.0 * 1000.0, 4) as rsds, round(case when rh_pct is not null then least(greatest(cast(rh_pct as double), 0), 100) end, 4) as rh_pct from obs").replace("temp_c + 273.15", "cast(temp_c as double) + cast(273.15 as double)").replace("round(wind_ms *", "round(cast(wind_ms as double) *"))
def unit_conversions(spark, d):
    """Readings written in other units and brought back."""
    x = obs(spark, d)
    c = lambda n: F.col(n).cast("double")
    return x.select(
        "obs_id", F.round(W.to_celsius(c("temp_c") + 273.15, "K"), 4).alias("temp_c"), F.round(W.to_ms(c("wind_ms") * 3.6, "km/h"), 4).alias("wind_ms"),
        F.round(W.to_mmh(c("precip_mmh") / 3600.0, "kg m-2 s-1"), 4).alias("precip_mmh"), F.round(W.to_wm2(c("rsds") / 1000.0, "kW m-2"), 4).alias("rsds"), F.round(W.to_percent(c("rh_pct"), "%"), 4).alias("rh_pct"),
    )


@query("select source, case when median(reading) > 100 then 'K' else 'degC' end as unit from (select distinct row_id, source, reading from weather_bundle where var_name = 'tas' and isfinite(reading)) group by source")
def unit_infer_temperature(spark, d):
    """By source, the temperature unit that its median suggests."""
    w = table(spark, d, "weather_bundle").dropDuplicates(["row_id"]).filter("var_name = 'tas'")
    return w.withColumn("x", W.finite(F.col("reading"))).filter("x is not null").groupBy("source").agg(F.when(F.median("x") > 100, "K").otherwise("degC").alias("unit"))


@query(sql("obs", body="select case when min(rh_pct) < -1 then 'invalid' when max(rh_pct) <= 1.01 then 'fraction' when max(rh_pct) <= 101 then '%' else 'invalid' end as unit from obs"))
def unit_infer_humidity(spark, d):
    return W.infer_humidity_unit(obs(spark, d), "rh_pct")


@query(sql("obs", body="""x as (select obs_id, cast(temp_c as double) + cast(273.15 as double) as tk, cast(temp_c as double) + cast(273.15 as double) - cast(wind_ms as double) as td from obs),
p as (select obs_id, tk - cast(273.15 as double) as a, td - cast(273.15 as double) as b from x)
select obs_id, round(least(greatest(100 * exp(cast(17.67 as double) * b / (b + cast(243.5 as double))) / exp(cast(17.67 as double) * a / (a + cast(243.5 as double))), 0), 100), 6) as rh from p where a is not null and b is not null"""))
def magnus_rh(spark, d):
    """Humidity of readings whose dew point lies wind_ms degrees below their temperature."""
    t = F.col("temp_c").cast("double") + 273.15
    return obs(spark, d).select("obs_id", F.round(W.magnus_rh(t, t - F.col("wind_ms").cast("double")), 6).alias("rh")).filter("rh is not null")


@query(sql("obs", body="select obs_id, round(sqrt(cast(wind_ms as double) * cast(wind_ms as double) + cast(temp_c as double) * cast(temp_c as double)), 6) as speed from obs"))
def wind_speed(spark, d):
    return obs(spark, d).select("obs_id", F.round(W.wind_speed(F.col("wind_ms").cast("double"), F.col("temp_c").cast("double")), 6).alias("speed"))


@query("select distinct match_id, round((((lon + 180) % 360) + 360) % 360 - 180, 6) as lon180, round(((lon % 360) + 360) % 360, 6) as lon360 from station_match where abs(lon) <= 540")
def lon_wrap(spark, d):
    rows = table(spark, d, "station_match").dropDuplicates(["match_id"]).filter(F.abs("lon") <= 540)
    return rows.select("match_id", F.round(W.lon_180(F.col("lon")), 6).alias("lon180"), F.round(W.lon_360(F.col("lon")), 6).alias("lon360"))


@query("""with g as (select distinct region, idx0, idx1, lon from grid_cell), m as (select region, max(lon) > 180 as wide from g group by region)
select region, idx0, idx1, round(case when wide then (((lon + 180) % 360) + 360) % 360 - 180 else lon end, 6) as lon from g join m using (region)""")
def lon_axis_normalise(spark, d):
    """Longitudes in ±180, converted for those grids only that exceed 180."""
    g = table(spark, d, "grid_cell").select("region", "idx0", "idx1", "lon").distinct()
    wide = g.groupBy("region").agg((F.max("lon") > 180).alias("wide"))
    return g.join(wide, "region").select("region", "idx0", "idx1", F.round(F.when(F.col("wide"), W.lon_180(F.col("lon"))).otherwise(F.col("lon")), 6).alias("lon"))


SUN = """h as (select obs_id, {lat} as lat, {lon} as lon, 2 * pi() * (dayofyear(t) - 1) / 365.0 as g, hour(t) * 60 + minute(t) as m from {src}),
k as (select *, 0.006918::double - 0.399912::double * cos(g) + 0.070257::double * sin(g) - 0.006758::double * cos(2 * g) + 0.000907::double * sin(2 * g) - 0.002697::double * cos(3 * g) + 0.00148::double * sin(3 * g) as dec,
  229.18::double * (0.0000075::double + 0.001868::double * cos(g) - 0.032077::double * sin(g) - 0.014615::double * cos(2 * g) - 0.04089::double * sin(2 * g)) as eot from h),
sun as (select obs_id, degrees(asin(least(greatest(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(radians((m + eot + 4 * lon) / 4 - 180)), -1), 1))) as elevation from k)"""


@query(sql("obs", "site", body=SUN.format(lat="site.s.lat", lon="site.s.lon", src="obs join site on site.p = substr(obs.station, 1, 3)") + "\nselect obs_id, round(elevation, 6) as elevation from sun"))
def solar_elevation(spark, d):
    """Height of the sun over a station's site at every reading."""
    rows = obs(spark, d, "rsds").join(sites(spark, d, "solar"), "station")
    return rows.select("obs_id", F.round(W.solar_elevation(F.col("lat"), F.col("lon"), F.col("t")), 6).alias("elevation"))


@query(sql("stations", body="""select station, round(2 * 6371.0088::double * asin(sqrt(least(power(sin(radians(lat - 50.0) / 2), 2) + cos(radians(50.0::double)) * cos(radians(lat)) * power(sin(radians(lon - 10.0) / 2), 2), 1))), 4) as km from stations"""))
def haversine(spark, d):
    return stations(spark, d).select("station", F.round(W.haversine_km(F.lit(50.0), F.lit(10.0), F.col("lat"), F.col("lon")), 4).alias("km"))


@query(sql("obs", body="select obs_id, case when rsds > 1361 then 0.0 else rsds end as rsds from obs where rsds is not null"))
def solar_cap(spark, d):
    return obs(spark, d).filter("rsds is not null").select("obs_id", W.cap_radiation(F.col("rsds")).alias("rsds"))


# events

CONDITIONS = {
    "wind_icing": "temp_c < -2 and rh_pct >= 85",
    "wind_high_temp": "temp_c > 35",
    "wind_hot_humid": "temp_c > 30 and rh_pct >= 85",
    "wind_high_wind": "wind_ms > 18",
    "solar_freezing_rain": "temp_c < 3 and precip_mmh > 0.1::double",
    "solar_dust": "dust_aod > 0.5::float",
    "solar_rainstorm": "precip_mmh > 2",
    "solar_high_humidity": "rh_pct >= 95",
    "solar_cold_highwind": "temp_c < 5 and wind_ms > 8",
    "solar_icing": "temp_c < -2 and rh_pct >= 85",
}
V1 = CONDITIONS | {"wind_high_wind": "wind_ms > 17", "solar_freezing_rain": "temp_c < 3 and precip_mmh > 0", "solar_dust": "dust_aod > 0.4::float"}


def _flag(cond: str) -> str:
    return f"cast(coalesce({cond}, false) as int)"


def _event(tech: str, name: str):
    def run(spark, d):
        return events.with_signals(obs(spark, d), tech).select("obs_id", F.col(f"signal_{name}").cast("int").alias("flag"))

    return run


for key, cond in CONDITIONS.items():
    query(sql("obs", body=f"select obs_id, {_flag(cond)} as flag from obs"), f"evt_{key}")(_event(*key.split("_", 1)))


def _wide(spark, d, ruleset="current"):
    rows = events.with_signals(obs(spark, d), "wind", ruleset, "wind_")
    return events.with_signals(rows, "solar", ruleset, "solar_")


@query(sql("obs", body="select obs_id, " + ", ".join(f"{_flag(c)} as {k}" for k, c in CONDITIONS.items()) + " from obs"))
def evt_all_wide(spark, d):
    return _wide(spark, d).select("obs_id", *[F.col(k).cast("int").alias(k) for k in CONDITIONS])


@query(sql("obs", body="select obs_id, " + ", ".join(f"{_flag(c)} as {k}" for k, c in V1.items()) + " from obs"))
def evt_v1_rules(spark, d):
    return _wide(spark, d, "v1").select("obs_id", *[F.col(k).cast("int").alias(k) for k in V1])


@query(sql("obs", body="\nunion all ".join(f"select obs_id, '{k[6:]}' as event, {_flag(c)} as flag from obs" for k, c in CONDITIONS.items() if k.startswith("solar_"))))
def evt_all_long(spark, d):
    return events.long_signals(events.with_signals(obs(spark, d), "solar"), ["obs_id"])


@query(sql("obs", body="select station, count(*) as n, " + ", ".join(f"round(avg({_flag(c)}), 6) as {k[5:]}" for k, c in CONDITIONS.items() if k.startswith("wind_")) + " from obs group by station"))
def evt_exposure_by_station(spark, d):
    out = events.exposure(events.with_signals(obs(spark, d), "wind"), ["station"])
    return out.select("station", "n", *[F.round(k[5:], 6).alias(k[5:]) for k in CONDITIONS if k.startswith("wind_")])


@query(sql("obs", body="select year(t) as year, month(t) as month, count(*) as n, sum(cast(coalesce(wind_ms > 18, false) as bigint)) as high_wind from obs group by rollup (year(t), month(t))"))
def evt_exposure_rollup(spark, d):
    x = events.with_signals(obs(spark, d), "wind").withColumns({"year": F.year("t"), "month": F.month("t")})
    return x.rollup("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("signal_high_wind").cast("bigint")).alias("high_wind"))


@query(sql("obs", body="select obs_id, station, t from obs where year(t) between 2019 and 2020 and month(t) in (1, 7)"))
def filter_year_month(spark, d):
    return obs(spark, d).filter(F.year("t").between(2019, 2020) & F.month("t").isin(1, 7)).select("obs_id", "station", "t")


# low resource

ROLL = "r as (select station, t, case when count(v) over w = 24 then avg(v) over w end as roll from panel window w as (partition by station order by t rows between 12 preceding and 11 following))"
CLIM = "c as (select station, month(t) as month, hour(t) as hour, avg(roll) as clim from r {where} group by 1, 2, 3)"
ANOM = "a as (select r.station, r.t, round(r.roll - c.clim, 9) as anom from r left join c on r.station = c.station and month(r.t) = c.month and hour(r.t) = c.hour)"
THR = "p as (select station, quantile_cont(anom, 0.05) as threshold, count(anom) as valid_count from a {where} group by station)"
MARK = "e as (select a.station, a.t, a.anom, coalesce(a.anom <= p.threshold, false) as hit from a left join p on a.station = p.station), m as (select *, hit or coalesce(lag(hit) over (partition by station order by t), false) as low from e)"
SIGNAL = "select station, t, cast(anom is not null and low as int) as low_resource from m"


def _lowres_sql(*parts: str, end: str = SIGNAL, value: str = "wind_ms") -> str:
    return sql("panel", body=",\n".join(parts) + "\n" + end, value=value)


PLAIN = (ROLL, CLIM.format(where=""), ANOM, THR.format(where=""), MARK)


@query(_lowres_sql(ROLL, end="select station, t, round(roll, 6) as roll from r"))
def lowres_roll24(spark, d):
    return lowres.rolling(panel(spark, d)).select("station", "t", F.round("roll", 6).alias("roll"))


@query(_lowres_sql(ROLL.replace("= 24", "= 8").replace("12 preceding and 11", "4 preceding and 3"), end="select station, t, round(roll, 6) as roll from r"))
def lowres_roll8(spark, d):
    return lowres.rolling(panel(spark, d), 8).select("station", "t", F.round("roll", 6).alias("roll"))


ROLL_V1 = ROLL.replace("= 24", "= count(*) over w").replace("12 preceding and 11 following", "11 preceding and 12 following")


@query(_lowres_sql(ROLL_V1, end="select station, t, round(roll, 6) as roll from r"))
def lowres_roll24_v1(spark, d):
    return lowres.rolling_v1(panel(spark, d)).select("station", "t", F.round("roll", 6).alias("roll"))


@query(_lowres_sql(ROLL, CLIM.format(where=""), end="select station, month, hour, round(clim + 3e-11, 9) as clim from c"))
def lowres_clim288(spark, d):
    return lowres.climatology(lowres.rolling(panel(spark, d))).select("station", F.col("month").cast("bigint").alias("month"), F.col("hour").cast("bigint").alias("hour"), F.round(F.col("clim") + TIE, 9).alias("clim"))


@query(_lowres_sql(*PLAIN[:4], end="select station, round(threshold, 6) as threshold, valid_count from p"))
def lowres_thresholds(spark, d):
    rolled = lowres.rolling(panel(spark, d))
    return lowres.thresholds(lowres.own_anomalies(rolled)).select("station", F.round("threshold", 6).alias("threshold"), "valid_count")


@query(_lowres_sql(*PLAIN))
def lowres_wind(spark, d):
    return lowres.low_resource(panel(spark, d)).select("station", "t", F.col("low_resource").cast("int").alias("low_resource"))


@query(sql("panel", "site", body=",\n".join((*PLAIN, "x as (select station as obs_id, t, * exclude (station, t) from m)", SUN.format(lat="site.s.lat", lon="site.s.lon", src="x left join site on site.p = substr(x.obs_id, 1, 3)").replace("select obs_id, site", "select obs_id, t, anom, low, site").replace("sun as (select obs_id,", "sun as (select obs_id, t, anom, low,"))) + "\nselect obs_id as station, t, cast(anom is not null and low and coalesce(elevation > 0, true) as int) as low_resource from sun", value="rsds"))
def lowres_solar(spark, d):
    """Low irradiance, not counted at night over a station's site; a station without a site has no night."""
    series = panel(spark, d, "rsds").join(sites(spark, d, "solar").select("station", "lat", "lon"), "station", "left")
    night = W.solar_elevation(F.col("lat"), F.col("lon"), F.col("t")) <= 0
    return lowres.low_resource(series, night=night).select("station", "t", F.col("low_resource").cast("int").alias("low_resource"))


@query(_lowres_sql(ROLL_V1, CLIM.format(where=""), ANOM, THR.format(where=""), "m as (select a.station, a.t, a.anom, coalesce(a.anom <= p.threshold, false) as low from a left join p on a.station = p.station)"))
def lowres_v1(spark, d):
    """The older kernel: other window, no following step."""
    return lowres.low_resource(panel(spark, d), mark_next=False, kernel="v1").select("station", "t", F.col("low_resource").cast("int").alias("low_resource"))


@query(_lowres_sql(ROLL, CLIM.format(where="where year(t) between 2018 and 2020"), ANOM, THR.format(where="where year(t) between 2018 and 2020"), MARK))
def lowres_baseline_subset(spark, d):
    return lowres.low_resource(panel(spark, d), baseline=(2018, 2020)).select("station", "t", F.col("low_resource").cast("int").alias("low_resource"))


@query(_lowres_sql(ROLL, "c as (select cast(month(t) as bigint) as month, hour(t) as hour, round(avg(roll), 6) as clim from r group by 1, 2)", ANOM.replace("r.station = c.station and ", ""), "p as (select station, -1.0::double as threshold from panel group by station)", MARK))
def lowres_external_thr(spark, d):
    """Climatology and thresholds from outside the series: those of all stations together, and -1."""
    x = panel(spark, d)
    rolled = lowres.rolling(x)
    clim = rolled.groupBy(F.month("t").alias("month"), F.hour("t").alias("hour")).agg(F.round(F.avg("roll"), 6).alias("clim"))
    each = table(spark, d, "weather_hourly").select(F.col("station_id").alias("station")).distinct()
    thr = each.withColumn("threshold", F.lit(-1.0))
    # 288 rows at most, for each station
    own = each.join(F.broadcast(clim))
    return lowres.low_resource(x, clim=own, thr=thr).select("station", "t", F.col("low_resource").cast("int").alias("low_resource"))


# time axes


@query(sql("obs", body="select station, round(median(gap), 6) as step_hours from (select station, (epoch_us(t) - epoch_us(lag(t) over (partition by station order by t))) / 3600000000.0 as gap from (select distinct station, t from obs)) group by station"))
def time_step_infer(spark, d):
    return timeaxis.step_hours(obs(spark, d).select("station", "t").distinct()).select("station", F.round("step_hours", 6).alias("step_hours"))


@query(sql("obs", body="select station, t, round(gap, 6) as gap_hours from (select station, t, (epoch_us(t) - epoch_us(lag(t) over (partition by station order by t))) / 3600000000.0 as gap from (select distinct station, t from obs)) where gap <> 1"))
def time_axis_gaps(spark, d):
    return timeaxis.gaps(obs(spark, d).select("station", "t").distinct()).withColumn("gap_hours", F.round("gap_hours", 6))


@query(sql("panel", body="select station, t, v from panel"))
def time_align_axis(spark, d):
    return panel(spark, d).select("station", "t", "v")


@query(sql("panel", body="select station, t, v from panel where hour(t) % 6 = 0"))
def time_exact_lookup(spark, d):
    x = panel(spark, d)
    return timeaxis.exact_lookup(x, x.filter(F.hour("t") % 6 == 0).select("station", "t")).select("station", "t", "v")


INTERP = """src as (select station, t, v from panel where v is not null and hour(t) % 3 = 0),
want as (select station, t + interval 30 minute as t from panel union all select station, t from panel where hour(t) % 3 = 0),
k as (select w.station, w.t, (select max(s.t) from src s where s.station = w.station and s.t <= w.t) as a, (select min(s.t) from src s where s.station = w.station and s.t >= w.t) as b from want w),
ends as (select station, min(t) as lo, max(t) as hi from src group by station),
i as (select k.station, k.t, x.v as va, y.v as vb, lo, hi,
  case when a = b then x.v else x.v * (1 - (epoch_us(k.t) - epoch_us(a)) / cast(epoch_us(b) - epoch_us(a) as double)) + y.v * ((epoch_us(k.t) - epoch_us(a)) / cast(epoch_us(b) - epoch_us(a) as double)) end as line
  from k left join src x on x.station = k.station and x.t = k.a left join src y on y.station = k.station and y.t = k.b left join ends on ends.station = k.station)
"""


def _interpolated(spark, d, boundary):
    x = panel(spark, d)
    source = x.filter(F.hour("t") % 3 == 0)
    wanted = x.select("station", (F.col("t") + F.expr("interval 30 minutes")).alias("t")).unionByName(source.select("station", "t"))
    return timeaxis.interpolate(source, wanted, boundary=boundary).select("station", "t", F.round("v", 9).alias("v"))


@query(sql("panel", body=INTERP + "select station, t, round(coalesce(line, va, vb), 9) as v from i"))
def time_interp_linear(spark, d):
    """Three-hourly values at the half hours between; outside the range the nearest."""
    return _interpolated(spark, d, "nearest")


@query(sql("panel", body=INTERP + "select station, t, round(case when t > lo and t < hi then line end, 9) as v from i"))
def time_interp_nan(spark, d):
    return _interpolated(spark, d, "nan")


RUNNING = "acc as (select station, t, round(sum(coalesce(v, 0)) over (partition by station, cast(t - interval 1 hour as date) order by t), 6) as acc from panel)"


def _accumulated(spark, d):
    """Rain that adds up from hour 1 to hour 0 of the next day."""
    from pyspark.sql import Window

    day = Window.partitionBy("station", F.to_date(F.col("t") - F.expr("interval 1 hour"))).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return panel(spark, d, "precip_mmh").withColumn("acc", F.round(F.sum(F.coalesce("v", F.lit(0.0))).over(day), 6)).select("station", "t", "acc")


DEACC = "x as (select station, t, acc, case when hour(t) = 1 then acc when lag(t) over w is null then 0 else acc - lag(acc) over w end as x from acc window w as (partition by station order by t))"


@query(sql("panel", body=RUNNING + ",\n" + DEACC + "\nselect station, t, round(greatest(case when x < 0 then acc else x end, 0), 5) as v from x", value="precip_mmh"))
def deaccum_grid(spark, d):
    return timeaxis.deaccumulate(_accumulated(spark, d)).select("station", "t", F.round("v", 5).alias("v"))


@query(sql("panel", body=RUNNING + ",\nx as (select station, t, acc - lag(acc) over (partition by station order by t) as x from acc)\nselect station, t, round(case when x > 0 then x else 0 end, 5) as v from x", value="precip_mmh"))
def deaccum_legacy(spark, d):
    return timeaxis.deaccumulate_legacy(_accumulated(spark, d)).select("station", "t", F.round("v", 5).alias("v"))


@query("""with w as (select distinct on (obs_id) obs_id, station_id as station, t, case when isfinite(dust_aod) then round(cast(dust_aod as double), 6) end as dust from weather_hourly order by obs_id),
day as (select station, date_trunc('hour', t) as h, arg_max(dust, obs_id) as dust from w where dust is not null and hour(t) % 2 = 0 group by 1, 2)
select w.obs_id, day.dust from w left join day on day.station = w.station and day.h = date_trunc('hour', w.t)""")
def dust_hourly_lookup(spark, d):
    """The last dust value of the full hour; it is known for even hours only."""
    x = obs(spark, d).select("obs_id", "station", "t", F.round(F.col("dust_aod").cast("double"), 6).alias("dust"))
    return timeaxis.hourly_lookup(x.select("obs_id", "station", "t"), x.filter((F.hour("t") % 2 == 0) & F.col("dust").isNotNull()), "dust", order="obs_id").select("obs_id", "dust")


@query("""with m as (select distinct station_id as station, year(t) as year, month(t) as month from weather_hourly),
e as (select year(d) as year, month(d) as month from (select unnest(generate_series(timestamp '2018-01-01', timestamp '2022-12-01', interval 1 month)) as d)),
s as (select distinct station from m)
select s.station, e.year, e.month from s, e where not exists (select 1 from m where m.station = s.station and m.year = e.year and m.month = e.month)""")
def missing_months(spark, d):
    x = table(spark, d, "weather_hourly").select(F.col("station_id").alias("station"), "t")
    out = timeaxis.missing_months(x, timeaxis.month_list(spark, "2018-01", "2022-12"), ["station"])
    return out.select("station", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query("""with m as (select distinct year(t) * 12 + month(t) - 1 as k from weather_hourly), z as (select min(k) as k0 from m)
select cast((k - k0) // 6 as int) as chunk, min(strftime(make_date(cast(k // 12 as int), cast(k % 12 + 1 as int), 1), '%Y-%m')) as first_month,
  max(strftime(make_date(cast(k // 12 as int), cast(k % 12 + 1 as int), 1), '%Y-%m')) as last_month, count(*) as months from m, z group by 1""")
def chunk_plan(spark, d):
    """The months that the readings cover, in chunks of six."""
    months = table(spark, d, "weather_hourly").select(F.year("t").alias("year"), F.month("t").alias("month")).distinct()
    return timeaxis.chunk_plan(months, 6)
