"""Queries of station matching, gathering, station lists, thresholds, sinks and the whole pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.operators import events, gridmatch, stations as S
from anemora.operators.rows import latest
from anemora.plans import pipelines
from anemora.queries.views import cells, cube, hourly, monthly_cube, obs, sites, sql, stations, wrap_sql
from anemora.queries.weather import CONDITIONS, PLAIN, TIE, _flag
from anemora.session import table
from anemora.sources import readers, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def placed(spark, d):
    return stations(spark, d).filter("region is not null")


def regular(spark, d):
    """Stations of regions on regular grids."""
    kinds = cells(spark, d).filter("grid_kind = 'regular_latlon'").select("region").distinct()
    return placed(spark, d).join(F.broadcast(kinds), "region", "left_semi")


GAP = "abs((((({a}) - ({b}) + 180) % 360) + 360) % 360 - 180)"
G1 = GAP.format(a="g.lon", b="s.lon")
AXES = "la as (select region, idx0, min(lat) as lat from cells where grid_kind = 'regular_latlon' group by 1, 2), lo as (select region, idx1, min(lon) as lon from cells where grid_kind = 'regular_latlon' group by 1, 2)"
NEAREST = f"""{AXES},
na as (select station, s.region, min({{'d': round(abs(g.lat - s.lat), 9), 'i': idx0}}) as m from stations s join la g on g.region = s.region group by 1, 2),
nb as (select station, s.region, min({{'d': round({G1}, 9), 'i': idx1}}) as m from stations s join lo g on g.region = s.region group by 1, 2),
near as (select na.station, na.region, na.m.i as idx0, nb.m.i as idx1, greatest(na.m.d, nb.m.d) as dist_deg from na join nb on na.station = nb.station and na.region = nb.region)"""


@query(sql("stations", "cells", body=NEAREST + "\nselect station, region, idx0, idx1, round(dist_deg, 6) as dist_deg, cast(dist_deg <= 0.15 as int) as valid from near"))
def match_nearest_regular(spark, d):
    out = gridmatch.nearest_regular(placed(spark, d), cells(spark, d))
    return out.select("station", "region", "idx0", "idx1", F.round("dist_deg", 6).alias("dist_deg"), F.col("valid").cast("int").alias("valid"))


@query(sql("stations", "cells", body="""x as (select station, c.region, min({'d': round(sqrt(power(s.lat - c.lat, 2) + power(s.lon - c.lon, 2)), 9), 'i': idx0, 'j': idx1}) as m
  from stations s join cells c on c.grid_kind = 'rotated_pole' and c.lat between s.lat - 0.5 and s.lat + 0.5 and c.lon between s.lon - 0.5 and s.lon + 0.5 group by 1, 2)
select station, region, m.i as idx0, m.j as idx1, round(m.d, 6) as dist_deg from x where m.d <= 0.5"""))
def match_nearest_2d(spark, d):
    return gridmatch.nearest_2d(stations(spark, d), cells(spark, d)).withColumn("dist_deg", F.round("dist_deg", 6))


BILINEAR = """r as (select station, region, lat, ((lon % 360) + 360) % 360 as lon from stations where region is not null),
la as (select region, idx0 as i, min(lat) as g from cells where grid_kind = 'regular_latlon' group by 1, 2),
lo as (select region, idx1 as i, ((min(lon) % 360) + 360) % 360 as g from cells where grid_kind = 'regular_latlon' group by 1, 2),
a as (select station, r.region, r.lat, coalesce(max({'g': g, 'i': i}) filter (g <= r.lat), min({'g': g, 'i': i})) as s, coalesce(min({'g': g, 'i': i}) filter (g > r.lat), max({'g': g, 'i': i})) as n from r join la on la.region = r.region group by 1, 2, 3),
b as (select station, r.region, r.lon, coalesce(max({'g': g, 'i': i}) filter (g <= r.lon), max({'g': g, 'i': i})) as w, coalesce(min({'g': g, 'i': i}) filter (g > r.lon), min({'g': g, 'i': i})) as e from r join lo on lo.region = r.region group by 1, 2, 3),
f as (select a.station, a.region, s.i as s, n.i as n, w.i as w, e.i as e, least(greatest(coalesce((a.lat - s.g) / nullif(n.g - s.g, 0), 0), 0), 1) as fy,
  least(greatest(coalesce(((((b.lon - w.g) % 360) + 360) % 360) / nullif((((e.g - w.g) % 360) + 360) % 360, 0), 0), 0), 1) as fx from a join b on a.station = b.station and a.region = b.region),
bridge as (select station, region, 0 as corner, s as idx0, w as idx1, (1 - fy) * (1 - fx) as weight from f union all select station, region, 1, s, e, (1 - fy) * fx from f
  union all select station, region, 2, n, w, fy * (1 - fx) from f union all select station, region, 3, n, e, fy * fx from f)"""


@query(sql("stations", "cells", body=BILINEAR + "\nselect station, region, corner, idx0, idx1, round(weight + 3e-11, 9) as weight from bridge"))
def match_bilinear(spark, d):
    return gridmatch.bilinear(regular(spark, d), cells(spark, d)).withColumn("weight", F.round(F.col("weight") + TIE, 9))


VALID = "valid as (select region, idx0, idx1 from cube group by 1, 2, 3 having count(v) > 0 and max(v) > 0)"


@query(sql("cube", body=VALID + "\nselect region, idx0, idx1 from valid"))
def valid_cell_mask(spark, d):
    return gridmatch.valid_cells(cube(spark, d))


@query(sql("stations", "cube", body=NEAREST + ",\n" + VALID + f""",
w as (select region, max(idx1) + 1 as width from lo group by 1),
k as (select near.station, near.region, min({{'ring': greatest(abs(v.idx0 - near.idx0), least((v.idx1 - near.idx1 + width) % width, (near.idx1 - v.idx1 + width) % width)), 'd': round(greatest(abs(la.lat - s.lat), {GAP.format(a="lo.lon", b="s.lon")}), 9), 'i': v.idx0, 'j': v.idx1}}) as m
  from near join w on w.region = near.region join valid v on v.region = near.region join la on la.region = v.region and la.idx0 = v.idx0 join lo on lo.region = v.region and lo.idx1 = v.idx1 join stations s on s.station = near.station group by 1, 2)
select station, region, cast(m.i as int) as idx0, cast(m.j as int) as idx1, cast(m.ring as int) as ring from k"""))
def match_nearest_valid(spark, d):
    s, g = placed(spark, d), cells(spark, d)
    return gridmatch.nearest_valid(gridmatch.nearest_regular(s, g), s, g, gridmatch.valid_cells(cube(spark, d)))


@query(sql("cube", body="""times as (select region, t, row_number() over (partition by region order by t) as k from (select distinct region, t from cube)),
probed as (select cube.* replace (v - 290 as v) from cube join times using (region, t) where k <= 24)
select region, idx0, idx1 from probed group by 1, 2, 3 having count(v) > 0 and (max(v) > 0 or idx0 % 3 = 0)"""))
def valid_cell_mask_land(spark, d):
    """The mask of differences to 290 K in each region's first 24 months; every third row of a grid is land."""
    x = cube(spark, d).withColumn("v", F.col("v") - 290)
    return gridmatch.valid_cells(x, cells(spark, d).filter("idx0 % 3 = 0"), probe=24)


HOLES = "floor(idx0 / 12) % 2 = 0 and floor(idx1 / 14) % 2 = 0"


@query(sql("stations", "cells", body=NEAREST + f""",
valid as (select region, idx0, idx1 from cells where {HOLES}),
w as (select region, max(idx1) + 1 as width from lo group by 1),
k as (select near.station, near.region, min({{'ring': greatest(abs(v.idx0 - near.idx0), least((v.idx1 - near.idx1 + width) % width, (near.idx1 - v.idx1 + width) % width)), 'd': round(greatest(abs(la.lat - s.lat), {GAP.format(a="lo.lon", b="s.lon")}), 9), 'i': v.idx0, 'j': v.idx1}}) as m
  from near join w on w.region = near.region join valid v on v.region = near.region join la on la.region = v.region and la.idx0 = v.idx0 join lo on lo.region = v.region and lo.idx1 = v.idx1 join stations s on s.station = near.station group by 1, 2)
select station, region, cast(m.i as int) as idx0, cast(m.j as int) as idx1, cast(m.ring as int) as ring from k"""))
def match_nearest_valid_holes(spark, d):
    """The same under a mask whose holes are up to 14 cells wide."""
    s, g = placed(spark, d), cells(spark, d)
    return gridmatch.nearest_valid(gridmatch.nearest_regular(s, g), s, g, g.filter(HOLES))


@query(sql("stations", "cube", body=NEAREST + "\nselect near.station, cube.t, round(cube.v, 6) as v from near join cube using (region, idx0, idx1)"))
def gather_nearest(spark, d):
    match = gridmatch.nearest_regular(placed(spark, d), cells(spark, d)).select("station", "region", "idx0", "idx1")
    return gridmatch.gather(match, cube(spark, d)).withColumn("v", F.round("v", 6))


@query(sql("stations", "cube", body=BILINEAR + "\nselect station, t, round(sum(weight * v) / nullif(sum(case when v is not null then weight end), 0) + 3e-9, 6) as v from bridge join cube using (region, idx0, idx1) group by 1, 2"))
def gather_weighted(spark, d):
    return gridmatch.gather(gridmatch.bilinear(regular(spark, d), cells(spark, d)), cube(spark, d)).withColumn("v", F.round(F.col("v") + 100 * TIE, 6))


@query(sql("stations", "cube", body=BILINEAR + "\nselect station, t, round(case when count(v) = count(*) then sum(weight * v) end + 3e-9, 6) as v from bridge join cube using (region, idx0, idx1) group by 1, 2"))
def gather_weighted_strict(spark, d):
    return gridmatch.gather(gridmatch.bilinear(regular(spark, d), cells(spark, d)), cube(spark, d), how="strict").withColumn("v", F.round(F.col("v") + 100 * TIE, 6))


# the same from all readings, with the units that the classifier is sure of; SQL cannot follow that


@query()
def valid_cell_mask_monthly(spark, d):
    return gridmatch.valid_cells(monthly_cube(spark, d))


@query()
def match_nearest_valid_monthly(spark, d):
    s, g = placed(spark, d), cells(spark, d)
    return gridmatch.nearest_valid(gridmatch.nearest_regular(s, g), s, g, gridmatch.valid_cells(monthly_cube(spark, d)))


@query()
def gather_nearest_monthly(spark, d):
    match = gridmatch.nearest_regular(placed(spark, d), cells(spark, d)).select("station", "region", "idx0", "idx1")
    return gridmatch.gather(match, monthly_cube(spark, d)).withColumn("v", F.round("v", 6))


@query()
def gather_weighted_monthly(spark, d):
    return gridmatch.gather(gridmatch.bilinear(regular(spark, d), cells(spark, d)), monthly_cube(spark, d)).withColumn("v", F.round("v", 6))


@query()
def gather_weighted_strict_monthly(spark, d):
    return gridmatch.gather(gridmatch.bilinear(regular(spark, d), cells(spark, d)), monthly_cube(spark, d), how="strict").withColumn("v", F.round("v", 6))


@query(sql("stations", "cells", body=NEAREST + ",\n" + "tc as (select tech, lat_idx as idx0, lon_idx as idx1, pctl, min(threshold) as threshold from threshold_grid where threshold is not null group by all)\nselect near.station, near.region, tc.pctl, round(cast(tc.threshold as double), 6) as threshold from near join stations s on s.station = near.station left join tc on tc.tech = s.tech and tc.idx0 = near.idx0 and tc.idx1 = near.idx1 where near.dist_deg <= 0.15"))
def thr_lookup_grid(spark, d):
    """The recorded thresholds of a station's technology at the cell that it lies on; null where there are none."""
    s = placed(spark, d)
    match = gridmatch.nearest_regular(s, cells(spark, d)).filter("valid").join(s.select("station", "tech"), "station")
    known = table(spark, d, "threshold_grid").filter("threshold is not null").groupBy("tech", F.col("lat_idx").alias("idx0"), F.col("lon_idx").alias("idx1"), "pctl").agg(F.min("threshold").alias("threshold"))
    return match.join(known, ["tech", "idx0", "idx1"], "left").select("station", "region", "pctl", F.round(F.col("threshold").cast("double"), 6).alias("threshold"))


@query(sql("stations", body="""t as (select station as row, tech, lat + 0.000004::double as lat, lon from stations where scenario = 'ssp126'),
x as (select s.station, min({'d': greatest(abs(s.lat - t.lat), abs(s.lon - t.lon)), 'row': t.row}) as m from stations s join t on t.tech = s.tech and t.lat between s.lat - 0.0001 and s.lat + 0.0001 and t.lon between s.lon - 0.0001 and s.lon + 0.0001
  where greatest(abs(s.lat - t.lat), abs(s.lon - t.lon)) <= 0.00001::double group by 1)
select station, m.row as row, round(m.d, 9) as dist_deg from x"""))
def thr_lookup_sparse(spark, d):
    """Stations against the points of one scenario, moved by less than the tolerance."""
    s = stations(spark, d)
    t = s.filter("scenario = 'ssp126'").select(F.col("station").alias("row"), "tech", (F.col("lat") + 0.000004).alias("lat"), "lon")
    return gridmatch.lookup_sparse(s, t).select("station", "row", F.round("dist_deg", 9).alias("dist_deg"))


OTHER = "other as (select region, idx0, idx1, lat + case when idx0 % 10 = 0 then 0.00001::double else 0 end as lat, lon from cells where idx1 % 50 <> 49)"


def _other(spark, d):
    c = cells(spark, d).filter("idx1 % 50 <> 49")
    return c.withColumn("lat", F.col("lat") + F.when(F.col("idx0") % 10 == 0, 0.00001).otherwise(0.0))


@query(sql("cells", body=OTHER + """,
sides as (select region, idx0, idx1, lat, lon, 0 as side from cells union all select region, idx0, idx1, lat, lon, 1 from other)
select region, idx0, idx1 from sides group by 1, 2, 3
having count(distinct side) < 2 or abs(min(lat) filter (side = 0) - min(lat) filter (side = 1)) > 0.000001::double or abs(min(lon) filter (side = 0) - min(lon) filter (side = 1)) > 0.000001::double"""))
def grid_equality(spark, d):
    """Where all grids differ from a copy with shifted latitudes and missing columns."""
    return gridmatch.grid_differences(cells(spark, d), _other(spark, d))


@query(sql("cells", body=OTHER + """,
x as (select region, idx0, min(lat) as lat from cells where grid_kind = 'regular_latlon' group by 1, 2), y as (select o.region, o.idx0, min(o.lat) as lat from other o join (select distinct region from x) using (region) group by 1, 2)
select x.region, x.idx0 as index_a, y.idx0 as index_b from x join y on x.region = y.region and abs(x.lat - y.lat) <= 0.000001::double"""))
def grid_intersection(spark, d):
    regular = F.col("grid_kind") == "regular_latlon"
    return gridmatch.axis_intersection(cells(spark, d).filter(regular), _other(spark, d).filter(regular), "idx0", "lat")


# station lists

RAW = """raw as (select distinct match_id, cast(activation_year as varchar) as year, ' ' || upper(tech) || ' ' as type, case when match_id % 11 = 0 then 'n/a' else cast(lon as varchar) end as lon, cast(lat as varchar) as lat, cast(capacity_gw as varchar) as capacity from station_match)"""


@query("with " + RAW + """, p as (select match_id, try_cast(year as double) as year, lower(trim(type)) as type, (((try_cast(lon as double) + 180) % 360) + 360) % 360 - 180 as lon, try_cast(lat as double) as lat, try_cast(capacity as double) as capacity_gw from raw)
select cast(year as int) as year, type, round(lon, 6) as lon, round(lat, 6) as lat, capacity_gw from p where lon is not null and lat is not null and year is not null""")
def station_parse(spark, d):
    """The list read from text; every eleventh longitude is unreadable."""
    m = table(spark, d, "station_match").dropDuplicates(["match_id"])
    raw = m.select(F.col("activation_year").cast("string").alias("year"), F.concat(F.lit(" "), F.upper("tech"), F.lit(" ")).alias("type"), F.when(F.col("match_id") % 11 == 0, "n/a").otherwise(F.col("lon").cast("string")).alias("lon"), F.col("lat").cast("string").alias("lat"), F.col("capacity_gw").cast("string").alias("capacity_gw"))
    return S.parse(raw).select("year", "type", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "capacity_gw")


@query(sql("stations", body="""k as (select tech, round(lon + 1e-7, 2) as lon2, round(lat + 1e-7, 2) as lat2, activation_year as year, capacity_gw from stations)
select tech, lon2, lat2, min(year) as activation_year, min({'year': year, 'c': capacity_gw}) filter (capacity_gw is not null).c as capacity_gw from k group by 1, 2, 3""".replace("min({'year': year, 'c': capacity_gw}) filter (capacity_gw is not null).c", "(min({'year': year, 'c': capacity_gw}) filter (capacity_gw is not null)).c")))
def station_dedup(spark, d):
    """One row per place of two decimals and technology."""
    s = stations(spark, d).select("tech", F.round(F.col("lon") + 1e-7, 2).alias("lon2"), F.round(F.col("lat") + 1e-7, 2).alias("lat2"), F.col("activation_year").alias("year"), "capacity_gw")
    return S.deduplicate(s, ["tech", "lon2", "lat2"])


UNION = """u0 as (select tech, round_even(lon, 5) as lon5, round_even(lat, 5) as lat5, scenario, station as row, case scenario when 'ssp126' then 1 when 'ssp245' then 2 else 3 end as o from stations),
u as (select tech, lon5, lat5, row_number() over (order by case tech when 'wind' then 1 else 2 end, min({'o': o, 'row': row}), lon5, lat5) - 1 as union_index from u0 group by 1, 2, 3)"""


def _rows(spark, d):
    return stations(spark, d).withColumn("row", F.col("station"))


@query(sql("stations", body=UNION + "\nselect tech, lon5, lat5, union_index from u"))
def station_union_index(spark, d):
    return S.union_index(_rows(spark, d))


@query(sql("stations", body=UNION + "\nselect u0.scenario, u0.row, u.union_index from u0 join u using (tech, lon5, lat5)"))
def station_maps(spark, d):
    s = _rows(spark, d)
    return S.scenario_map(s, S.union_index(s))


@query(sql("stations", body=f"select station, substr(sha1(scenario || '|' || tech || '|' || printf('%.4f', {wrap_sql('lon')}) || '|' || printf('%.4f', lat)), 1, 20) as id from stations"))
def station_ids(spark, d):
    return S.with_ids(stations(spark, d)).select("station", F.col("computed_id").alias("id"))


@query("with s as (select station_id, scenario, tech, round((((lon + 180) % 360) + 360) % 360 - 180, 4) as lon4, round(lat, 4) as lat4 from station_match) select station_id as id, count(*) as rows, count(distinct {'a': scenario, 'b': tech, 'c': lon4, 'd': lat4}) as places from s group by 1 having count(*) > 1")
def station_id_conflicts(spark, d):
    return S.id_conflicts(table(spark, d, "station_match"))


BOXES = "boxes as (select region, min(lat) as s, max(lat) as n, min((((lon + 180) % 360) + 360) % 360 - 180) as w, max((((lon + 180) % 360) + 360) % 360 - 180) as e from cells group by 1)"


@query(sql("stations", "cells", body=BOXES + "\nselect station, b.region from stations x join boxes b on x.lat > b.s and x.lat < b.n and x.lon > b.w and x.lon < b.e"))
def station_in_polygon(spark, d):
    """Stations strictly inside the outline of each grid."""
    boxes = cells(spark, d).withColumn("lon", F.pmod(F.col("lon") + 180.0, F.lit(360.0)) - 180.0).groupBy("region").agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e"))
    return S.in_polygons(stations(spark, d), S.box_edges(boxes))


@query(sql("stations", body="select station from stations where lat between 46 and 56 and lon between 3 and 16"))
def station_bbox(spark, d):
    return stations(spark, d).filter(S.in_box(F.col("lat"), F.col("lon"), (46, 56, 3, 16))).select("station")


@query(sql("stations", body="select region, station, cast(rank as int) as rank from (select region, station, row_number() over (partition by region order by capacity_gw desc nulls last, station) as rank from stations where region is not null) where rank <= 3"))
def station_topn_per_region(spark, d):
    return S.top_per_group(placed(spark, d), "region", [F.desc_nulls_last("capacity_gw"), "station"], 3).select("region", "station", "rank")


@query("select region, scenario, tech, count(distinct match_id) as n from station_match where region is not null group by 1, 2, 3")
def inventory_counts(spark, d):
    m = table(spark, d, "station_match").filter("region is not null")
    return m.groupBy("region", "scenario", "tech").agg(F.count_distinct("match_id").alias("n"))


@query(sql("stations", body="""a as (select station, tech, lon, lat, 0 as n from stations where scenario <> 'ssp585' and station % 3 <> 0), b as (select station, tech, lon + 1 as lon, lat, 1 as n from stations where scenario <> 'ssp126')
select station, tech, round(lon, 6) as lon, round(lat, 6) as lat from (select * from a union all select * from b) qualify row_number() over (partition by station order by n) = 1"""))
def merge_station_sets(spark, d):
    """Two overlapping lists; the first holds where both have a station, and only common columns stay."""
    s = stations(spark, d)
    a = s.filter("scenario <> 'ssp585' and station % 3 <> 0").select("station", "tech", "lon", "lat", "capacity_gw")
    b = s.filter("scenario <> 'ssp126'").select("station", "tech", (F.col("lon") + 1).alias("lon"), "lat")
    return S.merge_sets([a, b], ["station"]).select("station", "tech", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query(sql("stations", body="select tech, count(*) as n, round(sum(capacity_gw), 6) as capacity_gw, min(activation_year) as first_year from stations group by 1"))
def split_by_tech(spark, d):
    """The list split by technology: size, capacity and first year of each part."""
    s = stations(spark, d)
    part = lambda tech: s.filter(F.col("tech") == tech).groupBy("tech").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("capacity_gw"), 6).alias("capacity_gw"), F.min("activation_year").alias("first_year"))
    return part("wind").unionByName(part("solar"))


@query("select distinct region from grid_cell where region not like '^_%' escape '^' and region not like '%^_x' escape '^' and region not like 'x^_%' escape '^' and region not like '%^_repeated' escape '^' and region <> ''")
def region_discovery(spark, d):
    return readers.regions(table(spark, d, "grid_cell"))


@query("""with w as (select distinct row_id, source, region, scenario, t, var_name, case when isfinite(reading) then reading end as x from weather_bundle where source = 'regional_bcsd' and region is not null),
k as (select source, region, scenario, t, max(x) filter (var_name = 'tas') as tas, max(x) filter (var_name = 'sfcWind') as wind, max(x) filter (var_name = 'hurs') as hurs from w group by 1, 2, 3, 4)
select source, region, scenario, t, round(cast(cast(tas - 273.15::double as float) as double), 3) as temp_c, round(cast(cast(wind as float) as double), 3) as wind_ms, round(cast(cast(case when hurs is not null then least(greatest(hurs, 0), 100) end as float) as double), 3) as rh_pct from k""")
def source_standardise(spark, d):
    """One source's long rows as canonical columns."""
    w = table(spark, d, "weather_bundle").dropDuplicates(["row_id"]).filter("source = 'regional_bcsd' and region is not null")
    out = readers.standardise(w.select("source", "region", "scenario", "t", "var_name", F.col("reading").alias("value")), "regional_bcsd", {"tas": "K", "sfcWind": "m s-1", "hurs": "%"})
    return out.select("source", "region", "scenario", "t", *[F.round(F.col(c).cast("double"), 3).alias(c) for c in ("temp_c", "wind_ms", "rh_pct")])


@query("""with w as (select distinct row_id, source, region, t, reading from weather_bundle where var_name = 'tas' and region is not null),
k as (select region, t, case source when 'era5land_raw' then 0 when 'reanalysis_q' then 1 else 2 end as n, row_id from w), b as (select region, t, min(n) as n from k group by 1, 2)
select k.region, k.t, k.row_id from k join b using (region, t, n)""")
def source_fallback(spark, d):
    """For each region and time the rows of the first source that has any."""
    w = table(spark, d, "weather_bundle").dropDuplicates(["row_id"]).filter("var_name = 'tas' and region is not null").select("region", "t", "row_id", "source")
    own = [w.filter("source = 'era5land_raw'"), w.filter("source = 'reanalysis_q'"), w.filter("source not in ('era5land_raw', 'reanalysis_q')")]
    return readers.prefer(own, ["region", "t"]).select("region", "t", "row_id")


@query("select distinct obs_id, date_trunc('hour', t) as t from weather_hourly")
def time_decode(spark, d):
    """Hours since 1900 brought back to times."""
    x = table(spark, d, "weather_hourly").dropDuplicates(["obs_id"])
    hours = F.timestamp_diff("HOUR", F.lit("1900-01-01").cast("timestamp_ntz"), F.date_trunc("hour", "t").cast("timestamp_ntz"))
    return x.select("obs_id", readers.decode_time(hours.cast("double"), "hours since 1900-01-01").alias("t"))


# thresholds and back-fill

CLIM_CELLS = """v as (select tech, lat_idx, lon_idx, run_day, month_no, hour_no, arg_max(clim, loaded_at) as clim from threshold_clim where clim is not null and not isnan(clim) group by all),
c as (select tech, lat_idx, lon_idx, round(quantile_cont(cast(clim as double), 0.05), 6) as threshold, count(*) as valid_count from v group by 1, 2, 3),
k as (select tech, lat_idx, lon_idx, min({'a': threshold, 'b': valid_count}) as m from threshold_grid where pctl = 5 and threshold is not null and valid_count is not null group by 1, 2, 3)"""
CELL = ["tech", "lat_idx", "lon_idx"]


def _clim(spark, d):
    v = latest(table(spark, d, "threshold_clim"), [*CELL, "run_day", "month_no", "hour_no"], "clim", "loaded_at")
    return v.filter(F.col("clim").isNotNull() & ~F.isnan("clim"))


def _computed(values):
    """5 % thresholds; equal values are counted first, so that a cell comes as its different values."""
    n = values.groupBy(*CELL, F.col("clim").cast("double").alias("clim")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*CELL).agg(F.round(F.percentile("clim", F.lit(0.05), F.col("n")), 6).alias("threshold"), F.sum("n").alias("valid_count"))


def _known(spark, d):
    g = table(spark, d, "threshold_grid").filter("pctl = 5 and threshold is not null and valid_count is not null")
    return g.groupBy(*CELL).agg(F.min(F.struct("threshold", "valid_count")).alias("m")).select(*CELL, F.col("m.threshold").cast("double").alias("threshold"), F.col("m.valid_count").cast("bigint").alias("valid_count"))


@query("with " + CLIM_CELLS + """
select c.tech, c.lat_idx, c.lon_idx, round(case when k.m is null then c.threshold else cast(k.m.a as double) end, 6) as threshold, cast(case when k.m is null then c.valid_count else k.m.b end as bigint) as valid_count, case when k.m is null then 0 else 1 end as reused
from c left join k using (tech, lat_idx, lon_idx)""")
def thr_reuse(spark, d):
    """Recorded 5 % thresholds where there are any, computed ones for the other cells."""
    values, known = _clim(spark, d), _known(spark, d)
    computed = _computed(values.join(known.select(*CELL), CELL, "left_anti"))
    return pipelines.reuse_thresholds(values.select(*CELL), known, computed, CELL).withColumn("threshold", F.round("threshold", 6))


@query("with " + CLIM_CELLS + " select c.tech, c.lat_idx, c.lon_idx from c where not exists (select 1 from k where k.tech = c.tech and k.lat_idx = c.lat_idx and k.lon_idx = c.lon_idx)")
def thr_missing(spark, d):
    return sinks.open_keys(_clim(spark, d).select(*CELL).distinct(), _known(spark, d), CELL)


@query("select distinct tech, lat_idx, lon_idx, pctl from threshold_grid where threshold is null or isnan(threshold) or valid_count is null or valid_count <= 0")
def dq_thresholds(spark, d):
    return pipelines.threshold_faults(table(spark, d, "threshold_grid")).select(*CELL, "pctl").distinct()


@query(sql("obs", body="""s as (select station, t, max(""" + _flag("wind_ms > 18") + """) as high_wind from obs group by 1, 2), n as (select station, t, max(""" + _flag("temp_c > 35") + """) as high_temp from obs where month(t) in (6, 7, 8) group by 1, 2)
select s.station, s.t, s.high_wind, coalesce(n.high_temp, 0) as high_temp from s left join n on n.station = s.station and n.t = s.t"""))
def backfill_signal(spark, d):
    """A second signal, worked out for the summer only, added to a finished table; done twice to the same effect."""
    x = events.with_signals(obs(spark, d), "wind")
    done = x.groupBy("station", "t").agg(F.max("signal_high_wind").alias("high_wind"))
    new = x.filter(F.month("t").isin(6, 7, 8)).groupBy("station", "t").agg(F.max("signal_high_temp").alias("high_temp"))
    out = sinks.backfill(sinks.backfill(done, new, ["station", "t"], "high_temp"), new, ["station", "t"], "high_temp")
    return out.select("station", "t", F.col("high_wind").cast("int").alias("high_wind"), F.col("high_temp").cast("int").alias("high_temp"))


@query("with w as (select distinct station_id, year(t) as year, month(t) as month from weather_hourly), f as (select station_id, year, month from w where month % 2 = 0) select * from w except select * from f")
def skip_existing(spark, d):
    """Station-months left to do when the even months are done."""
    w = table(spark, d, "weather_hourly").select("station_id", F.year("t").cast("bigint").alias("year"), F.month("t").cast("bigint").alias("month")).distinct()
    return sinks.open_keys(w, w.filter("month % 2 = 0"), ["station_id", "year", "month"])


MASKED = """k as (select o.obs_id, o.temp_c, o.wind_ms, o.precip_mmh, o.rh_pct, o.t, s.s.lat as lat, s.s.lon as lon, s.s.y as y from obs o join site s on s.p = substr(o.station, 1, 3))"""


@query(sql("obs", "stations", body="""site as (select substr(station_id, 1, 3) as p, min({'m': station, 'region': region, 'lat': lat, 'lon': lon, 'y': activation_year}) as s from stations where tech = 'solar' and region is not null group by 1),
""" + MASKED + """
select obs_id, """ + ", ".join(f"case when year(t) + 20 >= y then {_flag(CONDITIONS['solar_' + e])} else 0 end as {e}" for e in ("freezing_rain", "rainstorm", "high_humidity", "cold_highwind", "icing")) + " from k"))
def evt_masked(spark, d):
    """Solar events of sites, counted from their activation on (20 years ahead)."""
    rows = events.with_signals(obs(spark, d).drop("dust_aod"), "solar").join(sites(spark, d, "solar"), "station")
    out = events.masked(rows, F.year("t") + 20 >= F.col("activation_year"))
    return out.select("obs_id", *[F.col(f"signal_{e}").cast("int").alias(e) for e in ("freezing_rain", "rainstorm", "high_humidity", "cold_highwind", "icing")])


# the whole pipeline

SITES = """site as (select substr(station_id, 1, 3) as p, min({{'m': station, 'region': region, 'lat': lat, 'lon': lon, 'y': activation_year}}) as s from stations where tech = '{tech}' and region is not null group by 1)"""


def _signals(spark, d, tech, grids):
    columns = {"wind": ("temp_c", "wind_ms", "rh_pct"), "solar": ("temp_c", "wind_ms", "precip_mmh", "rh_pct", "rsds", "dust_aod")}[tech]
    out = pipelines.station_signals(hourly(spark, d, *columns), sites(spark, d, tech), grids, tech, ahead=20)
    return out.select("station", "t", *[F.col(c).cast("int").alias(c[len("signal_"):]) for c in out.columns if c.startswith("signal_")])


@query()
def pipeline_station_signals(spark, d):
    """Wind signals of sites with hourly weather, on regular grids alone, as the SQL has them: match, events, low resource, activation (20 years ahead) and distance masks."""
    return _signals(spark, d, "wind", cells(spark, d).filter("grid_kind = 'regular_latlon'"))


@query()
def pipeline_station_signals_wind(spark, d):
    """Wind signals of sites on all grids."""
    return _signals(spark, d, "wind", cells(spark, d))


@query()
def pipeline_station_signals_solar(spark, d):
    """Solar signals of sites on all grids, with the night mask."""
    return _signals(spark, d, "solar", cells(spark, d))


ORACLES["pipeline_station_signals"] = sql(
    "obs", "stations", "cells",
    body="hourly as (select station, date_trunc('hour', t) as t, round(avg(cast(temp_c as double)), 6) as temp_c, round(avg(cast(wind_ms as double)), 6) as wind_ms, round(avg(cast(rh_pct as double)), 6) as rh_pct from obs group by 1, 2),\n"
    "panel as (select station, t, wind_ms as v from hourly),\n" + ",\n".join(PLAIN) + ",\n" + SITES.format(tech="wind") + ",\n"
    "used as (select h.station, site.s.region as region, site.s.lat as lat, site.s.lon as lon, site.s.y as y from (select distinct station from hourly) h join site on site.p = substr(h.station, 1, 3)),\n"
    + NEAREST.replace("from stations s", "from used s") + ",\nkeep as (select used.station, used.y, coalesce(near.dist_deg <= 0.15, false) as ok from used left join near on near.station = used.station and near.region = used.region)\n"
    "select h.station, h.t, " + ", ".join(f"case when ok and year(h.t) + 20 >= y then {_flag(CONDITIONS['wind_' + e])} else 0 end as {e}" for e in ("icing", "high_temp", "hot_humid", "high_wind"))
    + ", case when ok and year(h.t) + 20 >= y and anom is not null and low then 1 else 0 end as low_resource from hourly h join m on m.station = h.station and m.t = h.t join keep on keep.station = h.station",
)
