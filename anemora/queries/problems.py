"""Queries of the data-preparation operators that are not tagged llm (problems 1, 2, 3 and 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemora.functions import unit_text as U
from anemora.operators import compaction, region_match, spikes, unit_model
from anemora.session import scratch, table


def p1_found(spark, d):
    return region_match.nearest_in_regions(table(spark, d, "station_match"), table(spark, d, "grid_cell")).select("match_id", "region", "idx0", "idx1")


def p1_distances(spark, d):
    """p1_found with the distance."""
    out = region_match.nearest_in_regions(table(spark, d, "station_match"), table(spark, d, "grid_cell"))
    return out.select("match_id", "region", "idx0", "idx1", F.round("dist_deg", 6).alias("dist_deg"))


def p2_found(spark, d):
    return compaction.compact_caches(table(spark, d, "station_cf_cache")).select("file_id", "line_no")


def p2_compacted_files(spark, d):
    """The table of files, laid out as very many small files and brought back to few without loss."""
    many, few = scratch(spark, "many"), scratch(spark, "few")
    table(spark, d, "station_cf_cache").repartition(64, "file_id").write.parquet(many)
    return compaction.compact_files(spark, many, few).select("file_id", "path", "n_bytes")


def p3_found(spark, d):
    return unit_model.restated(unit_model.convert_units(table(spark, d, "weather_bundle"), table(spark, d, "weather_attrs")))


def p3_unstated(spark, d):
    """What the classifier makes of the readings whose unit nobody stated: converted, or routed to review."""
    done = unit_model.convert_units(table(spark, d, "weather_bundle"), table(spark, d, "weather_attrs"))
    return done.filter(F.col("unit_source") == "classifier").select("row_id", "var_name", "code", "factor", "confidence", "route", "canonical")


def p3_held_out(spark, d):
    """Accuracy, coverage and calibration of the classifier on stated units that were hidden from it."""
    return unit_model.held_out(table(spark, d, "weather_bundle"), table(spark, d, "weather_attrs"))


def p5_found(spark, d):
    return spikes.found(table(spark, d, "weather_hourly"))


def p5_reasons(spark, d):
    """Every flag with its reason."""
    return spikes.flagged(table(spark, d, "weather_hourly")).select("obs_id", "var_name", "reason")


def p5_coverage(spark, d):
    """By variable: readings, those that the wavelet details leave over, those above their limit and how many of these are among them."""
    return spikes.coverage(table(spark, d, "weather_hourly"))


QUERIES = {f.__name__: f for f in (p1_found, p1_distances, p2_found, p2_compacted_files, p3_found, p3_unstated, p3_held_out, p5_found, p5_reasons, p5_coverage)}

GAP = "abs((((({a}) - ({b}) + 180) % 360) + 360) % 360 - 180)"
LON_GAP = GAP.format(a="lo.lon", b="s.lon")
CELL_GAP = GAP.format(a="g.lon", b="s.lon")

P1_SQL = f"""
with s as (
  select match_id, min(lat) as lat, min(lon) as lon from (select distinct match_id, lat, lon from station_match where lat between -90 and 90 and lon between -540 and 540)
  group by match_id),
g as (select distinct region, grid_kind, idx0, idx1, lat, lon from grid_cell),
la as (select region, idx0, min(lat) as lat from g where grid_kind = 'regular_latlon' group by region, idx0),
lo as (select region, idx1, min(lon) as lon from g where grid_kind = 'regular_latlon' group by region, idx1),
a as (select match_id, region, arg_min(idx0, abs(la.lat - s.lat)) as idx0, min(abs(la.lat - s.lat)) as d0
  from s join la on la.lat between s.lat - 0.21 and s.lat + 0.21 group by match_id, region),
b as (select match_id, region, arg_min(idx1, {LON_GAP}) as idx1, min({LON_GAP}) as d1
  from s join lo on {LON_GAP} <= 0.21 group by match_id, region),
r as (select match_id, region, arg_min(idx0, d) as idx0, arg_min(idx1, d) as idx1, min(d) as d from (
    select match_id, region, idx0, idx1, sqrt((g.lat - s.lat) * (g.lat - s.lat) + {CELL_GAP} * {CELL_GAP}) as d
    from s join g on g.grid_kind = 'rotated_pole' and g.lat between s.lat - 0.21 and s.lat + 0.21 and {CELL_GAP} <= 0.21) group by match_id, region)

"""
P1_DISTANCES = P1_SQL + """select match_id, region, idx0, idx1, round(greatest(d0, d1), 6) as dist_deg from a join b using (match_id, region) where round(greatest(d0, d1), 9) <= 0.2
union all select match_id, region, idx0, idx1, round(d, 6) from r where round(d, 9) <= 0.2
"""
P1_SQL += """select match_id, region, idx0, idx1 from a join b using (match_id, region) where round(greatest(d0, d1), 9) <= 0.2
union all select match_id, region, idx0, idx1 from r where round(d, 9) <= 0.2
"""

P2_SQL = f"""
with a as (
  select file_id, written_at, body, regexp_replace(lower(trim(replace(url_decode(trim(path)), chr(92), '/'))), '^[a-z][a-z0-9+.-]+:/*', '/') as p from station_cf_cache),
b as (select * replace (regexp_replace(regexp_replace('/' || p, '/(\\./)+', '/', 'g'), '/+', '/', 'g') as p) from a),
c as (select * replace (regexp_replace(regexp_replace(p, '/[^/]+/\\.\\./', '/'), '/[^/]+/\\.\\./', '/') as p) from b),
d as (select file_id, written_at, body, p, regexp_extract(p, '{compaction.CACHE_DIR}', ['scenario', 'tech', 'years', 'interpolation']) as cache from c where not regexp_matches(p, '{compaction.UNFINISHED}')),
e as (select file_id, written_at, cache, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) as line_no from d where cache.scenario <> ''),
f as (select *, regexp_split_to_array(regexp_replace(line, '\\r$', ''), '[;,]') as f from e),
g as (select file_id, line_no, written_at, cache, try_cast(trim(f[1]) as bigint) as station, trim(f[2]) as t from f where len(f) = 3 and regexp_matches(trim(f[1]), '^[+-]?[0-9]+$')),
h as (select *, case when regexp_matches(t, '^-?[0-9]{{1,15}}$') then cast(floor(try_cast(t as bigint) / 3600) as bigint)
  when regexp_matches(t, '^[0-9]{{4}}-[0-9][0-9]-[0-9][0-9][T ][0-9][0-9](:?[0-9][0-9]){{0,2}}(\\.[0-9]+)?Z?$') then date_diff('day', date '1970-01-01', try_cast(t[1:10] as date)) * 24 + try_cast(t[12:13] as int) end as hour from g)
select file_id, cast(line_no as int) as line_no from h where station is not null and hour is not null
qualify row_number() over (partition by cache, station, hour order by written_at desc nulls last, file_id desc, line_no desc) = 1
"""

def _literal(x) -> str:
    return "'" + str(x).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(x) if isinstance(x, str) else repr(float(x)) + "::double" for x in r) + ")" for r in rows)


#: Rows with a stated unit, read by the same tables of spellings; what the classifier decides (no row of the given tables) is not in it.
P3_SQL = f"""
with w as (
  select row_id, arg_max({{'source': source, 'v': var_name, 'h': step_hours, 'u': units, 'n': note, 'x': reading, 't': reading_text}}, received_at) as m from weather_bundle where var_name in ('tas', 'pr') and row_id is not null group by 1),
a as (select source, var_name, max(units) as units from weather_attrs group by 1, 2),
r as (select row_id, m.v as var, m.h as step, m.u as units, m.x as reading, translate(m.t, chr(160) || '−', ' -') as t, split_part(translate(m.n, chr(160), ' '), ';', 1) as note, a.units as attrs from w left join a on a.source = m.source and a.var_name = m.v),
v as (select *, coalesce(trim(t), '') <> '' as filled, case when coalesce(trim(t), '') <> '' then try_cast(nullif(regexp_extract(replace(trim(t), ',', '.'), '^([+-]?[0-9]+(?:[.][0-9]+)?(?:[eE][+-]?[0-9]+)?)', 1), '') as double) when not isnan(reading) then reading end as value from r),
texts as (
  select row_id, var, 1 as k, regexp_extract(t, '^[[:space:]]*[+-]?[0-9]+(?:[.,][0-9]+)?(?:[eE][+-]?[0-9]+)?[[:space:]]*(.*?)[[:space:]]*$', 1) as text, true as strict from v where filled
  union all select row_id, var, 2, units, true from v union all select row_id, var, 3, regexp_extract(note, {_literal("(?i)(" + "|".join(U._PHRASES) + ")")}, 1), false from v union all select row_id, var, 4, attrs, false from v),
n0 as (select *, replace(replace(lower(translate(text, '⁻⁰¹²³−·×' || chr(160) || '_,', '-0123- x   ')), '**', ''), '^-', '-') as b from texts where text is not null),
n as (select *, trim(regexp_replace(regexp_replace(regexp_replace(b, '^[[:space:]]*in[[:space:]]+([0-9]|1/|kelvin|degree|celsius|fahrenheit|hundredth|tenth|mm\\b|milli|centi|metre)', '\\1'), '[][()]', ' ', 'g'), '[[:space:]]+', ' ', 'g')) as b2 from n0),
p as (select row_id, var, k, text, strict,
  case when regexp_matches(b2, '^(tenth|hundredth|thousandth)s? of(?: an?)? .+$') then {{'bare': regexp_extract(b2, '^(?:tenth|hundredth|thousandth)s? of(?: an?)? (.+)$', 1), 'f': case regexp_extract(b2, '^(tenth|hundredth|thousandth)', 1) when 'tenth' then 0.1::double when 'hundredth' then 0.01::double else 0.001::double end}}
  when regexp_matches(b2, '^(?:x )?([0-9]+(?:[.][0-9]+)?)(?:/([0-9]+))? (?:x )?([^0-9].*)$') then {{'bare': regexp_extract(b2, '^(?:x )?[0-9]+(?:[.][0-9]+)?(?:/[0-9]+)? (?:x )?([^0-9].*)$', 1),
    'f': try_cast(regexp_extract(b2, '^(?:x )?([0-9]+(?:[.][0-9]+)?)', 1) as double) / coalesce(try_cast(nullif(regexp_extract(b2, '^(?:x )?[0-9]+(?:[.][0-9]+)?/([0-9]+)', 1), '') as double), 1)}}
  when regexp_matches(b2, '^(k|c|f|°[cf]|℃|deg ?[kcf]|kelvin|celsius|fahrenheit) ?/ ?[0-9]+$') then {{'bare': regexp_extract(b2, '^(k|c|f|°[cf]|℃|deg ?[kcf]|kelvin|celsius|fahrenheit)', 1), 'f': 1.0::double / try_cast(regexp_extract(b2, '([0-9]+)$', 1) as double)}}
  when b2 in ('dk', 'ck', 'mk') then {{'bare': 'k', 'f': case b2 when 'dk' then 0.1::double when 'ck' then 0.01::double else 0.001::double end}} else {{'bare': b2, 'f': 1.0::double}} end as p from n),
spelled(var, bare, code) as (values {_values([(v, x, code) for v, t in (("tas", U.TEMPERATURE), ("pr", U.PRECIPITATION)) for code, xs in t.items() for x in xs])}),
u as (select p.row_id, p.k, p.strict, p.text, s.code, p.p.f as factor from p left join spelled s on s.var = p.var and s.bare = p.p.bare and p.p.f > 0 and p.text <> ''),
o as (select row_id, min({{'k': k, 'code': code, 'factor': factor}}) as m from u where code is not null or (strict and trim(lower(text)) not in ({", ".join(map(_literal, U.NO_UNIT))})) group by 1),
size(code, a, b) as (values {_values([(c, *x) for c, x in U.TO_KELVIN.items()] + [(c, x, 0.0) for c, x in {**U.RATE_MMH, **U.AMOUNT_MM}.items()])}),
c as (select v.row_id, o.m.code as code, o.m.factor as factor, case when o.m.code in ('mm', 'cm', 'm', 'in') then v.value * o.m.factor * s.a / (case when v.step > 0 then v.step end) else v.value * o.m.factor * s.a + s.b end as y from v join o on o.row_id = v.row_id join size s on s.code = o.m.code)
select row_id, cast(round(y * 1000) as bigint) as value_milli from c where y is not null and not (factor = 1 and code in ('K', 'mm/h'))
"""

P5_PARTS = """
with h as (
  select obs_id, station_id, t, arg_max({'i': irradiance_wm2, 'p': precip_mmh}, received_at) as v from weather_hourly group by obs_id, station_id, t),
x as (
  select obs_id, station_id, t, 'irradiance_wm2' as var_name, cast(hour(t) as int) as hour, v.i as x from h
  union all select obs_id, station_id, t, 'precip_mmh', -1, v.p from h),
y as (select * from x where x is not null and not isnan(x)),
m as (select station_id, var_name, hour, case when var_name = 'precip_mmh' then 15 * median(x) else 200 + 2 * median(x) end as cap
  from y where var_name = 'irradiance_wm2' or x > 0 group by station_id, var_name, hour),
a as (select *, case when x = lag(x) over (partition by station_id, var_name order by t, obs_id) then 0 else 1 end as turn from y),
b as (select *, sum(turn) over (partition by station_id, var_name order by t, obs_id) as run from a),
c as (select *, count(*) over (partition by station_id, var_name, run) as n from b),
f as (select obs_id, var_name, 'impossible' as reason from y where case when var_name = 'precip_mmh' then x < 0 or x > 300 else x < -5 or x > 1361 end
  union all select obs_id, var_name, 'far_out' from y join m using (station_id, var_name, hour) where x > cap
  union all select obs_id, var_name, 'stuck' from c where n >= 8 and x > 0)
"""
P5_SQL = P5_PARTS + "select distinct obs_id, var_name from f"

ORACLES = {"p1_found": P1_SQL, "p1_distances": P1_DISTANCES, "p2_found": P2_SQL, "p3_found": P3_SQL, "p2_compacted_files": "select file_id, path, n_bytes from station_cf_cache", "p5_found": P5_SQL, "p5_reasons": P5_PARTS + "select obs_id, var_name, reason from f"}
