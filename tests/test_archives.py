"""Archive layouts, grids, station identity, writers: small fixtures."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anemora.functions import weather as W
from anemora.operators import gridmatch, stations as S, timeaxis
from anemora.plans import pipelines
from anemora.sources import adapters, readers, sinks

T = datetime(2019, 12, 31, 22)
LONG = "place string, t timestamp_ntz, var_name string, value double"


def long(spark, **series):
    """Hourly series; an entry may be (value, minutes past)."""
    rows = [("a", T + timedelta(hours=k), v, float(x)) for v, xs in series.items() for k, x in enumerate(xs) if x is not None]
    return spark.createDataFrame(rows, LONG)


def test_era5land_with_dew_point_and_carry_over_the_month(spark):
    x = long(spark, t2m=[280, 281, 282, 283, 284], u10=[3] * 5, v10=[4] * 5, d2m=[280, 280, 280, 280, 280], tp=[0.010, 0.012, 0.015, 0.001, 0.004], ssrd=[0, 0, 0, 3600, 10800])
    out = adapters.assemble(x, adapters.LAYOUTS["era5land_raw"], "wind").orderBy("t").collect()
    # hour 22 is the first step: missing; hour 0 belongs to the day before; at hour 1 the sum begins anew
    assert [r["precip_mmh"] and round(r["precip_mmh"], 4) for r in out] == [None, 2.0, 3.0, 1.0, 3.0]
    assert [r["rsds"] for r in out][3:] == [1.0, 2.0] and out[0]["wind_ms"] == 5.0 and out[0]["rh_pct"] == pytest.approx(100.0)
    assert round(out[0]["temp_c"], 3) == 6.85
    year = adapters.assemble(x, adapters.LAYOUTS["era5land_raw"], "wind", years=(2020, 2020), first="current").orderBy("t").collect()
    assert [round(r["precip_mmh"], 4) for r in year] == [15.0, 1.0, 3.0]


def test_regional_axes(spark):
    x = long(spark, rsds=[1, 2, 3], tas=[280, None, 284], uas=[3, 3, 3], vas=[4, 4, 4], pr=[0.001, 0.002, 0.003], hurs=[None, 50, None])
    out = adapters.assemble(x, adapters.LAYOUTS["regional_bcsd"], "solar", {"tas": "K", "rsds": "W m-2"}).orderBy("t").collect()
    assert [round(r["temp_c"], 2) for r in out] == [6.85, 8.85, 10.85] and [r["rh_pct"] for r in out] == [50.0] * 3
    assert [round(r["precip_mmh"], 3) for r in out] == [3.6, 7.2, 10.8]
    lacking = x.filter("not (var_name = 'pr' and value = 0.002)")
    with pytest.raises(PySparkException):
        adapters.assemble(lacking, adapters.LAYOUTS["regional_bcsd"], "solar", {"tas": "K"}).collect()
    extra = x.unionByName(x.filter("var_name = 'pr'").limit(1).withColumn("t", F.lit("2020-05-05 00:00:00").cast("timestamp_ntz")))
    with pytest.raises(PySparkException):
        adapters.assemble(extra, adapters.LAYOUTS["regional_bcsd"], "solar", {"tas": "K"}).collect()
    some = adapters.assemble(lacking, adapters.LAYOUTS["regional_bcsd"], "solar", {"tas": "K"}, exact="null").orderBy("t").collect()
    assert [r["precip_mmh"] is None for r in some] == [False, True, False]
    with pytest.raises(ValueError, match="vas"):
        adapters.assemble(x.filter("var_name <> 'vas'"), adapters.LAYOUTS["regional_bcsd"], "wind")
    assert adapters.assemble(x.filter("var_name in ('uas', 'vas')"), adapters.LAYOUTS["regional_bcsd"], "wind").filter("rh_pct is null and temp_c is null").count() == 3


def test_china_and_cordex(spark):
    x = long(spark, sfcWind=[3, 4], rsds=[1, 2], tas=[280, 281], pr=[1, 2])
    out = adapters.assemble(x, adapters.LAYOUTS["china_cmfd_bcsd"], "solar", {"pr": "mm h-1"}).orderBy("t").collect()
    assert [(r["wind_ms"], r["precip_mmh"]) for r in out] == [(3.0, 1.0), (4.0, 2.0)]
    with pytest.raises(ValueError, match="unit"):
        adapters.assemble(x, adapters.LAYOUTS["china_cmfd_bcsd"], "solar")
    y = long(spark, uas=[3, 0], vas=[4, 2], tas=[280, 281])
    assert [r["wind_ms"] for r in adapters.assemble(y, adapters.LAYOUTS["cordex_nam12"], "wind").orderBy("t").collect()] == [5.0, 2.0]


def test_common_cells_faults(spark):
    grid = lambda rows: spark.createDataFrame(rows, "region string, idx0 int, idx1 int, lat double, lon double")
    a = grid([("r", i, j, 50.0 + i, 10.0 + j) for i in range(3) for j in range(3)])
    b = grid([("r", i, j, 51.0 + i + 5e-7, 10.0 + j) for i in range(3) for j in range(2)])
    assert sorted(map(tuple, adapters.common_cells({"a": a, "b": b}).collect())) == [("r", i + 1, j, i, j) for i in range(2) for j in range(2)]
    with pytest.raises(ValueError, match="share no cell"):
        adapters.common_cells({"a": a, "b": grid([("r", 0, 0, 0.0, 0.0)])}).collect()
    with pytest.raises(ValueError, match="several"):
        adapters.common_cells({"a": a, "b": b.unionByName(grid([("r", 9, 9, 51.0, 10.0)]))}).collect()


def test_nearest_2d_own_always_answers(spark):
    cells = spark.createDataFrame([("r", "rotated_pole", i, j, 50 + i * 0.1, 10 + j * 0.1 + i * 0.01) for i in range(4) for j in range(4)], "region string, grid_kind string, idx0 int, idx1 int, lat double, lon double")
    places = spark.createDataFrame([(1, "r", 50.01, 10.0), (2, "r", 52.0, 10.0), (3, "r", -80.0, -170.0), (4, "q", 50.0, 10.0), (5, "r", None, 1.0)], "station int, region string, lat double, lon double")
    got = {r["station"]: (r["idx0"], r["idx1"], r["valid"]) for r in gridmatch.nearest_2d_own(places, cells).collect()}
    assert got == {1: (0, 0, True), 2: (3, 0, False), 3: (0, 0, False)}
    with pytest.raises(PySparkException, match="regular grid"):
        gridmatch.bilinear(places, cells.withColumn("grid_kind", F.lit("rotated_pole")).unionByName(cells.withColumn("grid_kind", F.lit("regular_latlon")))).collect()


def test_ids(spark):
    rows = [0.00005, -0.00005, 12.34565, 47.82375, -0.05465, 179.99995, 0.03125, 1.00005, -33.00015, 0.0, 123.456749999999]
    got = [r["x"] for r in spark.createDataFrame([(x,) for x in rows], "x double").select(W.fixed4(F.col("x")).alias("x")).collect()]
    assert got == [f"{x:.4f}" for x in rows]


def test_humidity_guard(spark):
    x = spark.createDataFrame([(0.5,), (100.5,), (-0.5,), (None,)], "x double")
    assert [r[0] for r in x.select(W.to_percent(F.col("x"), "%")).collect()] == [0.5, 100.0, 0.0, None]
    with pytest.raises(PySparkException, match="out of range"):
        spark.createDataFrame([(500.0,)], "x double").select(W.to_percent(F.col("x"), "%")).collect()


def test_legacy_list_and_names(spark):
    raw = spark.createDataFrame([(" Wind ", "\ufeff190", "50", "DE", "x"), ("solar", "10", "50", "FR", "2"), ("wind", None, "1", "DE", "1")], ["Tech", "\ufefflon ", "Y", "Nation", "Cap_GW"])
    assert list(map(tuple, S.parse_legacy(raw).select("type", "lon", "lat", "country", "capacity_gw", "year").collect())) == [("wind", -170.0, 50.0, "DE", None, None), ("solar", 10.0, 50.0, "FR", 2.0, None)]
    assert S.parse_legacy(raw, "solar", ("DE",)).count() == 0
    names = spark.createDataFrame([("Stations_SSP245_v2.csv", "Côte d'Ivoire")], "a string, b string")
    assert tuple(names.select(S.scenario_of(F.col("a")), S.safe_name(F.col("b"))).first()) == ("ssp245", "Cote_d_Ivoire")
    with pytest.raises(PySparkException, match="no scenario"):
        names.select(S.scenario_of(F.col("b"))).collect()
    years = spark.createDataFrame([("tas_hourly_2031.nc",), ("x/tas_NAM-12_203101010000.nc",), ("none.nc",)], "a string")
    assert [r[0] for r in years.select(readers.year_of(F.col("a"))).collect()] == [2031, 2031, None]


def test_months_required(spark):
    df = spark.createDataFrame([(datetime(2020, m, 1),) for m in (1, 2, 4)], "t timestamp_ntz")
    timeaxis.require_months(df, timeaxis.month_list(spark, "2020-01", "2020-02"))
    with pytest.raises(ValueError, match="2020-03"):
        timeaxis.require_months(df, timeaxis.month_list(spark, "2020-01", "2020-06"))


def test_filled_is_aligned(spark):
    df = spark.createDataFrame([("a", datetime(2020, 1, 1, h), v) for h, v in ((0, 1.0), (1, None), (5, 2.0))] + [("b", datetime(2020, 1, 1), 3.0)], "station string, t timestamp_ntz, v double")
    key = lambda x: (x[0], x[1])
    assert sorted(map(tuple, timeaxis.filled(df).collect()), key=key) == sorted(map(tuple, timeaxis.align(df, timeaxis.hourly_axis(df)).select("station", "t", "v").collect()), key=key)


def test_replaced_table(spark, tmp_path):
    at = str(tmp_path / "table")
    sinks.replace_table(spark.range(3), at)
    sinks.replace_table(sinks.current_table(spark, at).filter("id > 0"), at)
    assert sorted(r[0] for r in sinks.current_table(spark, at).collect()) == [1, 2]
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("v-")]) == 2


def test_two_tables_of_signals(spark, tmp_path):
    signals = spark.createDataFrame([(1, datetime(2020, 1, 1), 1), (1, datetime(2021, 1, 1), 0)], "station int, t timestamp_ntz, signal_icing int")
    sites = spark.createDataFrame([(1, "id", 50.0, 10.0)], "station int, station_id string, lat double, lon double")
    at = str(tmp_path / "out")
    sinks.write_station_signals(signals, sites, at)
    assert spark.read.parquet(f"{at}/signals").filter("year = 2020").select("signal_icing").dtypes == [("signal_icing", "tinyint")]
    assert spark.read.parquet(f"{at}/stations").count() == 1
    for bad in (sites.limit(0), sites.unionByName(sites)):
        with pytest.raises(ValueError):
            sinks.write_station_signals(signals, bad, str(tmp_path / "other"))
    clim = spark.createDataFrame([(1, 1, 0, 0.5)], "station int, month int, hour int, clim double")
    sinks.write_thresholds(clim, spark.createDataFrame([(1, -0.2, 9)], "station int, threshold double, valid_count bigint"), at + "/t")
    assert spark.read.parquet(at + "/t/thr").dtypes == [("station", "int"), ("threshold", "float"), ("valid_count", "int")]


def test_bridge_faults(spark):
    rows = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 0.5)], "station int, weight double")
    assert [r["station"] for r in pipelines.bridge_faults(rows).collect()] == [2]


def test_layouts(spark, tmp_path):
    root = tmp_path / "bcsd"
    for name in ("tas_3h_bcsd_on_0p1deg_R_M_ssp245_2015.parquet", "tas_old_R_M_ssp245_x.parquet", "hurs_any_ssp245_z.parquet"):
        at = root / "M" / "R" / "M" / name
        v = name.split("_")[0]
        spark.createDataFrame([(datetime(2020, 1, 1), 1.0, 2.0, float(len(name)))], f"valid_time timestamp_ntz, latitude double, longitude double, {v}_bcsd double").write.parquet(str(at))
    spark.createDataFrame([(datetime(2020, 1, 1), 1.0, 2.0, 9.0)], "time timestamp_ntz, lat double, lon double, d2m double").write.parquet(str(tmp_path / "other" / "M" / "R" / "M" / "d2m_q_ssp245.parquet"))
    names = dict(model="M", region="R", scenario="ssp245")
    rows = readers.variable_rows(spark, {None: str(root), "d2m": str(tmp_path / "other")}, "regional_bcsd", ["tas", "hurs", "d2m"], **names)
    assert sorted(map(tuple, rows.select("lat", "lon", "var_name", "value").collect())) == [(1.0, 2.0, "d2m", 9.0), (1.0, 2.0, "hurs", 25.0), (1.0, 2.0, "tas", 45.0)]
    with pytest.raises(FileNotFoundError):
        readers.variable_rows(spark, {None: str(root)}, "regional_bcsd", ["pr"], **names)
    assert readers.layout_paths("/r", "era5land_raw", var="tp", year=2020, month=3) == ["/r/ERA5_land/global/tp/tp_2020_03*"]
    assert len(readers.layout_paths("/r", "capacity_factor", model="M", region="R", tech="wind", scenario="s", years="2015-2060")) == 4


def test_polygons_from_geojson(spark, tmp_path):
    import json

    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    feature = lambda name, kind, c: {"type": "Feature", "properties": {"NAME": name} if name else {}, "geometry": {"type": kind, "coordinates": c}}
    features = [feature("A", "Polygon", [square, hole]), feature("B", "MultiPolygon", [[[[x + 10, y] for x, y in square]], [[[x + 20, y] for x, y in square]]]), feature("C", "Point", [0, 0]), feature(None, "Polygon", [square])]
    (tmp_path / "x.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    edges = readers.polygon_edges(spark, str(tmp_path / "x.json"))
    assert edges.groupBy("region").count().orderBy("region").collect() == [("A", 8), ("B", 8)]
    places = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 2.0, 23.0), (4, 2.0, 14.0), (5, 2.0, 9.0), (6, None, 1.0), (7, 0.0, 2.0)], "station int, lat double, lon double")
    assert sorted(map(tuple, S.in_polygons(places, edges).collect())) == [(1, "A"), (3, "B")]


def test_weather_written_and_read(spark, tmp_path):
    at = str(tmp_path / "w")
    x = spark.createDataFrame([(1, datetime(2020, 1, 1), 20.5, 2000.0)], "station int, t timestamp_ntz, temp_c double, rsds double")
    sinks.write_weather(x, at, ["station"])
    r = readers.station_weather(spark, at).first()
    assert (r["temp_c"], r["rsds"], r["wind_ms"]) == (20.5, 0.0, None)


def test_places_off_the_grid(spark):
    """Beyond a grid's west border the circle is closed from its east border; grids may count longitudes to 360."""
    cells = spark.createDataFrame([("r", "regular_latlon", i, j, 10.0 + i, 300.0 + j * 0.5) for i in range(3) for j in range(20)], "region string, grid_kind string, idx0 int, idx1 int, lat double, lon double")
    rows = [(1, "r", 10.6, -63.0), (2, "r", 9.0, 311.0), (3, "r", 13.0, -55.26), (4, "r", 11.25, 119.0), (5, "r", 11.25, 125.0)]
    places = spark.createDataFrame(rows, "station int, region string, lat double, lon double")
    got = {(r["station"], r["corner"]): (r["idx0"], r["idx1"], round(r["weight"], 6)) for r in gridmatch.bilinear(places, cells).collect()}
    west = round((-63.0 + 360 - 309.5 + 360) % 360 / (360 - 9.5), 6)
    assert (got[1, 0][:2], got[1, 1][:2]) == ((0, 19), (0, 0)) and got[1, 1][2] == round(0.4 * west, 6)
    assert got[2, 0][:2] == (0, 19) and got[2, 2][2] == 0 and got[3, 0][:2] == got[3, 2][:2] == (2, 9)
    near = {r["station"]: (r["idx0"], r["idx1"]) for r in gridmatch.nearest_regular(places, cells).collect()}
    assert near == {1: (1, 0), 2: (0, 19), 3: (2, 9), 4: near[4], 5: near[5]}
    for k, lon in ((4, 119.0), (5, 125.0)):
        gap = lambda j, lon=lon: abs((300 + j * 0.5 - lon + 180) % 360 - 180)
        assert near[k][1] == min(range(20), key=lambda j: (round(gap(j), 9), j))
