"""Operators of the weather domain on literal cases, against NumPy and pandas, and in the awkward cases."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anemora.functions import weather as W
from anemora.operators import events, gridmatch, lowres, stations as S, timeaxis
from anemora.plans import pipelines
from anemora.sources import readers, sinks


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_units(spark):
    L = F.lit
    r = one(spark, W.to_celsius(L(300.0), "K"), W.to_ms(L(36.0), "km/h"), W.to_mmh(L(1e-5), "kg m-2 s-1"), W.to_mmh(L(3.0), "mm", 3), W.to_wm2(L(0.5), "kW m-2"), W.to_wm2(L(3600.0), "J m-2", 3600), W.to_percent(L(0.5), "1"), W.to_percent(L(None).cast("double"), "%"))
    assert list(r)[:7] == pytest.approx([26.85, 10.0, 0.036, 1.0, 500.0, 1.0, 50.0]) and r[7] is None
    for f, u in ((W.to_celsius, "furlong"), (W.to_ms, None), (W.to_mmh, "mm"), (W.to_wm2, "J m-2"), (W.to_percent, "x")):
        with pytest.raises(ValueError):
            f(L(1.0), u)


def test_lon_and_ids(spark):
    L = F.lit
    assert list(one(spark, W.lon_180(L(359.0)), W.lon_180(L(181.0)), W.lon_360(L(-1.0)), W.lon_180(L(180.0)))) == [-1.0, -179.0, 359.0, -180.0]
    ids = one(spark, W.station_id(L("ssp126"), L("wind"), L(10.0), L(49.6)), W.station_id(L("ssp1"), L("wind"), L(10.0), L(49.6)), W.station_id(L("ssp126"), L("wind"), L(10.0), L(95.0)), W.station_id(L("ssp126"), L("wind"), L(370.0), L(49.6)))
    assert list(ids) == ["d9ab5e4db8460f0b4dee", None, None, "d9ab5e4db8460f0b4dee"]


def test_magnus_and_sun(spark):
    rh = one(spark, W.magnus_rh(F.lit(293.15), F.lit(293.15)), W.magnus_rh(F.lit(293.15), F.lit(283.15)), W.magnus_rh(F.lit(280.0), F.lit(300.0)))
    assert list(rh) == pytest.approx([100.0, 52.5, 100.0], abs=0.3)
    noon, night = (one(spark, W.solar_elevation(F.lit(0.0), F.lit(0.0), F.lit(t).cast("timestamp_ntz")))[0] for t in ("2024-03-20 12:07:00", "2024-03-20 00:00:00"))
    assert noon > 88 and night < -80
    assert one(spark, W.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))[0] == pytest.approx(np.pi * W.EARTH_KM)


OBS = "obs_id int, temp_c float, wind_ms float, precip_mmh float, rh_pct float, dust_aod float, event string"


def test_events(spark):
    nan = float("nan")
    rows = [(1, -3.0, 0.0, 0.1, 85.0, 0.4, "x"), (2, nan, nan, nan, nan, nan, "x"), (3, None, None, None, None, None, "x"), (4, 36.0, 17.5, 2.1, 95.0, 0.6, "x"), (5, 4.0, 8.5, 0.0, 10.0, 0.45, "x"), (6, float("inf"), 18.0, 2.0, 94.9, 0.5, "x")]
    df = spark.createDataFrame(rows, OBS)
    wind = {r["obs_id"]: [r[f"signal_{e}"] for e in ("icing", "high_temp", "hot_humid", "high_wind")] for r in events.with_signals(df, "wind").collect()}
    assert wind == {1: [1, 0, 0, 0], 2: [0] * 4, 3: [0] * 4, 4: [0, 1, 1, 0], 5: [0] * 4, 6: [0] * 4}
    sun = {r["obs_id"]: [r[f"signal_{e}"] for e in ("freezing_rain", "dust", "rainstorm", "high_humidity", "cold_highwind", "icing")] for r in events.with_signals(df, "solar").collect()}
    assert sun == {1: [0, 0, 0, 0, 0, 1], 2: [0] * 6, 3: [0] * 6, 4: [0, 1, 1, 1, 0, 0], 5: [0, 0, 0, 0, 1, 0], 6: [0] * 6}  # 0.1 as FLOAT is not above 0.1
    old = {r["obs_id"]: (r["signal_high_wind"], r["signal_dust"]) for r in events.with_signals(events.with_signals(df, "wind", "v1"), "solar", "v1").collect()}
    assert old[4] == (1, 1) and old[5] == (0, 1) and old[1] == (0, 0)
    part = df.drop("rh_pct")
    assert events.skipped(part, "wind") == {"icing": "rh_pct", "hot_humid": "rh_pct"}
    assert "signal_icing" not in events.with_signals(part, "wind").columns
    with pytest.raises(ValueError):
        events.with_signals(part, "wind", require=("icing",))
    assert events.with_signals(df.limit(0), "wind").count() == 0
    long = events.long_signals(events.with_signals(df, "wind"), ["obs_id"])
    assert long.count() == 24 and long.agg(F.sum("flag")).first()[0] == 3


def series(spark, values, station="s"):
    t = datetime(2020, 1, 1)
    return spark.createDataFrame([(station, t + timedelta(hours=n), None if np.isnan(v) else float(v)) for n, v in enumerate(values)], "station string, t timestamp_ntz, v double")


@pytest.mark.parametrize("steps", [3, 8, 24])
def test_rolling_is_pandas(spark, steps):
    x = np.random.default_rng(1).random(200)
    x[[50, 120]] = np.nan
    got = [r["roll"] for r in lowres.rolling(series(spark, x), steps).orderBy("t").collect()]
    want = pd.Series(x).rolling(steps, center=True, min_periods=steps).mean()
    assert np.allclose(np.array(got, float), want, equal_nan=True)


def test_low_resource_by_numpy(spark):
    x = np.random.default_rng(2).gamma(2, 3, 24 * 70)
    x[300:310] = np.nan
    t = pd.date_range("2020-01-01", periods=len(x), freq="h")
    roll = pd.Series(x).rolling(24, center=True, min_periods=24).mean()
    anom = (roll - roll.groupby([t.month, t.hour]).transform("mean")).round(9)
    low = anom <= np.nanpercentile(anom, 5)
    want = ((low | low.shift(fill_value=False)) & anom.notna()).astype(int).tolist()
    both = series(spark, x).unionByName(series(spark, np.full(5, np.nan), "empty"))
    out = lowres.low_resource(both)
    assert [r["low_resource"] for r in out.filter("station = 's'").orderBy("t").collect()] == want
    assert out.filter("station = 'empty' and low_resource = 1").count() == 0 and out.count() == len(x) + 5
    clim, thr = pipelines.precompute_thresholds(series(spark, x))
    assert [r["low_resource"] for r in lowres.low_resource(series(spark, x), clim=clim, thr=thr).orderBy("t").collect()] == want
    assert lowres.low_resource(both.limit(0)).count() == 0
    assert pipelines.precompute_thresholds(series(spark, x), known=thr)[1].count() == 0


def test_window_steps():
    assert [lowres.window_steps(h) for h in (1, 3, 24)] == [24, 8, 1]
    with pytest.raises(ValueError):
        lowres.window_steps(5)


def hours(spark, rows, name="acc"):
    return spark.createDataFrame([("s", datetime(2020, 1, 1) + timedelta(hours=h), v) for h, v in rows], f"station string, t timestamp_ntz, {name} double")


def test_deaccumulate(spark):
    f = lambda rows, **k: [r["v"] for r in timeaxis.deaccumulate(hours(spark, rows), **k).orderBy("t").collect()]
    assert f([(1, 10.0), (2, 20.0), (3, 35.0)]) == [10, 10, 15]
    assert f([(-1, 1.0), (0, 3.0), (1, 8.0)]) == [0, 2, 8]
    assert f([(0, 5.0), (1, 10.0)]) == [0, 10] and f([(0, 5.0), (1, 10.0)], first="nan") == [None, 10] and f([(0, 5.0)], first="current") == [5]
    assert f([(2, 5.0), (3, None), (4, 7.0), (5, 6.0)]) == [0, None, None, 6]
    assert [r["v"] for r in timeaxis.deaccumulate_legacy(hours(spark, [(0, 5.0), (1, 3.0), (2, 7.0)])).orderBy("t").collect()] == [0, 0, 4]
    x = np.random.default_rng(3).random(72)
    acc, total = [], 0.0
    for n, v in enumerate(x):
        total = v if n % 24 == 1 else total + v
        acc.append((n, float(total)))
    assert f(acc)[1:] == pytest.approx(list(x[1:]))


def test_interpolate(spark):
    src = hours(spark, [(0, 0.0), (6, 6.0), (9, None)], "v")
    want = hours(spark, [(-1, 0.0), (0, 0.0), (3, 0.0), (6, 0.0), (8, 0.0)], "v").select("station", "t")
    f = lambda **k: [r["v"] for r in timeaxis.interpolate(src, want, **k).orderBy("t").collect()]
    assert f() == [0, 0, 3, 6, 6] and f(boundary="nan") == [None, None, 3, None, None]
    assert timeaxis.interpolate(src.limit(0), want).filter("v is not null").count() == 0


def test_exact_lookup_and_gaps(spark):
    src = hours(spark, [(0, 1.0), (1, None), (3, 3.0)], "v")
    assert [r["v"] for r in timeaxis.exact_lookup(src, src.select("station", "t")).orderBy("t").collect()] == [1, None, 3]
    with pytest.raises(Exception, match="missing"):
        timeaxis.exact_lookup(src, hours(spark, [(2, 0.0)], "v").select("station", "t")).collect()
    assert [r["gap_hours"] for r in timeaxis.gaps(src).collect()] == [2.0]
    assert timeaxis.step_hours(src).first()["step_hours"] == 1.5


def test_months(spark):
    df = spark.createDataFrame([(datetime(2015, 1, 5),), (datetime(2015, 3, 5),)], "t timestamp_ntz")
    months = timeaxis.month_list(spark, "2015-01", "2015-12")
    assert timeaxis.missing_months(df, months).count() == 10
    assert sorted(map(tuple, timeaxis.chunk_plan(timeaxis.month_list(spark, "2015-01", "2024-12"), 6).collect()))[0] == (0, "2015-01", "2015-06", 6)


def grid(spark, lats, lons, region="g", kind="regular_latlon"):
    return spark.createDataFrame([(region, kind, i, j, float(a), float(b)) for i, a in enumerate(lats) for j, b in enumerate(lons)], "region string, grid_kind string, idx0 int, idx1 int, lat double, lon double")


def at(spark, *places):
    return spark.createDataFrame([(n, "g", a, b) for n, (a, b) in enumerate(places)], "station int, region string, lat double, lon double")


def test_nearest(spark):
    r = gridmatch.nearest_regular(at(spark, (0.0, 179.95), (None, 1.0)), grid(spark, [0], [-179.9, -0.1, 0.1, 179.9])).collect()
    assert [(x["idx1"], x["dist_deg"], x["valid"]) for x in r] == [(3, 0.05, True)]
    r = gridmatch.nearest_regular(at(spark, (4.0, 2.0)), grid(spark, [0, 5], [0, 5])).first()
    assert (r["idx0"], r["idx1"], r["dist_deg"], r["valid"]) == (1, 0, 2.0, False)
    assert gridmatch.nearest_regular(at(spark, (0.5, 0.0)), grid(spark, [0, 1], [0])).first()["idx0"] == 0  # tie
    r = gridmatch.nearest_2d(at(spark, (10.12, 20.01)), grid(spark, [10, 10.2], [20, 20.2], kind="rotated_pole")).first()
    assert (r["idx0"], r["idx1"]) == (1, 0)


def test_bilinear_and_gather(spark):
    g = grid(spark, [1, 0], [10, 11])
    b = gridmatch.bilinear(at(spark, (0.25, 10.25)), g)
    rows = sorted(map(tuple, b.select("corner", "idx0", "idx1", F.round("weight", 9)).collect()))
    assert rows == [(0, 1, 0, 0.5625), (1, 1, 1, 0.1875), (2, 0, 0, 0.1875), (3, 0, 1, 0.0625)]
    cube = lambda last: spark.createDataFrame([("g", 1, 0, 1, 30.0), ("g", 1, 1, 1, last), ("g", 0, 0, 1, 10.0), ("g", 0, 1, 1, 20.0)], "region string, idx0 int, idx1 int, t int, v double")
    assert gridmatch.gather(b, cube(40.0)).first()["v"] == pytest.approx(27.5)
    assert gridmatch.gather(b, cube(None)).first()["v"] == pytest.approx((27.5 - 7.5) / 0.8125)
    assert gridmatch.gather(b, cube(None), how="strict").first()["v"] is None
    edge = gridmatch.bilinear(at(spark, (9.0, 10.5)), g).groupBy().agg(F.sum("weight")).first()[0]
    assert edge == pytest.approx(1.0)


def test_gathers_over_all_months(spark, tmp_path):
    import datetime as dt

    from anemora.queries import places, views

    day = lambda m, d=1: dt.datetime(2015, m, d, 3)
    b = "row_id bigint, source string, region string, scenario string, var_name string, t timestamp_ntz, step_hours double, units string, note string, reading double, reading_text string, received_at timestamp_ntz"
    tas = lambda n, t, unit, x: (n, "s", "g", "h", "tas", t, 1.0, unit, None, x, None, t)
    spark.createDataFrame([tas(1, day(1), "K", 280.0), tas(1, day(1), "K", 280.0), tas(2, day(1, 9), "degC", 10.0), tas(3, day(2), "K", 290.0), tas(4, day(3), "K", None)], b).write.parquet(f"{tmp_path}/weather_bundle.parquet")
    spark.createDataFrame([("s", "tas", None)], "source string, var_name string, units string").write.parquet(f"{tmp_path}/weather_attrs.parquet")
    grid(spark, [40.0, 41.0], [10.0, 11.0]).write.parquet(f"{tmp_path}/grid_cell.parquet")
    s = "match_id bigint, station_id string, scenario string, tech string, activation_year int, capacity_gw double, lon double, lat double, region string"
    spark.createDataFrame([(5, "a", "h", "wind", 2030, 1.0, 11.0, 41.0, "g")], s).write.parquet(f"{tmp_path}/station_match.parquet")
    want = {day(1).replace(hour=0): (280.0 + 283.15) / 2 + 0.75, day(2).replace(hour=0): 290.75, day(3).replace(hour=0): None}
    for name in ("gather_nearest_monthly", "gather_weighted_monthly", "gather_weighted_strict_monthly"):
        got = {r["t"]: r["v"] for r in places.QUERIES[name](spark, str(tmp_path)).collect()}
        assert got == {t: v if v is None else pytest.approx(v) for t, v in want.items()}, name
    assert views.monthly_cube(spark, str(tmp_path)).count() == 3 * 4
    valid = {(r["idx0"], r["idx1"]) for r in places.QUERIES["valid_cell_mask_monthly"](spark, str(tmp_path)).collect()}
    assert valid == {(0, 1), (1, 0), (1, 1)}
    assert [tuple(r) for r in places.QUERIES["match_nearest_valid_monthly"](spark, str(tmp_path)).collect()] == [(5, "g", 1, 1, 0)]


def test_nearest_valid(spark):
    g, s = grid(spark, [0, 1, 2, 3], [0, 1, 2, 3]), at(spark, (3.0, 3.0))
    valid = spark.createDataFrame([("g", 1, 1), ("g", 2, 0)], "region string, idx0 int, idx1 int")
    r = gridmatch.nearest_valid(gridmatch.nearest_regular(s, g), s, g, valid).first()
    assert (r["idx0"], r["idx1"], r["ring"]) == (2, 0, 1)  # next door going round; its ring counts before its distance


def test_nearest_valid_beyond_the_first_rings(spark):
    g, s = grid(spark, range(12), range(20)), at(spark, (2.0, 3.2), (2.0, 9.0), (11.0, 3.0))
    valid = spark.createDataFrame([("g", 2, 16), ("g", 9, 10), ("g", 9, 9)], "region string, idx0 int, idx1 int")
    near = lambda v: {r["station"]: (r["idx0"], r["idx1"], r["ring"]) for r in gridmatch.nearest_valid(gridmatch.nearest_regular(s, g), s, g, v).collect()}
    assert near(valid) == {0: (9, 9, 7), 1: (2, 16, 7), 2: (9, 9, 6)}  # station 1: equally near, the smaller index wins
    assert near(valid.filter("idx0 = 2")) == {0: (2, 16, 7), 1: (2, 16, 7), 2: (2, 16, 9)}
    assert near(valid.limit(0)) == {}


def test_station_signals_on_two_dimensional_grids(spark):
    import datetime as dt

    from anemora.plans import pipelines

    g = grid(spark, [50.0, 50.2], [10.0, 10.2], "r", "rotated_pole").union(grid(spark, [50.0, 50.2], [10.0, 10.2]))
    s = spark.createDataFrame([("a", "r", 50.01, 10.01, 2010), ("b", "r", 50.4, 10.0, 2010), ("c", "g", 50.01, 10.01, 2010)], "station string, region string, lat double, lon double, activation_year int")
    w = spark.createDataFrame([(k, dt.datetime(2015, 7, 1, h), 30.0, 25.0, 50.0) for k in "abc" for h in range(24)], "station string, t timestamp_ntz, temp_c double, wind_ms double, rh_pct double")
    rows = pipelines.station_signals(w, s, g, "wind").groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.sum("signal_high_wind").alias("high")).collect()
    assert {r["station"]: (r["n"], r["high"]) for r in rows} == {"a": (24, 24), "b": (24, 0), "c": (24, 24)}  # b is too far from any cell


def test_stations(spark):
    raw = spark.createDataFrame([("2030", " Wind ", "359", "40", "1.0"), ("x", "wind", "1", "2", "3"), ("2030", "solar", None, "2", "3"), ("2040", "solar", "10", "nan", "3")], "year string, type string, lon string, lat string, capacity_gw string")
    assert [tuple(r) for r in S.parse(raw).collect()] == [(2030, "wind", -1.0, 40.0, 1.0)]
    df = spark.createDataFrame([("a", 2040, 2.0), ("a", 2030, None), ("a", 2030, 5.0), ("b", 2050, None)], "k string, year int, capacity_gw double")
    assert sorted(map(tuple, S.deduplicate(df, ["k"]).collect())) == [("a", 2030, 5.0), ("b", 2050, None)]
    union = spark.createDataFrame([("ssp245", "wind", 116.0, 40.0, 0), ("ssp126", "wind", 116.0, 40.0, 1), ("ssp126", "solar", 116.0, 40.0, 0), ("ssp585", "wind", 1.0, 2.0, 0)], "scenario string, tech string, lon double, lat double, row int")
    u = S.union_index(union)
    assert sorted((r["union_index"], r["tech"]) for r in u.collect()) == [(0, "wind"), (1, "wind"), (2, "solar")]
    maps = {(r["scenario"], r["row"]): r["union_index"] for r in S.scenario_map(union, u).collect()}
    assert maps["ssp245", 0] == maps["ssp126", 1] == 0


def test_polygon_border_is_outside(spark):
    boxes = spark.createDataFrame([("g", 0.0, 2.0, 0.0, 2.0), ("h", 1.0, 3.0, 1.0, 3.0)], "region string, s double, n double, w double, e double")
    s = at(spark, (1.5, 1.5), (0.0, 1.0), (2.0, 2.0), (0.5, 0.5), (None, 1.0), (9.0, 9.0))
    got = {(r["station"], r["region"]) for r in S.in_polygons(s.drop("region"), S.box_edges(boxes)).collect()}
    assert got == {(0, "g"), (0, "h"), (2, "h"), (3, "g")}


def test_sources_and_sinks(spark, tmp_path):
    long = spark.createDataFrame([("p", 1, "tas", 300.0), ("p", 1, "uas", 3.0), ("p", 1, "vas", 4.0), ("p", 2, "tas", float("nan"))], "place string, t int, var_name string, value double")
    r = {x["t"]: x for x in readers.standardise(long, "regional_bcsd", {"tas": "K"}).collect()}
    assert r[1]["temp_c"] == pytest.approx(26.85) and r[1]["wind_ms"] == 5.0 and r[2]["temp_c"] is None and r[1]["rsds"] is None
    with pytest.raises(ValueError):
        readers.standardise(long, "x", {"tas": "?"})
    assert readers.named(spark.createDataFrame([(1, 2.0, 3.0)], "valid_time int, latitude double, tas_bcsd double"), "tas").columns == ["t", "lat", "value"]
    assert str(spark.range(1).select(readers.decode_time(F.lit(36.0), "hours since 2015-01-01")).first()[0]) == "2015-01-02 12:00:00"
    path = str(tmp_path / "out")
    done = spark.createDataFrame([("r", 2020, 1, 1)], "region string, year int, station int, signal_x int")
    sinks.write_signals(done, path)
    sinks.write_signals(done.withColumn("signal_x", F.lit(9)), path, mode="ignore")
    assert spark.read.parquet(path).first()["signal_x"] == 1
    with pytest.raises(Exception, match="exist"):
        sinks.write_signals(done, path)
    assert sinks.open_keys(done, done, ["region"]).count() == 0
    filled = sinks.backfill(done, done.select("station", F.lit(1).alias("low")), ["station"], "low")
    assert sinks.backfill(filled, done.select("station", F.lit(0).alias("low")), ["station"], "low").first()["low"] == 1
    assert readers.existing_path(spark, [str(tmp_path / "no*"), str(tmp_path / "o*")]).endswith("out")


def test_stream_is_batch(spark, tmp_path):
    from anemora.streaming import signals

    rows = spark.createDataFrame([(n, "s", datetime(2020, 1, 1, n % 24), float(n % 40), float(n % 25), 90.0) for n in range(50)], "obs_id int, station_id string, t timestamp_ntz, temp_c double, wind_ms double, rh_pct double")
    src = str(tmp_path / "in")
    rows.unionByName(rows.limit(10)).write.parquet(src)
    q = signals.signals(spark.readStream.schema(rows.schema).parquet(src), "wind").writeStream.format("memory").queryName("sig").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("sig").select("obs_id", "signal_high_wind").exceptAll(events.with_signals(rows, "wind").select("obs_id", "signal_high_wind"))
    assert spark.table("sig").count() == 50 and got.count() == 0
