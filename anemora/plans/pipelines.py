"""The pipelines that the operators make up: thresholds of a baseline, station signals, back-fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions.weather import solar_elevation
from anemora.operators import events, gridmatch, lowres


def precompute_thresholds(series: DataFrame, station: str = "station", steps: int = 24, baseline: tuple[int, int] | None = None, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(climatology, thresholds) of every station; stations in `known` are left out, their thresholds hold already."""
    if known is not None:
        series = series.join(known.select(station).distinct(), station, "left_anti")
    rolled = lowres.rolling(series, steps, station=station)
    clim = lowres.climatology(rolled, station, baseline)
    anoms = lowres.own_anomalies(rolled, station, baseline)
    if baseline:
        anoms = anoms.filter(F.year("t").between(*baseline))
    return clim, lowres.thresholds(anoms, station)


def reuse_thresholds(wanted: DataFrame, known: DataFrame, computed: DataFrame, key: list[str]) -> DataFrame:
    """Thresholds of wanted keys: known ones as they are, the others from computed; `reused` tells which.

    computed need hold the keys only that known lacks, so that nothing is worked out in vain.
    """
    cols = [*key, "threshold", "valid_count"]
    hit = known.select(*cols).join(wanted.select(*key), key, "left_semi").withColumn("reused", F.lit(1))
    miss = computed.select(*cols).join(known.select(*key), key, "left_anti").join(wanted.select(*key), key, "left_semi").withColumn("reused", F.lit(0))
    return hit.unionByName(miss)


def threshold_faults(thr: DataFrame) -> DataFrame:
    """Thresholds that must not be used: missing or infinite, or without valid count."""
    bad = F.col("threshold").isNull() | F.isnan("threshold") | F.coalesce(F.col("valid_count") <= 0, F.lit(True))
    return thr.filter(bad)


def compatibility_faults(thr: DataFrame, place: list[str], kind: str, kinds: int) -> DataFrame:
    """(place, kind, fault) of a threshold table before it is used again: missing, uncounted, doubled (two rows of one key) and, without kind, incomplete places."""
    fault = lambda df, name: df.select(*place, kind, F.lit(name).alias("fault"))
    counted = thr.groupBy(*place, kind).agg(F.count(F.lit(1)).alias("n"))
    short = counted.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < kinds).withColumn(kind, F.lit(None).cast(dict(thr.dtypes)[kind]))
    missing = thr.filter(F.col("threshold").isNull() | F.isnan("threshold"))
    uncounted = thr.filter(F.coalesce(F.col("valid_count") <= 0, F.lit(True)))
    return fault(missing, "missing").unionByName(fault(uncounted, "uncounted")).unionByName(fault(counted.filter("n > 1"), "doubled")).unionByName(fault(short, "incomplete"))


def bridge_faults(bridge: DataFrame, key: str = "station", tolerance: float = 1e-6) -> DataFrame:
    """(key, total) of stations whose weights do not add up to 1; they must not be used to gather."""
    return bridge.groupBy(key).agg(F.sum("weight").alias("total")).filter(F.abs(F.col("total") - 1) > tolerance)


def station_signals(weather: DataFrame, stations: DataFrame, cells: DataFrame, tech: str, ahead: int = 0, max_dist: float = gridmatch.MAX_DIST) -> DataFrame:
    """Signals of the stations of one technology: threshold events and low resource, masked by match, activation and night.

    weather: station, t and the canonical columns. stations: station, region, lat, lon, activation_year. `ahead` years
    are added to the weather's years before they are compared with the activation year. Stations without match have 0.
    """
    on_2d = gridmatch.nearest_2d(stations, cells, "station").withColumn("valid", F.col("dist_deg") <= max_dist)
    match = gridmatch.nearest_regular(stations, cells, "station", max_dist).unionByName(on_2d)  # the join keeps each site's own region, which is of one kind
    sites = stations.join(match, ["station", "region"], "left")
    resource = F.col("wind_ms") if tech == "wind" else F.col("rsds")
    low = lowres.low_resource(weather.withColumn("v", resource.cast("double"))).withColumnRenamed("low_resource", "signal_low_resource")
    rows = events.with_signals(low, tech).join(sites, "station")
    if tech == "solar":
        night = solar_elevation(F.col("lat"), F.col("lon"), F.col("t")) <= 0
        rows = rows.withColumn("signal_low_resource", F.when(night, F.lit(0)).otherwise(F.col("signal_low_resource")).cast("tinyint"))
    keep = F.coalesce(F.col("valid"), F.lit(False)) & (F.year("t") + ahead >= F.col("activation_year"))
    return events.masked(rows, keep)
