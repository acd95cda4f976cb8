"""Low-resource events: centred daily mean, month-by-hour climatology, anomaly, low percentile per station.

Rolled means, climatology, anomalies, thresholds and marks are windows of one station, so that one exchange by station
serves them all and nothing is worked out twice. A station's series is bounded by its hours (8,766 a year), however
many readings they come from; those are averaged by hour before, with stations split by hour.

Rolling is by position in time order. A window with a missing value or without its full length has no mean, an hour
without mean no anomaly, and neither has a signal. Stations with equal times must have been made unique before. An empty
series gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENT = 0.05


def window_steps(step_hours: float) -> int:
    """Steps of a day; they must divide it."""
    n = round(24 / step_hours)
    if n < 1 or abs(n * step_hours - 24) > 1e-6:
        raise ValueError(f"a step of {step_hours} h does not divide a day")
    return n


def rolling(series: DataFrame, steps: int = 24, value: str = "v", station: str = "station", out: str = "roll") -> DataFrame:
    """Centred mean over steps rows: steps // 2 before, the others from the row on; null unless all are there."""
    w = Window.partitionBy(station).orderBy("t").rowsBetween(-(steps // 2), steps - steps // 2 - 1)
    return series.withColumn(out, F.when(F.count(value).over(w) == steps, F.avg(value).over(w)))


def rolling_v1(series: DataFrame, steps: int = 24, value: str = "v", station: str = "station", out: str = "roll") -> DataFrame:
    """The older kernel: one step later, and shorter windows at the ends count as they are."""
    w = Window.partitionBy(station).orderBy("t").rowsBetween(-(steps // 2 - 1), steps - steps // 2)
    return series.withColumn(out, F.when(F.count(value).over(w) == F.count(F.lit(1)).over(w), F.avg(value).over(w)))


def climatology(rolled: DataFrame, station: str = "station", years: tuple[int, int] | None = None) -> DataFrame:
    """(station, month, hour, clim): mean of the rolled values, of the baseline years if given."""
    if years:
        rolled = rolled.filter(F.year("t").between(*years))
    return rolled.groupBy(station, F.month("t").alias("month"), F.hour("t").alias("hour")).agg(F.avg("roll").alias("clim"))


def anomalies(rolled: DataFrame, clim: DataFrame, station: str = "station", digits: int = 9) -> DataFrame:
    """rolled with anom, the difference to the climatology of its month and hour; rounded, so that ties are ties."""
    keyed = rolled.withColumns({"month": F.month("t"), "hour": F.hour("t")})
    return keyed.join(clim, [station, "month", "hour"], "left").withColumn("anom", F.round(F.col("roll") - F.col("clim"), digits))


def thresholds(anoms: DataFrame, station: str = "station", percent: float = PERCENT) -> DataFrame:
    """(station, threshold, valid_count): exact percentile by linear interpolation of each station's anomalies."""
    return anoms.groupBy(station).agg(F.percentile("anom", F.lit(percent)).alias("threshold"), F.count("anom").alias("valid_count"))


def mark(anoms: DataFrame, station: str = "station", mark_next: bool = True, night: Column | None = None) -> DataFrame:
    """anoms (with threshold) with low_resource: at or below the threshold, or right after such a step; never without anomaly or at night."""
    out = anoms.withColumn("hit", F.coalesce(F.col("anom") <= F.col("threshold"), F.lit(False)))
    low = F.col("hit")
    if mark_next:
        low = low | F.coalesce(F.lag("hit").over(Window.partitionBy(station).orderBy("t")), F.lit(False))
    low = low & F.col("anom").isNotNull()
    if night is not None:
        low = low & ~F.coalesce(night, F.lit(False))
    return out.withColumn("low_resource", low.cast("tinyint")).drop("hit")


def _in(column: str | Column, years: tuple[int, int] | None) -> Column:
    x = F.col(column) if isinstance(column, str) else column
    return F.when(F.year("t").between(*years), x) if years else x


def own_anomalies(rolled: DataFrame, station: str = "station", years: tuple[int, int] | None = None, digits: int = 9) -> DataFrame:
    """anomalies() against the climatology of the series itself, as a window in place of a join."""
    cell = Window.partitionBy(station, F.month("t"), F.hour("t"))
    return rolled.withColumn("anom", F.round(F.col("roll") - F.avg(_in("roll", years)).over(cell), digits))


def own_thresholds(anoms: DataFrame, station: str = "station", years: tuple[int, int] | None = None, percent: float = PERCENT) -> DataFrame:
    """anoms with the threshold of each station's own anomalies, as a window in place of a join."""
    return anoms.withColumn("threshold", F.percentile(_in("anom", years), F.lit(percent)).over(Window.partitionBy(station)))


def low_resource(
    series: DataFrame,
    station: str = "station",
    steps: int = 24,
    clim: DataFrame | None = None,
    thr: DataFrame | None = None,
    baseline: tuple[int, int] | None = None,
    percent: float = PERCENT,
    mark_next: bool = True,
    night: Column | None = None,
    kernel: str = "current",
) -> DataFrame:
    """series (station, t, v) with anom, threshold and low_resource; climatology and thresholds are its own unless given."""
    rolled = (rolling if kernel == "current" else rolling_v1)(series, steps, station=station)
    anoms = own_anomalies(rolled, station, baseline) if clim is None else anomalies(rolled, clim, station)
    known = own_thresholds(anoms, station, baseline, percent) if thr is None else anoms.join(thr.select(station, "threshold"), station, "left")
    return mark(known, station, mark_next, night)
