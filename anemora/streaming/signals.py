"""Threshold events on a stream of readings. They look at one row at a time, so the batch rules apply as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.operators import events


def signals(stream: DataFrame, tech: str, late: str = "1 day") -> DataFrame:
    """Readings with their signals; a reading sent again within `late` of the newest counts once."""
    once = stream.withColumn("t", F.col("t").cast("timestamp")).withWatermark("t", late).dropDuplicatesWithinWatermark(["obs_id"])
    return events.with_signals(once, tech)


def daily_exposure(stream: DataFrame, tech: str, late: str = "1 day") -> DataFrame:
    """Share of readings per station and day in which each event holds; a day is given out when no reading of it can come any more."""
    rows = signals(stream, tech, late)
    cols = [c for c in rows.columns if c.startswith("signal_")]
    return rows.groupBy("station_id", F.window("t", "1 day").alias("day")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(c[7:]) for c in cols]).withColumn("day", F.col("day.start"))
