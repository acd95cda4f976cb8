"""Percentiles per group over very many values, by mergeable randomized compactors (problem 4).

Each partition fills a hierarchy of compactors per group and day: a full level is sorted and every other value (from a
random start) moves up with double weight. Hierarchies are merged level by level, first over partitions, later over
days, and answer ranks and percentiles within a probabilistic rank error that depends on k alone. These are the KLL
sketches that the engine has built in; they are aggregated map-side, so a group with most rows costs one sketch per task.
Groups of up to about k values are kept whole and answered exactly; of larger ones a sketch keeps some 3 k values.

Nulls and NaN are left out; a key sent twice counts once (latest loaded_at; of equal ones the largest value, null last).
An empty table gives no rows. A group without values has no sketch and none of its thresholds is judged. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.operators.rows import latest

#: Compactor size. The normalized rank error of one sketch, merged or not, is below RANK_ERROR with 99 % confidence
#: (published: 2.296 / k ** 0.9021 for one rank).
K = 2048
RANK_ERROR = 2.296 / K**0.9021
#: A share is read from so many evenly spaced percentiles of a sketch, which adds half a step to the rank error.
STEPS = 500
CELL = ["tech", "lat_idx", "lon_idx"]
#: Share by which a threshold's rank may differ from its percentile.
TOLERANCE = 0.02


def day_sketches(clim: DataFrame, group: list[str] = CELL, day: str = "run_day", value: str = "clim", k: int = K) -> DataFrame:
    """(group, day, sketch, n): one sketch per group and day, to be kept and combined with those of other days."""
    good = clim.filter(F.col(value).isNotNull() & ~F.isnan(value))
    return good.groupBy(*group, day).agg(F.kll_sketch_agg_float(F.col(value).cast("float"), k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, group: list[str] = CELL, k: int = K) -> DataFrame:
    """(group, sketch, n): the sketches of separate days or partitions combined."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_float("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def at_or_below(sketch: Column, value: Column) -> Column:
    """Estimated share of a sketch's values at or below value, within RANK_ERROR + 0.5 / STEPS.

    The engine's own rank function takes constants only; value may be a column.
    """
    grid = F.kll_sketch_get_quantile_float(sketch, F.array(*[F.lit((n + 0.5) / STEPS) for n in range(STEPS)]))
    return F.size(F.filter(grid, lambda q: q <= value.cast("float"))) / STEPS


def percentiles(sketches: DataFrame, shares: list[float], group: list[str] = CELL) -> DataFrame:
    """(group, n, p5, p50, ...): estimated percentiles of merged sketches."""
    return sketches.select(*group, "n", *[F.kll_sketch_get_quantile_float("sketch", F.lit(s)).alias(f"p{round(100 * s):g}") for s in shares])


def judged_thresholds(clim: DataFrame, grid: DataFrame, k: int = K) -> DataFrame:
    """(cell, pctl, threshold, share, off): every recorded threshold with the share of values at or below it."""
    key = [*CELL, "run_day", "month_no", "hour_no"]
    # days of a cell lie together, so that the copies of a key meet and the day's sketch is made without another exchange
    rows = latest(clim.select(*key, "clim", "loaded_at").repartition(*CELL, "run_day"), key, "clim", "loaded_at")
    sketches = merged(day_sketches(rows, k=k), k=k)
    asked = grid.filter(F.col("threshold").isNotNull() & ~F.isnan("threshold") & F.col("pctl").isNotNull()).select(*CELL, "pctl", F.col("threshold").cast("float").alias("threshold")).distinct()
    share = at_or_below(F.col("sketch"), F.col("threshold"))
    return asked.join(sketches, CELL).select(*CELL, "pctl", "threshold", share.alias("share"), "n").withColumn("off", F.abs(F.col("share") - F.col("pctl") / 100))


def wrong_thresholds(clim: DataFrame, grid: DataFrame, tolerance: float = TOLERANCE, k: int = K) -> DataFrame:
    """(cell, pctl) of the thresholds whose share differs from their percentile by more than tolerance."""
    return judged_thresholds(clim, grid, k).filter(F.col("off") > tolerance).select(*CELL, "pctl").distinct()


def measured_errors(clim: DataFrame, grid: DataFrame, k: int = K) -> DataFrame:
    """(tech, pctl, thresholds, largest, mean): how far the shares of judged_thresholds lie from the exact ones, which are counted over all values."""
    key = [*CELL, "run_day", "month_no", "hour_no"]
    judged = judged_thresholds(clim, grid, k).withColumn("limit", F.col("threshold"))
    values = latest(clim, key, "clim", "loaded_at").filter(F.col("clim").isNotNull() & ~F.isnan("clim")).groupBy(*CELL, "clim").agg(F.count(F.lit(1)).alias("n"))
    exact = values.join(judged.select(*CELL, "pctl", "limit"), CELL).groupBy(*CELL, "pctl", "limit").agg((F.sum(F.when(F.col("clim") <= F.col("limit"), F.col("n")).otherwise(0)) / F.sum("n")).alias("exact"))
    gap = F.abs(F.col("share") - F.col("exact"))
    both = judged.join(exact, [*CELL, "pctl", "limit"])
    return both.groupBy("tech", "pctl").agg(F.count(F.lit(1)).alias("thresholds"), F.max(gap).alias("largest"), F.avg(gap).alias("mean"))
