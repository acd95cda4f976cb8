"""Percentile sketches: thresholds judged, and the rank error of groups that compact."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from anemora.llm import percentile_sketch

CLIM = "tech string, lat_idx int, lon_idx int, run_day date, month_no smallint, hour_no smallint, clim float, loaded_at timestamp_ntz"


def test_wrong_thresholds(spark):
    rng = np.random.default_rng(5)
    rows, truth = [], {}
    for cell, n_days in (((1, 1)), ((2, 60)), ((3, 7))):
        for day in range(n_days):
            for hour in range(24):
                x = float(np.float32(rng.choice([0.0, rng.random()], p=[0.3, 0.7])))
                key = ("wind", cell, 0, date(2025, 1, 1) + timedelta(days=day), 1, hour)
                rows.append((*key, -9.0, datetime(2025, 1, 1)))
                rows.append((*key, x, datetime(2025, 2, 1)))
                truth.setdefault(cell, []).append(x)
        rows.append(("wind", cell, 0, date(2026, 1, 1), 1, 1, None, datetime(2025, 1, 1)))
        rows.append(("wind", cell, 0, date(2026, 1, 1), 1, 2, float("nan"), datetime(2025, 1, 1)))
    grid = [("wind", c, 0, p, float(t), 1) for c in (1, 2, 3) for p in (5, 10, 50, 90) for t in (0.0, 0.3, np.quantile(truth[c], p / 100))] + [("wind", 1, 0, 50, None, 1), ("wind", 99, 0, 50, 0.5, 1)]
    clim = spark.createDataFrame(rows + rows[:50], CLIM)
    cells = spark.createDataFrame(grid, "tech string, lat_idx int, lon_idx int, pctl smallint, threshold float, valid_count int")
    got = {(r["lat_idx"], r["pctl"], round(r["threshold"], 6)): r["share"] for r in percentile_sketch.judged_thresholds(clim, cells).collect()}
    assert len(got) == len({(c, p, round(float(np.float32(t)), 6)) for _, c, _, p, t, _ in grid if t is not None and c != 99})
    for (c, p, t), share in got.items():
        assert share == pytest.approx(np.mean(np.array(truth[c], np.float32) <= np.float32(t)), abs=2 * percentile_sketch.RANK_ERROR + 0.5 / percentile_sketch.STEPS)
    assert percentile_sketch.wrong_thresholds(clim.limit(0), cells).count() == 0


def test_rank_error_of_compacting_groups(spark):
    """12 groups of 120,000 values over 8 days, of several shapes: sketches of days, combined, answer within the stated rank error."""
    n, groups = 120_000, 12
    shape = F.when(F.col("lon_idx") % 3 == 0, F.rand(3)).when(F.col("lon_idx") % 3 == 1, F.exp(F.randn(4) * 3)).otherwise(F.floor(F.rand(5) * 5000))
    x = spark.range(n * groups).select(F.lit("wind").alias("tech"), F.lit(1).alias("lat_idx"), (F.col("id") % groups).cast("int").alias("lon_idx"), (F.col("id") % 8).alias("run_day")).withColumn("clim", shape.cast("float"))
    x = x.persist()
    shares = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    days = percentile_sketch.day_sketches(x)
    got = percentile_sketch.percentiles(percentile_sketch.merged(days), shares).toPandas()
    rows = x.select("lon_idx", "clim").toPandas()
    assert days.select(F.max(F.length("sketch"))).first()[0] < 4 * 4 * percentile_sketch.K < 4 * n / 8
    bad = 0
    for _, r in got.iterrows():
        values = np.sort(rows[rows["lon_idx"] == r["lon_idx"]]["clim"].to_numpy())
        for s in shares:
            low, high = np.searchsorted(values, np.float32(r[f"p{round(100 * s)}"]), "left") / len(values), np.searchsorted(values, np.float32(r[f"p{round(100 * s)}"]), "right") / len(values)
            off = max(low - s, s - high, 0)
            assert off <= 2 * percentile_sketch.RANK_ERROR
            bad += off > percentile_sketch.RANK_ERROR
    assert bad <= 0.05 * len(got) * len(shares)
    x.unpersist()


def test_days_combine_in_any_grouping(spark):
    """Sketches of separate days, combined at once or in two steps, count the same values and stay within the error."""
    x = spark.range(400_000).select(F.lit("wind").alias("tech"), F.lit(1).alias("lat_idx"), F.lit(2).alias("lon_idx"), (F.col("id") % 30).alias("run_day"), (F.rand(8) * 100).cast("float").alias("clim"))
    days = percentile_sketch.day_sketches(x)
    weeks = percentile_sketch.merged(days.withColumn("week", F.floor(F.col("run_day") / 7)), [*percentile_sketch.CELL, "week"])
    for sketches in (percentile_sketch.merged(days), percentile_sketch.merged(weeks)):
        r = percentile_sketch.percentiles(sketches, [0.05, 0.5, 0.9]).first()
        assert r["n"] == 400_000
        for share in (5, 50, 90):
            assert abs(r[f"p{share}"] - share) < 100 * (2 * percentile_sketch.RANK_ERROR + 0.003)
