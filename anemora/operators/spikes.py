"""Impossible, stuck and far-out readings per station (problem 5).

Each station's readings of a variable are cut into chunks of CHUNK_DAYS, so that no station is one task's work. In a
chunk two undecimated Haar decompositions are made. Along time, a detail of zero means that a reading repeats the one
before: seven zero details in a row are a stuck value, joined across chunks. Along the days at one hour of day
(irradiance) or along the wet readings (precipitation above 0) the details D1..D3 are compared with SPIKE times their
robust scale, the median of their absolute values in that series and chunk. What the details above that add up to is the
spike part of a reading; only readings whose spike part is above 0 are candidates, and only these are compared with the
limits of far-out readings. Bounds give impossible readings, which the decomposition passes over.

Nulls and NaN are passed over. A reading sent twice counts once (latest received_at, of equal ones the largest values). Rows without station, time or id
have no result. In a series with fewer than SHORT readings in a chunk no scale is known, and every reading is a candidate.
Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemora.session import written

CHUNK_DAYS = 64
LEVELS = 3
SPIKE = 2.5
#: Readings from which on a series' scale is held to be robust: wet readings vary by orders of magnitude, those of an hour of day do not.
SHORT = {"irradiance_wm2": 4, "precip_mmh": 64}
STUCK_RUN = 8
#: Lowest and highest possible reading.
BOUNDS = {"irradiance_wm2": (-5.0, 1361.0), "precip_mmh": (0.0, 300.0)}
#: A reading is far out above base + factor * median (irradiance: of the hour of day; precipitation: of readings above 0).
LIMITS = {"irradiance_wm2": (200.0, 2.0), "precip_mmh": (0.0, 15.0)}


def _by_var(table: dict, k: int) -> Column:
    return F.when(F.col("var_name") == "precip_mmh", F.lit(table["precip_mmh"][k])).otherwise(F.lit(table["irradiance_wm2"][k]))


def _impossible() -> Column:
    return (F.col("x") < _by_var(BOUNDS, 0)) | (F.col("x") > _by_var(BOUNDS, 1))


def readings(hourly: DataFrame) -> DataFrame:
    """(station_id, chunk, var_name, t, hour, obs_id, x): every reading once, nulls and NaN left out; hour is -1 for precipitation."""
    cols = hourly.select(
        "obs_id", "station_id", "t", "received_at",
        F.floor(F.datediff(F.to_date("t"), F.lit("1970-01-01").cast("date")) / CHUNK_DAYS).cast("int").alias("chunk"),
        *[F.col(v).cast("double").alias(v) for v in BOUNDS],
    ).filter(F.col("obs_id").isNotNull() & F.col("station_id").isNotNull() & F.col("t").isNotNull())
    # a row sent twice has the same station and time, so its copies are neighbours here
    line = Window.partitionBy("station_id", "chunk").orderBy("t", "obs_id", "received_at", *BOUNDS)
    single = cols.repartition("station_id", "chunk").withColumn("next", F.lead("obs_id").over(line)).filter(F.col("next").isNull() | (F.col("next") != F.col("obs_id")))
    stacked = F.inline(F.array(*[F.struct(F.lit(v).alias("var_name"), F.lit(-1).alias("hour") if v == "precip_mmh" else F.hour("t").alias("hour"), F.col(v).alias("x")) for v in BOUNDS]))
    return single.select("station_id", "chunk", "t", "obs_id", stacked).filter(F.col("x").isNotNull() & ~F.isnan("x"))


def limits(rows: DataFrame) -> DataFrame:
    """(station_id, var_name, hour, limit); hour is -1 for precipitation, whose limit holds all day.

    Equal readings are counted first, so that a station with most of the rows comes as its different values.
    """
    use = rows.filter((F.col("var_name") != "precip_mmh") | (F.col("x") > 0))
    local = use.groupBy("station_id", "chunk", "var_name", "hour", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = local.groupBy("station_id", "var_name", "hour", "x").agg(F.sum("n").alias("n"))
    middle = counts.groupBy("station_id", "var_name", "hour").agg(F.percentile("x", F.lit(0.5), F.col("n")).alias("m"))
    return middle.select("station_id", "var_name", "hour", (_by_var(LIMITS, 0) + _by_var(LIMITS, 1) * F.col("m")).alias("limit"))


def sticking(rows: DataFrame, least: int = STUCK_RUN) -> DataFrame:
    """rows with stuck (in a run of least equal readings within the chunk), run (number of the run in the chunk) and runs."""
    order = Window.partitionBy("station_id", "chunk", "var_name").orderBy("t", "obs_id")
    zero = F.coalesce((F.col("detail") == 0).cast("int"), F.lit(0))
    out = rows.withColumn("detail", (F.col("x") - F.lag("x").over(order)) / 2).withColumn("zero", zero).drop("detail")
    out = out.withColumns({"ends": F.sum("zero").over(order.rowsBetween(2 - least, 0)), "run": F.sum(1 - F.col("zero")).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    whole = Window.partitionBy("station_id", "chunk", "var_name")
    out = out.withColumns({"stuck": F.max("ends").over(order.rowsBetween(0, least - 1)) == least - 1, "runs": F.max("run").over(whole)})
    return out.drop("zero", "ends")


def spike_parts(rows: DataFrame, spike: float = SPIKE, levels: int = LEVELS) -> DataFrame:
    """rows with spike (what the details above their threshold add up to) and score (the largest scaled detail).

    Both are null for impossible readings and in series of fewer than SHORT readings.
    """
    wet = (F.col("var_name") == "precip_mmh") & (F.col("x") > 0)
    series = F.when(_impossible(), 25).when(wet, 24).otherwise(F.col("hour"))
    part = ["station_id", "chunk", "var_name", "series"]
    order, whole = Window.partitionBy(*part).orderBy("t", "obs_id"), Window.partitionBy(*part)
    out = rows.withColumn("series", series)
    out = out.withColumns({f"s{j}": F.avg("x").over(order.rowsBetween(-(2 ** (j - 1)), 2 ** (j - 1) - 1)) for j in range(1, levels + 1)})
    out = out.withColumns({f"d{j}": (F.col("x") if j == 1 else F.col(f"s{j - 1}")) - F.col(f"s{j}") for j in range(1, levels + 1)})
    size = {f"scale{j}": F.percentile_approx(F.abs(f"d{j}"), F.lit(0.5), F.lit(100)).over(whole) for j in range(1, levels + 1)}
    out = out.withColumns(size | {"members": F.count(F.lit(1)).over(whole)})
    sharp = lambda j: F.when(F.abs(f"d{j}") > spike * F.col(f"scale{j}") + 1e-9, F.col(f"d{j}")).otherwise(0.0)
    total = sum((sharp(j) for j in range(1, levels + 1)), F.lit(0.0))
    score = F.greatest(*[F.coalesce(F.try_divide(F.abs(f"d{j}"), F.col(f"scale{j}")), F.lit(0.0)) for j in range(1, levels + 1)])
    known = (F.col("members") >= F.when(F.col("var_name") == "precip_mmh", SHORT["precip_mmh"]).otherwise(SHORT["irradiance_wm2"])) & ~_impossible()
    total = F.when((F.col("var_name") == "precip_mmh") & ~wet, 0.0).otherwise(total)  # a dry reading is never far out
    return out.select(*rows.columns, F.when(known, total).alias("spike"), F.when(known, score).alias("score"))


def judged(hourly: DataFrame, spike: float = SPIKE) -> tuple[DataFrame, DataFrame]:
    """The readings that may be flagged, as a written table, and the limits that far-out ones must exceed.

    (station_id, chunk, var_name, hour, t, obs_id, x, stuck, run, runs, score, impossible, candidate, border)
    """
    rows = readings(hourly)
    fine = spike_parts(sticking(rows), spike)
    flags = {
        "impossible": _impossible(),
        "candidate": F.col("spike").isNull() | (F.col("spike") > 0),
        "border": (F.col("run") == 1) | (F.col("run") == F.col("runs")),
        "stuck": F.col("stuck") & (F.col("x") > 0),
    }
    some = fine.withColumns(flags).drop("spike").filter("impossible or candidate or border or stuck")
    return written(some, "spikes"), limits(rows)


def _across(border: DataFrame, least: int = STUCK_RUN) -> DataFrame:
    """(obs_id, var_name) of the readings above 0 in runs that only together with those of the neighbouring chunks are long enough."""
    runs = border.groupBy("station_id", "chunk", "var_name", "run", "runs").agg(
        F.first("x").alias("x"), F.count(F.lit(1)).alias("length"), F.collect_list(F.when((F.col("x") > 0) & ~F.col("stuck"), F.col("obs_id"))).alias("ids")
    )
    # at most two runs a chunk; a run goes on where the last of one chunk equals the first of the next
    line = Window.partitionBy("station_id", "var_name").orderBy("chunk", "run")
    goes_on = (F.lag(F.col("run") == F.col("runs")).over(line)) & (F.col("run") == 1) & (F.lag("x").over(line) == F.col("x"))
    chains = runs.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("chain", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    long = chains.withColumn("total", F.sum("length").over(Window.partitionBy("station_id", "var_name", "chain"))).filter(F.col("total") >= least)
    return long.select(F.explode("ids").alias("obs_id"), "var_name")


def flagged(hourly: DataFrame, spike: float = SPIKE) -> DataFrame:
    """(obs_id, var_name, reason, score): impossible, far_out (score: largest scaled detail) and stuck readings.

    One row for each reason of a reading.
    """
    some, caps = judged(hourly, spike)
    far = some.filter("candidate").join(caps, ["station_id", "var_name", "hour"]).filter(F.col("x") > F.col("limit"))
    as_reason = lambda df, name, score: df.select("obs_id", "var_name", F.lit(name).alias("reason"), score.cast("double").alias("score"))
    none = F.lit(None)
    stuck = some.filter("stuck").select("obs_id", "var_name").unionByName(_across(some.filter("border")))
    return as_reason(some.filter("impossible"), "impossible", none).unionByName(as_reason(far, "far_out", F.col("score"))).unionByName(as_reason(stuck, "stuck", none))


def found(hourly: DataFrame, spike: float = SPIKE) -> DataFrame:
    """(obs_id, var_name): each flagged reading once."""
    return flagged(hourly, spike).select("obs_id", "var_name").distinct()


def coverage(hourly: DataFrame, spike: float = SPIKE) -> DataFrame:
    """(var_name, readings, candidates, far_out, far_candidates): how many readings the details leave over, and how many of those above their limit are among them."""
    rows = readings(hourly)
    both = spike_parts(rows, spike).join(limits(rows), ["station_id", "var_name", "hour"], "left")
    candidate, far = F.col("spike").isNull() | (F.col("spike") > 0), F.col("x") > F.col("limit")
    n = lambda c: F.count(F.when(c, 1))
    return both.groupBy("var_name").agg(F.count(F.lit(1)).alias("readings"), n(candidate).alias("candidates"), n(far).alias("far_out"), n(far & candidate).alias("far_candidates"))
