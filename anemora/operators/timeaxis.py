"""Time axes: steps, gaps, alignment, interpolation, accumulated fields, month inventories.

Every window is keyed by the station and ordered by time. Rows without time are dropped by the callers' joins; of
equal times the last by `order` holds where a function says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Days of a station that one window covers; a station with most of the rows is spread over its chunks.
CHUNK_DAYS = 32


def previous_time(df: DataFrame, station: str = "station") -> DataFrame:
    """df with before, the station's time before a row's; null for its first.

    Within chunks by a window, across them by the chunks' last times, of which there are few.
    """
    chunk = F.floor(F.datediff(F.to_date("t"), F.lit("1970-01-01").cast("date")) / CHUNK_DAYS)
    rows = df.withColumn("chunk", chunk)
    inner = rows.withColumn("before", F.lag("t").over(Window.partitionBy(station, "chunk").orderBy("t")))
    ends = rows.groupBy(station, "chunk").agg(F.max("t").alias("end"))
    ends = ends.withColumn("end_before", F.lag("end").over(Window.partitionBy(station).orderBy("chunk"))).drop("end")
    return inner.join(ends, [station, "chunk"], "left").withColumn("before", F.coalesce("before", "end_before")).drop("chunk", "end_before")


def step_hours(df: DataFrame, station: str = "station") -> DataFrame:
    """(station, step_hours): median distance of successive times."""
    gap = F.timestamp_diff("SECOND", F.col("before"), F.col("t")) / 3600.0
    return previous_time(df, station).withColumn("gap", gap).groupBy(station).agg(F.median("gap").alias("step_hours"))


def gaps(df: DataFrame, station: str = "station", hours: float = 1.0) -> DataFrame:
    """Rows that do not follow the row before at the given step: station, t, gap_hours."""
    gap = F.timestamp_diff("SECOND", F.col("before"), F.col("t")) / 3600.0
    return previous_time(df, station).withColumn("gap_hours", gap).filter(F.col("gap_hours") != hours).select(station, "t", "gap_hours")


def hourly_axis(df: DataFrame, station: str = "station") -> DataFrame:
    """(station, t): every hour from each station's first to its last."""
    ends = df.groupBy(station).agg(F.date_trunc("hour", F.min("t")).cast("timestamp_ntz").alias("a"), F.date_trunc("hour", F.max("t")).cast("timestamp_ntz").alias("b"))
    return ends.select(station, F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("t"))


def filled(df: DataFrame, value: str = "v", station: str = "station") -> DataFrame:
    """Hourly rows (station, t, value), each once, with the missing hours between a station's first and last as rows without value.

    The same as align() on hourly_axis(), by one window in place of a second reading and a join.
    """
    last = F.coalesce(F.lead("t").over(Window.partitionBy(station).orderBy("t")) - F.expr("interval 1 hour"), F.col("t"))
    hours = F.expr("sequence(t, last, interval 1 hour)")
    out = df.select(station, "t", value).withColumn("last", last).select(station, value, F.col("t").alias("own"), F.explode(hours).alias("t"))
    return out.select(station, "t", F.when(F.col("t") == F.col("own"), F.col(value)).alias(value))


def align(df: DataFrame, axis: DataFrame, value: str = "v", station: str = "station", order: str | None = None) -> DataFrame:
    """axis with the value at exactly its times, null where there is none; of several the last by order (else the largest)."""
    pick = F.max_by(value, order) if order else F.max(value)
    return axis.join(df.groupBy(station, "t").agg(pick.alias(value)), [station, "t"], "left")


def exact_lookup(df: DataFrame, wanted: DataFrame, value: str = "v", station: str = "station") -> DataFrame:
    """Like align, but a wanted time that is missing raises an error when the row is read."""
    out = align(df.withColumn("there", F.lit(True)), wanted, value, station).join(df.select(station, "t").distinct().withColumn("there", F.lit(True)), [station, "t"], "left")
    return out.withColumn(value, F.when(F.col("there"), F.col(value)).otherwise(F.raise_error(F.lit("a wanted time is missing")).cast("double"))).drop("there")


def interpolate(df: DataFrame, wanted: DataFrame, value: str = "v", station: str = "station", boundary: str = "nearest") -> DataFrame:
    """(station, t, value): linear between the neighbouring source times, by one pass over the joined axes.

    Outside the source's range the nearest value holds, or null with boundary='nan', which also blanks the very first
    and last time. A source row without value is passed over.
    """
    if boundary not in ("nearest", "nan"):
        raise ValueError(f"unknown boundary {boundary!r}")
    source = df.filter(F.col(value).isNotNull()).groupBy(station, "t").agg(F.max(value).alias("x")).withColumn("ask", F.lit(False))
    both = source.unionByName(wanted.select(station, "t").distinct().withColumns({"x": F.lit(None).cast("double"), "ask": F.lit(True)}))
    order = Window.partitionBy(station).orderBy("t")
    point = F.when(~F.col("ask"), F.struct("t", "x"))
    before = F.last(point, ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # backwards in time: a frame that only grows is worked out in one pass, one that shrinks anew for every row
    back = Window.partitionBy(station).orderBy(F.desc("t"))
    after = F.last(point, ignorenulls=True).over(back.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = both.withColumns({"p": before, "q": after, "lo": F.min(F.when(~F.col("ask"), F.col("t"))).over(Window.partitionBy(station)), "hi": F.max(F.when(~F.col("ask"), F.col("t"))).over(Window.partitionBy(station))}).filter("ask")
    share = F.try_divide(F.timestamp_diff("MICROSECOND", F.col("p.t"), F.col("t")).cast("double"), F.timestamp_diff("MICROSECOND", F.col("p.t"), F.col("q.t")).cast("double"))
    line = F.when(F.col("p.t") == F.col("q.t"), F.col("p.x")).otherwise(F.col("p.x") * (1 - share) + F.col("q.x") * share)
    y = F.coalesce(line, F.col("p.x"), F.col("q.x"))
    if boundary == "nan":
        y = F.when((F.col("t") > F.col("lo")) & (F.col("t") < F.col("hi")), line)
    return out.select(station, "t", y.alias(value))


def deaccumulate(df: DataFrame, value: str = "acc", station: str = "station", first: str = "zero", out: str = "v", step_hours: float | None = None) -> DataFrame:
    """Amounts per step of a field that adds up over the day and starts again after hour 0.

    At hour 1, and where the difference is negative, the amount is the running total itself; the first step of a
    station is 0 (first='zero'), missing ('nan') or its total ('current'). With step_hours a step whose predecessor is not
    there (a month before it that is missing) counts as a first one; without it the total is carried over any gap. No
    amount is negative.
    """
    before = F.lag(value).over(Window.partitionBy(station).orderBy("t"))
    has = F.lag(F.lit(1)).over(Window.partitionBy(station).orderBy("t")).isNotNull()
    if step_hours:
        gap = F.timestamp_diff("SECOND", F.lag("t").over(Window.partitionBy(station).orderBy("t")), F.col("t"))
        has = F.coalesce(gap == round(3600 * step_hours), F.lit(False))
    start = {"zero": F.lit(0.0), "nan": F.lit(None).cast("double"), "current": F.col(value)}[first]
    x = F.when(F.hour("t") == 1, F.col(value)).when(~has, start).otherwise(F.col(value) - before)
    return df.withColumn("x", x).withColumn(out, F.when(F.col("x").isNotNull(), F.greatest(F.when(F.col("x") < 0, F.col(value)).otherwise(F.col("x")), F.lit(0.0)))).drop("x")


def deaccumulate_legacy(df: DataFrame, value: str = "acc", station: str = "station", out: str = "v") -> DataFrame:
    """The older way: plain differences; the first, missing and negative ones are 0."""
    diff = F.col(value) - F.lag(value).over(Window.partitionBy(station).orderBy("t"))
    return df.withColumn(out, F.when(diff > 0, diff).otherwise(0.0))


def hourly_lookup(df: DataFrame, daily: DataFrame, value: str, station: str = "station", order: str = "order") -> DataFrame:
    """df with the value of its full hour; of several the last by order."""
    by_hour = daily.groupBy(station, F.date_trunc("hour", "t").alias("h")).agg(F.max_by(value, order).alias(value))
    return df.withColumn("h", F.date_trunc("hour", "t")).join(by_hour, [station, "h"], "left").drop("h")


def month_list(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(year, month) from first to last, given as yyyy-mm."""
    days = spark.sql(f"select explode(sequence(date'{first}-01', date'{last}-01', interval 1 month)) as d")
    return days.select(F.year("d").alias("year"), F.month("d").alias("month"))


def missing_months(df: DataFrame, expected: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Expected (year, month) of which df has no row; for each key if given."""
    there = df.select(*(key or []), F.year("t").alias("year"), F.month("t").alias("month")).distinct()
    if key:
        expected = there.select(*key).distinct().join(F.broadcast(expected))
    return expected.join(there, [*(key or []), "year", "month"], "left_anti")


def faults(df: DataFrame, value: str = "v", station: str = "station", step_hours: float = 1.0) -> DataFrame:
    """(station, rows, doubled, gaps, missing) of every series: rows, times that come again, steps of another length, values that are missing."""
    each = df.groupBy(station, "t").agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"))
    seconds = F.timestamp_diff("SECOND", F.col("before"), F.col("t"))
    parts = previous_time(each, station)
    return parts.groupBy(station).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("doubled"), F.count(F.when(seconds != round(3600 * step_hours), 1)).alias("gaps"), F.sum(F.col("n") - F.col("known")).alias("missing")
    )


def require_months(df: DataFrame, expected: DataFrame) -> DataFrame:
    """expected, or ValueError naming the first month of which df has no row."""
    lack = missing_months(df, expected).orderBy("year", "month").first()
    if lack:
        raise ValueError(f"no rows of {lack['year']:04d}-{lack['month']:02d}")
    return expected


def chunk_plan(months: DataFrame, per_chunk: int) -> DataFrame:
    """(chunk, first_month, last_month, months): successive months in chunks, numbered from 0."""
    k = F.col("year") * 12 + F.col("month") - 1
    start = months.agg(F.min(k).alias("k0"))
    part = months.withColumn("k", k).join(F.broadcast(start)).withColumn("chunk", F.floor((F.col("k") - F.col("k0")) / per_chunk).cast("int"))
    name = lambda c: F.format_string("%04d-%02d", F.floor(c / 12).cast("int"), (c % 12 + 1).cast("int"))
    return part.groupBy("chunk").agg(name(F.min("k")).alias("first_month"), name(F.max("k")).alias("last_month"), F.count(F.lit(1)).alias("months"))
