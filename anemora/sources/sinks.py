"""Writing signals: partitioned tables, idempotent runs, back-fill of one signal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["region", "scenario", "year", "tech"]


def open_keys(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Units of work that have no output yet."""
    return wanted.join(done.select(*key).distinct(), key, "left_anti")


def write_signals(signals: DataFrame, path: str, partitions: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Signals by partition. mode: 'ignore' skips an existing output, 'errorifexists' refuses, 'overwrite' replaces the partitions at hand."""
    by = [c for c in PARTITIONS if c in signals.columns] if partitions is None else partitions
    writer = signals.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_weather(weather: DataFrame, path: str, keys: list[str], partitions: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Canonical weather as 32-bit floats with a fixed schema: keys, t, temp_c, wind_ms, precip_mmh, rsds, rh_pct, dust_aod; missing columns are null."""
    values = [(F.col(c) if c in weather.columns else F.lit(None)).cast("float").alias(c) for c in ("temp_c", "wind_ms", "precip_mmh", "rsds", "rh_pct", "dust_aod")]
    write_signals(weather.select(*keys, "t", *values, *[c for c in partitions or [] if c not in keys]), path, partitions or [], mode)


def run_metadata(spark: SparkSession, attributes: dict[str, str]) -> DataFrame:
    """(key, value) of a run's provenance."""
    return spark.createDataFrame(sorted(attributes.items()), "key string, value string")


def backfill(signals: DataFrame, computed: DataFrame, key: list[str], column: str, overwrite: bool = False) -> DataFrame:
    """signals with one signal column added, or filled where it is missing (everywhere with overwrite); 0 where nothing was computed.

    Doing it again changes nothing.
    """
    new = computed.select(*key, F.col(column).alias("_new"))
    out = signals.join(new, key, "left")
    if column in signals.columns and not overwrite:
        value = F.coalesce(F.col(column), F.col("_new"), F.lit(0))
    else:
        value = F.coalesce(F.col("_new"), F.lit(0))
    return out.withColumn(column, value.cast("tinyint")).drop("_new")


#: Name of the file that tells which version of a replaced table holds.
CURRENT = "CURRENT"


def replace_table(df: DataFrame, path: str) -> None:
    """Write df as a new version under path, then let the pointer file show it; df may read from the version before.

    The pointer is replaced by one rename that overwrites, so that a reader of current_table() sees the old version or the
    new one, whenever the writer is lost.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs_of = spark._jvm.org.apache.hadoop.fs
    temporary, pointer = fs_of.Path(f"{path}/_{version}"), fs_of.Path(f"{path}/{CURRENT}")
    out = pointer.getFileSystem(spark._jsc.hadoopConfiguration()).create(temporary)
    out.write(version.encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fs_of.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(temporary, pointer, options)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The version of a replaced table that holds."""
    version = spark.read.text(f"{path}/{CURRENT}").first()[0]
    return spark.read.parquet(f"{path}/{version}")


def write_station_signals(signals: DataFrame, stations: DataFrame, path: str, key: str = "station", mode: str = "errorifexists") -> None:
    """Two tables: path/signals (key, t and the signals, by year) and path/stations (every station once, with id, place and match).

    A station with signals but no row in stations, or with several, raises ValueError before anything is written.
    """
    doubled = stations.groupBy(key).count().filter("count > 1").limit(1).count()
    unknown = signals.select(key).distinct().join(stations.select(key), key, "left_anti").limit(1).count()
    if doubled or unknown:
        raise ValueError("every station with signals must stand in the station table once")
    cols = [c for c in signals.columns if c.startswith("signal_")]
    rows = signals.select(key, "t", *[F.col(c).cast("tinyint").alias(c) for c in cols], F.year("t").alias("year"))
    stations.write.mode(mode).option("compression", "zstd").parquet(f"{path}/stations")
    write_signals(rows, f"{path}/signals", ["year"], mode)


def write_thresholds(clim: DataFrame, thr: DataFrame, path: str, key: str = "station", mode: str = "errorifexists") -> None:
    """Two tables with a fixed schema: path/clim (key, month, hour, clim) and path/thr (key, threshold, valid_count)."""
    clim.select(key, F.col("month").cast("smallint"), F.col("hour").cast("smallint"), F.col("clim").cast("float")).write.mode(mode).parquet(f"{path}/clim")
    thr.select(key, F.col("threshold").cast("float"), F.col("valid_count").cast("int")).write.mode(mode).parquet(f"{path}/thr")
