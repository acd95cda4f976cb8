"""Consolidation of many tiny files into few well-sized ones (problem 2).

compact_files   tiny files in a folder: combined input splits, coalesce without a shuffle, staged write, verification
compact_caches  a table of tiny cache files, one per row: the same, with each record kept exactly once

Both pack the input with the engine's own split settings (many small files to one task, by bytes and by the cost of
opening a file), write to a staging folder in the shared directory, read that back and compare row count, an
order-free checksum and (caches) the number of different keys with what went in, and only then hand out (or move to) the result.

Nulls: a null, empty or broken-off body yields the complete lines it has, possibly none. Repeated rows and repeated
records count once. An empty table gives an empty result. Extra columns are ignored (caches) or kept (files).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anemora.session import once, scratch, settings, small, written

#: Size that an output file should have at least, and the input bytes that one read task packs together.
TARGET_BYTES = 128 << 20
#: What opening one more file is held to cost, in bytes read; high, so that tiny files do not fill a task by number alone.
OPEN_COST_BYTES = 64 << 10

#: Names of files whose writing was not finished.
UNFINISHED = r"(^|/)(_temporary|\.staging|_staging)(/|$)|\.(tmp|temp|part|partial|inprogress|filepart|crdownload|copying|_copying_)(\.[^/]*)?$|(^|/)[._~][^/]*$|~$"
CACHE_DIR = r"(?:^|/)station_cf_([^/_]+)_([^/_]+)_(?:[^/]*_)?(\d{4}-\d{4})_([^/]+)\.nc/"


CACHE_KEY = ["scenario", "tech", "years", "interpolation"]


class VerificationError(RuntimeError):
    """Staged output differs from its input."""


def packed(pack_bytes: int = TARGET_BYTES, open_cost: int = OPEN_COST_BYTES):
    """Session settings under which many small files share one input split."""
    return {"spark__sql__files__maxPartitionBytes": str(pack_bytes), "spark__sql__files__openCostInBytes": str(open_cost)}


def _path(spark: SparkSession, at: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(at)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_bytes(spark: SparkSession, at: str) -> int:
    fs, p = _path(spark, at)
    return fs.getContentSummary(p).getLength()


def verify(before: DataFrame, after: DataFrame, key: list[str] | None = None, source: DataFrame | None = None) -> None:
    """Raise VerificationError unless after has the rows of before (number and order-free checksum).

    With a key: unless no two rows of after share it, and unless after has as many rows as source, if given, has different keys.
    """
    checksum = F.sum(F.xxhash64(*before.columns).cast("decimal(38,0)"))
    keys = lambda df: F.count_distinct(F.xxhash64(*key)) if key and df is not None else F.lit(None).cast("bigint")
    want = before.agg(F.count(F.lit(1)).alias("n"), checksum.alias("h")).first()
    got = after.agg(F.count(F.lit(1)).alias("n"), checksum.alias("h"), keys(after).alias("k")).first()
    if (got["n"], got["h"]) != (want["n"], want["h"]):
        raise VerificationError(f"{got['n']} rows were read, {want['n']} written")
    if key and got["k"] != got["n"]:
        raise VerificationError(f"{got['n']} rows have {got['k']} keys")
    if source is not None and (came := source.agg(keys(source).alias("k")).first()["k"]) != got["n"]:
        raise VerificationError(f"{came} keys came in, {got['n']} rows went out")


def staged(parts: list[DataFrame], by: list[str] | None = None) -> tuple[DataFrame, str]:
    """The rows of all parts as files in a staging folder, one file a task, and the folder; to be verified before it is handed out."""
    out = reduce(DataFrame.unionByName, parts)
    stage = scratch(out.sparkSession, "staged")
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(stage)
    return out.sparkSession.read.schema(out.schema).parquet(stage), stage


def compact_files(spark: SparkSession, source: str, target: str, fmt: str = "parquet", target_bytes: int = TARGET_BYTES, open_cost: int = OPEN_COST_BYTES, **options: str) -> DataFrame:
    """The folder source of many small files as a folder target of few; no record is lost or doubled, nothing is shuffled.

    The target must not exist; it appears at once and only after verification.
    """
    with settings(spark, **packed(target_bytes, open_cost)):
        many = spark.read.options(**options).format(fmt).load(source)
        few, stage = staged([many.coalesce(max(1, -(-folder_bytes(spark, source) // target_bytes)))])
        verify(many, few)
    fs, to = _path(spark, target)
    if fs.exists(to) or not fs.rename(_path(spark, stage)[1], to):
        raise FileExistsError(target)
    return spark.read.schema(few.schema).parquet(target)


def canonical_path(path: Column) -> Column:
    """A path without scheme, percent codes, outer blanks, doubled separators and dot segments, in small letters."""
    plain = F.trim(path)
    plain = F.coalesce(F.try_url_decode(F.regexp_replace(plain, r"\+", "%2B")), plain)
    plain = F.regexp_replace(F.lower(F.trim(F.translate(plain, "\\", "/"))), r"^[a-z][a-z0-9+.-]+:/*", "/")
    step = lambda acc, x: (
        F.when((x == "") | (x == "."), acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, x))
    )
    parts = F.aggregate(F.split(plain, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def cache_columns(path: Column) -> list[Column]:
    """scenario, tech, years and interpolation of the cache that a canonical path lies in; null elsewhere."""
    return [F.nullif(F.regexp_extract(path, CACHE_DIR, k), F.lit("")).alias(name) for k, name in enumerate(("scenario", "tech", "years", "interpolation"), 1)]


def record_hour(t: Column) -> Column:
    """Hours since 1970 of a time given as text or as epoch seconds; null if it is neither."""
    text = F.regexp_extract(t, r"^(\d{4}-\d\d-\d\d)[T ](\d\d)(?::?\d\d){0,2}(?:\.\d+)?Z?$", 0)
    days = F.datediff(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.when(t.rlike(r"^-?\d{1,15}$"), F.floor(F.expr("try_cast(time_text as bigint)") / 3600)).when(text != "", days * 24 + F.substring(text, 12, 2).cast("int"))


def cache_records(files: DataFrame) -> DataFrame:
    """Every record line of every finished file: cache, station, hour, cf, file_id, line_no, written_at."""
    at = once(files.select("file_id", "written_at", "body", "path"), at=canonical_path(F.col("path"))).filter(~F.col("at").rlike(UNFINISHED))
    cache = once(at, **dict(zip(CACHE_KEY, cache_columns(F.col("at"))))).filter(F.col("scenario").isNotNull())
    lines = cache.select("file_id", "written_at", *CACHE_KEY, F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    fields = once(lines, f=F.split(F.regexp_replace("line", r"\r$", ""), "[;,]")).filter(F.size("f") == 3)
    fields = once(fields, station_text=F.trim(F.col("f")[0]), time_text=F.trim(F.col("f")[1]), cf_text=F.trim(F.col("f")[2]))
    known = once(
        fields.filter(F.col("station_text").rlike(r"^[+-]?\d+$")),
        station=F.expr("try_cast(station_text as bigint)"),
        hour=record_hour(F.col("time_text")),
        cf=F.expr("try_cast(cf_text as double)"),
    )
    return known.filter(F.col("station").isNotNull() & F.col("hour").isNotNull()).select(
        *CACHE_KEY, "station", "hour", "cf", "file_id", (F.col("pos") + 1).alias("line_no"), "written_at"
    )


def latest_records(records: DataFrame, part_bytes: int, total_bytes: int) -> DataFrame:
    """Each record once: the latest written_at holds, then the largest file_id, then the largest line_no.

    A cache is cut by (station, hour) into as many buckets as it has part_bytes of all total_bytes; a bucket is what one task ranks.
    """
    spark = records.sparkSession
    rows = written(records.groupBy(*CACHE_KEY).agg(F.count(F.lit(1)).alias("rows")), "sizes")
    row_bytes = total_bytes / max(1, rows.agg(F.sum("rows")).first()[0] or 0)
    sizes = rows.select(*CACHE_KEY, F.greatest(F.ceil(F.col("rows") * row_bytes / part_bytes), F.lit(1)).alias("buckets"))
    n, total = sizes.agg(F.count(F.lit(1)), F.sum("buckets")).first()
    cut = records.join(small(sizes, n), CACHE_KEY).withColumn("bucket", F.pmod(F.xxhash64("station", "hour"), F.col("buckets"))).drop("buckets")
    tasks = max(total or 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    last = Window.partitionBy(*CACHE_KEY, "bucket", "station", "hour").orderBy(*[F.desc_nulls_last(c) for c in ("written_at", "file_id", "line_no")])
    return cut.repartition(tasks, *CACHE_KEY, "bucket").withColumn("rank", F.row_number().over(last)).filter("rank = 1").drop("rank", "bucket")


def compact_caches(files: DataFrame, target_bytes: int = TARGET_BYTES, open_cost: int = OPEN_COST_BYTES) -> DataFrame:
    """The caches of a table of tiny files, each record once, as few files of about target_bytes in a verified folder.

    Three steps through the shared folder: the lines, parsed once; the records, ranked in buckets of a quarter of the
    target; of each cache its parts, packed into combined splits and coalesced without a shuffle. There is one branch of
    the last plan for each cache, as a cache never shares a file with another.
    """
    spark = files.sparkSession
    columns = ["station", "hour", "cf", "file_id", "line_no", "written_at", *CACHE_KEY]
    with settings(spark, **packed(target_bytes, open_cost)):
        lines_at, parts_at = scratch(spark, "lines"), scratch(spark, "parts")
        cache_records(files).write.parquet(lines_at)
        lines = spark.read.parquet(lines_at)
        latest_records(lines, target_bytes // 4, folder_bytes(spark, lines_at)).select(*columns).write.partitionBy(*CACHE_KEY).parquet(parts_at)
        parts = spark.read.schema(lines.select(*columns).schema).parquet(parts_at)
        fs, at = _path(spark, parts_at)
        caches = [str(f.getPath()) for f in fs.globStatus(_path(spark, parts_at + "/*=*" * len(CACHE_KEY))[1]) or []]
        read = spark.read.schema(parts.schema).option("basePath", parts_at)
        few, _ = staged([read.parquet(c).coalesce(max(1, -(-folder_bytes(spark, c) // target_bytes))) for c in caches] or [parts], CACHE_KEY)
        verify(parts, few, [*CACHE_KEY, "station", "hour"], lines)
        return few
