"""Session helpers: tables, shared scratch folders and size-checked broadcasts."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it was counted and has at most so many rows; beyond that the join shuffles.
BROADCAST_ROWS = 2_000_000
#: Name under which the package's code goes to the workers.
SHIPPED = "anemora_code.zip"
_scratch: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Where the session names none: a new folder under /tmp in local mode, an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(at)
    return at


def scratch(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing else uses."""
    at = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(at)
    return at


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to scratch paths; results that read from there are of no use afterwards."""
    for at in _scratch.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shipped(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session; those of a cluster, or of another working folder, do not have it otherwise."""
    sc = spark.sparkContext
    if any(p.endswith(SHIPPED) for p in sc._python_includes):
        return
    root = Path(__file__).parent
    code = io.BytesIO()
    with zipfile.ZipFile(code, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    at = f"{scratch(spark, 'code')}/{SHIPPED}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(code.getvalue())
    out.close()
    sc.addPyFile(at)


def written(df: DataFrame, what: str = "table") -> DataFrame:
    """The rows of df as a table in the shared folder: columnar, without lineage, read as often as needed."""
    at = scratch(df.sparkSession, what)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows, else as it is."""
    return F.broadcast(df) if rows <= limit else df


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns that are worked out once a row, however many later filters and columns use them.

    A filter over an alias is otherwise pushed below the projection, which repeats costly expressions there.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings for the time of one action; dots are written as two underscores."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
