"""Rows sent twice: the latest one of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(order: str) -> Column:
    """A time to order by; one that is missing comes before all others."""
    return F.coalesce(F.col(order).cast("timestamp_ntz"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))


def latest(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """(key, value): one value per key, that of the latest order; of equal ones the largest, null last.

    Both aggregates keep numbers and times only, so that they hash and need no sort.
    """
    each = df.groupBy(*key, moment(order).alias("_at")).agg(F.max(value).alias(value))
    return each.groupBy(*key).agg(F.max_by(value, "_at").alias(value))


def latest_rows(df: DataFrame, key: list[str], values: list[str], order: str) -> DataFrame:
    """(key, values): the values of each key's latest row. Copies sent at one time must not differ; if they do, any of each value stays.

    Numbers and times hash; with texts among the values the engine sorts.
    """
    return df.groupBy(*key).agg(*[F.max_by(v, moment(order)).alias(v) for v in values])
