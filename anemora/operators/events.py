"""Threshold events: one rule per event, evaluated in one narrow projection.

A missing value never fires an event. An event whose columns are missing from the table is left out and listed by
skipped(). Comparisons take the column's own type, so that a FLOAT column meets a FLOAT threshold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.functions.weather import finite


@dataclass(frozen=True)
class EventRule:
    """All of its conditions (column, comparison, threshold) must hold."""

    tech: str
    name: str
    when: tuple[tuple[str, str, float], ...]

    @property
    def requires(self) -> tuple[str, ...]:
        return tuple(c for c, _, _ in self.when)

    def holds(self, types: dict[str, str]) -> Column:
        test = {"<": Column.__lt__, ">": Column.__gt__, ">=": Column.__ge__, "<=": Column.__le__}
        parts = [test[op](finite(F.col(c)), F.lit(x).cast(types[c])) for c, op, x in self.when]
        return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


#: The thresholds in force.
RULES = (
    EventRule("wind", "icing", (("temp_c", "<", -2.0), ("rh_pct", ">=", 85.0))),
    EventRule("wind", "high_temp", (("temp_c", ">", 35.0),)),
    EventRule("wind", "hot_humid", (("temp_c", ">", 30.0), ("rh_pct", ">=", 85.0))),
    EventRule("wind", "high_wind", (("wind_ms", ">", 18.0),)),
    EventRule("solar", "freezing_rain", (("temp_c", "<", 3.0), ("precip_mmh", ">", 0.1))),
    EventRule("solar", "dust", (("dust_aod", ">", 0.5),)),
    EventRule("solar", "rainstorm", (("precip_mmh", ">", 2.0),)),
    EventRule("solar", "high_humidity", (("rh_pct", ">=", 95.0),)),
    EventRule("solar", "cold_highwind", (("temp_c", "<", 5.0), ("wind_ms", ">", 8.0))),
    EventRule("solar", "icing", (("temp_c", "<", -2.0), ("rh_pct", ">=", 85.0))),
)
#: What the older rule set has otherwise.
OLDER = {("wind", "high_wind"): (("wind_ms", ">", 17.0),), ("solar", "freezing_rain"): (("temp_c", "<", 3.0), ("precip_mmh", ">", 0.0)), ("solar", "dust"): (("dust_aod", ">", 0.4),)}
RULESETS = {"current": RULES, "v1": tuple(EventRule(r.tech, r.name, OLDER.get((r.tech, r.name), r.when)) for r in RULES)}


def rules(tech: str | None = None, ruleset: str = "current") -> list[EventRule]:
    return [r for r in RULESETS[ruleset] if tech in (None, r.tech)]


def skipped(df: DataFrame, tech: str, ruleset: str = "current") -> dict[str, str]:
    """Event -> first column it lacks."""
    return {r.name: next(c for c in r.requires if c not in df.columns) for r in rules(tech, ruleset) if set(r.requires) - set(df.columns)}


def readiness(df: DataFrame, tech: str, ruleset: str = "current") -> DataFrame:
    """(event, reason, usable): for every event of a technology the first column it lacks (null if none) and the rows that have all its values."""
    lacking = skipped(df, tech, ruleset)
    ready = {r.name: reduce(lambda a, b: a & b, [finite(F.col(c)).isNotNull() for c in r.requires]) for r in rules(tech, ruleset) if r.name not in lacking}
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(c, 1)).alias(e) for e, c in ready.items()])
    row = lambda r: F.struct(F.lit(r.name).alias("event"), F.lit(lacking.get(r.name)).cast("string").alias("reason"), (F.col(r.name) if r.name in ready else F.lit(0).cast("bigint")).alias("usable"))
    return counts.select(F.inline(F.array(*[row(r) for r in rules(tech, ruleset)])))


def with_signals(df: DataFrame, tech: str, ruleset: str = "current", prefix: str = "signal_", require: tuple[str, ...] = ()) -> DataFrame:
    """df with one 0/1 column per event of a technology that its columns allow."""
    lacking = skipped(df, tech, ruleset)
    if bad := [e for e in require if e in lacking or e not in {r.name for r in rules(tech, ruleset)}]:
        raise ValueError(f"required events cannot be worked out: {bad}")
    types = dict(df.dtypes)
    return df.withColumns({f"{prefix}{r.name}": r.holds(types).cast("tinyint") for r in rules(tech, ruleset) if r.name not in lacking})


def long_signals(df: DataFrame, keys: list[str], prefix: str = "signal_") -> DataFrame:
    """(keys, event, flag): the signal columns of a wide table as rows."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    return df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c[len(prefix):]).alias("event"), F.col(c).cast("int").alias("flag")) for c in cols])))


def exposure(df: DataFrame, by: list[str], prefix: str = "signal_") -> DataFrame:
    """Share of rows in which each event holds."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(c[len(prefix):]) for c in df.columns if c.startswith(prefix)])


def masked(df: DataFrame, keep: Column, prefix: str = "signal_") -> DataFrame:
    """df with every signal 0 where keep does not hold."""
    return df.withColumns({c: F.when(F.coalesce(keep, F.lit(False)), F.col(c)).otherwise(F.lit(0).cast("tinyint")) for c in df.columns if c.startswith(prefix)})
