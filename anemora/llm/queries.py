"""Queries of the text operators (problems 4 and 6 to 8)."""

from __future__ import annotations

from anemora.llm import bpe, contamination, percentile_sketch, quality
from anemora.operators.rows import latest
from anemora.session import table


def p4_found(spark, d):
    return percentile_sketch.wrong_thresholds(table(spark, d, "threshold_clim"), table(spark, d, "threshold_grid"))


def p4_percentiles(spark, d):
    """Percentiles of every cell, from the combined sketches of its days."""
    key = [*percentile_sketch.CELL, "run_day", "month_no", "hour_no"]
    days = percentile_sketch.day_sketches(latest(table(spark, d, "threshold_clim"), key, "clim", "loaded_at"))
    return percentile_sketch.percentiles(percentile_sketch.merged(days), [0.05, 0.1, 0.5, 0.9])


def p4_errors(spark, d):
    """Rank errors of the sketches, measured against exact counts over all values."""
    return percentile_sketch.measured_errors(table(spark, d, "threshold_clim"), table(spark, d, "threshold_grid"))


def p6_ids(spark, d):
    return bpe.token_ids(table(spark, d, "documents"))


def p7_found(spark, d):
    return contamination.leaked(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_reparameterised(spark, d):
    """Items whose template recurs in a document with other values in its slots."""
    return contamination.reparameterised(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p8_found(spark, d):
    return quality.not_prose(table(spark, d, "documents"), table(spark, d, "common_word"))


def p8_statistics(spark, d):
    """All statistics of every document, with the reasons of failure."""
    return quality.judged(table(spark, d, "documents"), table(spark, d, "common_word"))


QUERIES = {f.__name__: f for f in (p4_found, p4_percentiles, p4_errors, p6_ids, p7_found, p7_reparameterised, p8_found, p8_statistics)}
P4_SQL = """
with v as (
  select tech, lat_idx, lon_idx, run_day, month_no, hour_no, arg_max(clim, loaded_at) as clim from threshold_clim
  where clim is not null and not isnan(clim) group by all),
g as (select distinct tech, lat_idx, lon_idx, pctl, threshold from threshold_grid where threshold is not null),
s as (select g.tech, g.lat_idx, g.lon_idx, g.pctl, g.threshold, avg(case when clim <= threshold then 1.0 else 0.0 end) as share
  from g join v using (tech, lat_idx, lon_idx) group by all)
select distinct tech, lat_idx, lon_idx, pctl from s where abs(share - pctl / 100.0) > 0.02
"""

ORACLES: dict[str, str] = {"p4_found": P4_SQL}
