"""Values in common units, with a trained classifier for units that nobody stated (problem 3).

Every row gets the first unit that is stated: in the reading's own text, in units, in the note, in the source's
attributes. Rows whose stated unit cannot be read, or that state none, get one from a random forest over magnitude,
source, variable, step, neighbouring fields and neighbouring readings (what the stated readings of the same region and
month amount to), trained on rows with a stated unit and calibrated on held-out ones. Confident assignments are
converted; the others are routed to review.

Nulls, NaN and infinite readings have no value and no result row in `converted`. A row sent twice counts once (latest
received_at). Empty tables give empty results; with too few labelled rows to train and to calibrate nothing is predicted
and the rows go to review. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.functions import unit_text as U
from anemora.operators.rows import moment
from anemora.session import once, scratch, written

#: Labelled rows of each variable that the classifier is fitted on, about, and at most but for the chance in drawing them by a hash of row_id.
TRAIN_ROWS = 20_000
CALIBRATION_SHARE = 0.25
CONFIDENT = 0.9
VARS = ("tas", "pr")


def stated(bundle: DataFrame, attrs: DataFrame) -> DataFrame:
    """tas and pr rows, each once, with value, code, factor (of the stated unit), unit_source and unread.

    unread: some text stands where a unit should, and it is neither a known unit nor a known way to say nothing.
    """
    cols = ["source", "region", "scenario", "var_name", "t", "step_hours", "units", "note", "reading", "reading_text"]
    rows = (
        bundle.filter(F.col("var_name").isin(*VARS) & F.col("row_id").isNotNull())
        .groupBy("row_id")
        .agg(F.max_by(F.struct(*cols), moment("received_at")).alias("r"))
        .select("row_id", "r.*")
    )
    # weather_attrs holds one row for each source and variable; it is joined by them and left to the engine to broadcast
    known = attrs.filter(F.col("var_name").isin(*VARS)).groupBy("source", "var_name").agg(F.max("units").alias("attr_units"))
    rows = rows.join(known, ["source", "var_name"], "left")
    filled = F.col("reading_text").isNotNull() & (F.trim("reading_text") != "")
    rows = once(
        rows,
        value=F.when(filled, U.written_number(F.col("reading_text"))).when(~F.isnan("reading"), F.col("reading")),
        text_unit=F.when(filled, U.written_unit(F.col("reading_text"))),
        note_unit=U.unit_phrase(F.col("note")),
    )
    texts = [("reading_text", F.col("text_unit"), True), ("units", F.col("units"), True), ("note", F.col("note_unit"), False), ("weather_attrs", F.col("attr_units"), False)]
    return once(rows, unit=U.first_unit(texts, F.col("var_name"))).select(
        "row_id", "source", "region", "scenario", "var_name", "t", "step_hours", "value",
        F.coalesce("unit.unread", F.lit(False)).alias("unread"), F.col("unit.source").alias("unit_source"), "unit.code", "unit.factor",
    )


@dataclass
class UnitModel:
    """A forest over the labels (units and factors) of both variables and the map from its score to the share of right answers; None with too few labels."""

    forest: PipelineModel | None
    labels: list[str]
    calibration: IsotonicRegressionModel | None
    expected: DataFrame


def expected_values(rows: DataFrame) -> DataFrame:
    """(region, var_name, month, expected): the mean of the stated readings, in K or mm h-1, of all sources; one row for each group."""
    plain = U.canonical_value(F.col("value"), F.col("code"), F.col("factor"), F.col("step_hours"))
    return rows.filter(F.col("code").isNotNull()).groupBy("region", "var_name", F.trunc("t", "month").alias("month")).agg(F.avg(plain).alias("expected"))


def _features(rows: DataFrame, expected: DataFrame) -> DataFrame:
    size, e = F.abs("value"), F.coalesce("expected", F.lit(0.0))
    log = lambda x: F.when(x > 1e-12, F.log10(x)).otherwise(-12.0)
    both = rows.withColumn("month", F.trunc("t", "month")).join(expected, ["region", "var_name", "month"], "left")
    return both.withColumns(
        {
            "magnitude": log(size),
            "signed": F.signum("value"),
            "whole": (F.col("value") == F.floor("value")).cast("double"),
            "decimals": F.length(F.regexp_extract(F.format_string("%.8f", F.col("value")), r"\.(\d*?)0*$", 1)).cast("double"),
            "rain": (F.col("var_name") == "pr").cast("double"),
            "step": F.coalesce(F.col("step_hours"), F.lit(0.0)),
            "season": F.coalesce(F.month("t"), F.lit(0)).cast("double"),
            "hour": F.coalesce(F.hour("t"), F.lit(0)).cast("double"),
            "to_size": log(size) - log(F.abs(e)),
            "to_kelvin": F.col("value") - e,
            "to_celsius": F.col("value") - (e - 273.15),
            "to_fahrenheit": F.col("value") - (e * 1.8 - 459.67),
            "source_name": F.coalesce("source", F.lit("")),
        }
    )


FEATURES = ["magnitude", "signed", "whole", "decimals", "rain", "step", "season", "hour", "to_size", "to_kelvin", "to_celsius", "to_fahrenheit", "source_ix"]


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 11, seed: int = 7) -> UnitModel:
    """Forest and calibration from about train_rows rows of each variable with a stated unit."""
    expected = written(expected_values(rows), "expected")
    labelled = rows.filter(F.col("code").isNotNull() & F.col("value").isNotNull())
    there = {r["var_name"]: r["count"] for r in labelled.groupBy("var_name").count().collect()}
    share = F.create_map(*[F.lit(x) for var, n in there.items() for x in (var, int((1 << 30) * min(1.0, train_rows / n)))]) if there else None
    if share is None:
        return UnitModel(None, [], None, expected)
    drawn = labelled.filter(F.pmod(F.xxhash64("row_id"), F.lit(1 << 30)) < share[F.col("var_name")])
    label = F.concat_ws("|", F.format_string("%.6g", "factor"), "code")
    held = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(1000)) < int(1000 * CALIBRATION_SHARE)
    cases = _features(drawn, expected).select("source_name", *[f for f in FEATURES if f != "source_ix"], label.alias("label"), held.alias("held"))
    # a sample of bounded size: read by few tasks, as often as a tree has levels
    sample = written(cases.coalesce(4), "sample")
    # labels are unit codes, of which there are a few dozen at most
    labels = {r["held"]: set(r["labels"]) for r in sample.groupBy("held").agg(F.collect_set("label").alias("labels")).collect()}
    if len(labels.get(False, ())) < 2 or not labels[False] & labels.get(True, set()):
        return UnitModel(None, [], None, expected)
    kinds = sample.agg(F.count_distinct("source_name")).first()[0]
    stages = [
        StringIndexer(inputCol="label", outputCol="y", handleInvalid="skip"),
        StringIndexer(inputCol="source_name", outputCol="source_ix", handleInvalid="keep"),
        VectorAssembler(inputCols=FEATURES, outputCol="x"),
        RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed, maxBins=max(64, kinds + 2), maxMemoryInMB=512),
    ]
    fitted = Pipeline(stages=stages).fit(sample.filter(~F.col("held"))).stages
    # read back from the shared folder: a fitted forest also carries its training summary, which holds the session and cannot go to tasks
    fitted[-1].save(at := scratch(rows.sparkSession, "forest"))
    forest = PipelineModel([*fitted[1:-1], RandomForestClassificationModel.load(at)])
    checked = forest.transform(fitted[0].transform(sample.filter("held"))).select(F.array_max(vector_to_array("probability")).alias("score"), (F.col("prediction") == F.col("y")).cast("double").alias("right"))
    return UnitModel(forest, fitted[0].labels, IsotonicRegression(featuresCol="score", labelCol="right").fit(checked), expected)


def predict(rows: DataFrame, model: UnitModel, confident: float = CONFIDENT) -> DataFrame:
    """rows without a readable unit: code and factor predicted, confidence, route ('assign' or 'review')."""
    own = rows.filter(F.col("code").isNull() & F.col("value").isNotNull()).drop("code", "factor")
    if model.forest is None:
        out = own.withColumns({"code": F.lit(None).cast("string"), "factor": F.lit(None).cast("double"), "confidence": F.lit(0.0)})
    else:
        scored = model.forest.transform(_features(own, model.expected))
        scored = scored.withColumn("score", F.array_max(vector_to_array("probability")))
        scored = model.calibration.setPredictionCol("confidence").transform(scored)
        label = F.array(*[F.lit(x) for x in model.labels])[F.col("prediction").cast("int")]
        out = scored.select(*own.columns, F.split_part(label, F.lit("|"), F.lit(2)).alias("code"), F.split_part(label, F.lit("|"), F.lit(1)).cast("double").alias("factor"), "confidence")
        # a unit of the other variable is no answer
        fits = F.col("code").isin(*U.TEMPERATURE) == (F.col("var_name") == "tas")
        out = out.withColumn("confidence", F.when(fits, F.col("confidence")).otherwise(0.0))
    return out.withColumn("route", F.when(F.col("confidence") >= confident, "assign").otherwise("review"))


def held_out(bundle: DataFrame, attrs: DataFrame, share: float = 0.2, train_rows: int = TRAIN_ROWS, confident: float = CONFIDENT) -> DataFrame:
    """(var_name, hidden, assigned, right_assigned, right_all, mean_confidence): how well units that were stated, but hidden from the classifier, are told.

    The classifier sees no text of any row. A hash of row_id hides a share of the stated rows from training and from the expected values.
    """
    rows = written(stated(bundle, attrs).filter(F.col("code").isNotNull() & F.col("value").isNotNull()), "stated")
    hidden = F.pmod(F.xxhash64("row_id", F.lit(23)), F.lit(1000)) < int(1000 * share)
    model = fit(rows.filter(~hidden), train_rows)
    asked = rows.filter(hidden).withColumns({"was": F.col("code"), "was_factor": F.col("factor"), "code": F.lit(None).cast("string"), "factor": F.lit(None).cast("double")})
    out = predict(asked, model, confident)
    right = F.coalesce((F.col("code") == F.col("was")) & (F.abs(F.col("factor") - F.col("was_factor")) < 1e-9), F.lit(False)).cast("double")
    sure = F.col("route") == "assign"
    return out.groupBy("var_name").agg(
        F.count(F.lit(1)).alias("hidden"), F.count(F.when(sure, 1)).alias("assigned"), F.avg(F.when(sure, right)).alias("right_assigned"), F.avg(right).alias("right_all"), F.avg(F.when(sure, F.col("confidence"))).alias("mean_confidence")
    )


def convert_units(bundle: DataFrame, attrs: DataFrame, train_rows: int = TRAIN_ROWS, confident: float = CONFIDENT) -> DataFrame:
    """(row_id, var_name, code, factor, unit_source, unread, confidence, route, value, canonical) of every tas and pr row with a value.

    unit_source: reading_text, units, note, weather_attrs or classifier; route: stated, assign or review; canonical is in
    K or mm h-1 and null for review.
    """
    rows = written(stated(bundle, attrs), "stated")
    model = fit(rows, train_rows)
    known = rows.filter(F.col("code").isNotNull() & F.col("value").isNotNull()).withColumns({"confidence": F.lit(1.0), "route": F.lit("stated")})
    both = known.unionByName(predict(rows, model, confident).withColumn("unit_source", F.lit("classifier")))
    canonical = F.when(F.col("route") != "review", U.canonical_value(F.col("value"), F.col("code"), F.col("factor"), F.col("step_hours")))
    return both.select("row_id", "source", "region", "var_name", "t", "step_hours", "value", "unread", "unit_source", "code", "factor", "confidence", "route", canonical.alias("canonical"))


def restated(converted: DataFrame) -> DataFrame:
    """(row_id, value_milli): rows whose stated unit is another than K or mm h-1, the value in those, times 1000.

    A unit that is stated but cannot be read counts if the classifier is confident of it.
    """
    plain = (F.col("factor") == 1.0) & F.col("code").isin("K", "mm/h")
    return converted.filter(((F.col("route") == "stated") | (F.col("unread") & (F.col("route") == "assign"))) & ~plain & F.col("canonical").isNotNull()).select(
        "row_id", F.round(F.col("canonical") * 1000).cast("bigint").alias("value_milli")
    )
