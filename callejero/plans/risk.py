"""Probability of an incident by place and hour: features and a random forest."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_S = 3600
DAY_S = 86_400
#: hours before that count as recent
RECENT_HOURS = 24
NUMBERS = ["n_counts", "mean_intensity", "max_intensity", "hour", "weekday", "temperature", "recent_incidents", "recent_intensity"]


def slot(stamp: Column) -> Column:
    """Number of the hour since 1970."""
    return F.floor(F.unix_timestamp(stamp) / HOUR_S).cast("bigint")


def incident_features(counts: DataFrame, incidents: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per place and hour with traffic counts, and whether an incident happened there then.

    ``counts``: place, stamp, intensity; ``incidents``: place, stamp; ``weather``: day, temperature (a
    day without weather has none). Rows without a stamp are left out. Both tables are summed up by
    place and hour before anything is joined, so windows run over hours of a place, not over rows.
    """
    at = slot(F.col("stamp"))
    flow = counts.filter("stamp IS NOT NULL").groupBy("place", at.alias("slot")).agg(
        F.count(F.lit(1)).alias("n_counts"), F.round(F.avg("intensity"), 6).alias("mean_intensity"),
        F.max("intensity").alias("max_intensity"))
    hit = incidents.filter("stamp IS NOT NULL").groupBy("place", at.alias("slot")).agg(F.count(F.lit(1)).alias("n_incidents"))
    cells = flow.join(hit, ["place", "slot"], "full")
    recent = Window.partitionBy("place").orderBy("slot").rangeBetween(-RECENT_HOURS, -1)
    cells = cells.withColumns({
        "recent_incidents": F.coalesce(F.sum("n_incidents").over(recent), F.lit(0)),
        "recent_intensity": F.coalesce(F.round(F.avg("mean_intensity").over(recent), 6), F.lit(0.0))})
    cells = cells.filter("n_counts IS NOT NULL").withColumns({
        "hour": F.pmod("slot", F.lit(24)).cast("int"),
        "weekday": (F.pmod(F.floor(F.col("slot") / 24) + 3, F.lit(7)) + 1).cast("int"),
        "day": F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("slot") / 24).cast("int")),
        "label": F.when(F.col("n_incidents") > 0, 1).otherwise(0)})
    # one row per day, however many places there are
    known = weather.groupBy("day").agg(F.round(F.avg("temperature"), 6).alias("temperature"))
    return cells.join(known, "day", "left").select(
        "place", "slot", "day", *NUMBERS[:5], "temperature", "recent_incidents", "recent_intensity", "label")


def split_day(features: DataFrame, share: float = 0.75) -> Column:
    """The first day held out: the share of rows before it is about ``share``. The split is by time, as it is in use."""
    days = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    return features.agg(F.date_add(F.lit("1970-01-01").cast("date"), F.percentile_approx(days, share, 10_000)).alias("d")).scalar()


def forest(seed: int = 42, trees: int = 40, depth: int = 8) -> Pipeline:
    """Place index, features, forest. Missing numbers become -1, which no feature takes; a place not
    seen in training gets an index of its own."""
    return Pipeline(stages=[
        StringIndexer(inputCol="place", outputCol="place_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=[*NUMBERS, "place_index"], outputCol="features"),
        RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed,
                               maxBins=512, subsamplingRate=0.8),
    ])


def _complete(features: DataFrame) -> DataFrame:
    return features.fillna(-1.0, NUMBERS).withColumn("place", F.coalesce("place", F.lit("")))


def fit(features: DataFrame, **settings) -> PipelineModel:
    return forest(**settings).fit(_complete(features))


def probabilities(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``probability`` of an incident."""
    columns = features.columns
    scored = model.transform(_complete(features))
    return scored.withColumn("probability", vector_to_array("probability")[1]).select(*columns, "probability")


def auc(scored: DataFrame) -> float:
    rows = scored.select(F.col("label").cast("double").alias("label"), F.col("probability").alias("rawPrediction"))
    return BinaryClassificationEvaluator().evaluate(rows)
