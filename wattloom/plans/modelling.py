"""Features, training, scoring, monitoring and drift as one pipeline over the layout."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.operators import aggregates, drift, joins, learning, monitoring, registry, series
from wattloom.operators.splits import time_split
from wattloom.schemas import MODEL_VERSION
from wattloom.sinks.tables import land, location, write_parquet, write_report
from wattloom.sources.readings import read_table
from wattloom.sources.tables import daily_with_weather, submetering_if_present


def build_features(spark: SparkSession, base: str, weather: DataFrame, keys=()) -> DataFrame:
    """The feature table, from the prepared daily table or rebuilt from the readings."""
    daily = daily_with_weather(spark, location(base, "daily_weather"),
                               lambda: read_table(spark, location(base, "cleaned")),
                               lambda: weather, keys)
    daily = joins.join_submetering(
        daily, submetering_if_present(spark, location(base, "submetering"), keys), keys)
    land(series.feature_table(daily, keys), base, "features")
    return read_table(spark, location(base, "features"))


def train_models(features: DataFrame, strict=False, **forest_params):
    """(best, forest, boosted), fitted on the first 80% of the days."""
    table = time_split(features).persist()
    try:
        forest = learning.train_and_test(learning.forest(**forest_params), table, "random_forest",
                                         strict)
        boosted = learning.train_and_test(learning.boosted(), table, "gradient_boosting", strict,
                                          forest.features, forest.medians)
    finally:
        table.unpersist()
    return learning.choose_best(forest, boosted), forest, boosted


def deploy(spark: SparkSession, base: str, fitted: learning.Fitted, features: DataFrame,
           version=MODEL_VERSION) -> DataFrame:
    """Register the model, score the feature table, write predictions and monthly roll-up."""
    days = time_split(features).groupBy("split").agg(
        F.min("Date").alias("first"), F.max("Date").alias("last"))
    spans = {r["split"]: (r["first"], r["last"]) for r in days.collect()}  # two rows
    model_path = registry.register(spark, location(base, "registry"), fitted, version,
                                   spans["train"], spans["test"])
    scored = learning.batch_score(fitted, features, version, model_path)
    path = f"{location(base, 'predictions')}/{version}"
    write_parquet(scored, path)
    predictions = read_table(spark, path)
    write_parquet(aggregates.prediction_months(predictions),
                  f"{location(base, 'predictions_monthly')}/{version}")
    return predictions


def monitor(spark: SparkSession, base: str, predictions: DataFrame, features: DataFrame,
            version=MODEL_VERSION) -> DataFrame:
    """Write the monitoring log and the drift report; return the monthly monitoring table."""
    monitored = monitoring.with_alerts(monitoring.rolling_errors(predictions))
    land(monitoring.monitor_log(monitored), base, "monitoring")
    write_report(drift.drift_report(time_split(features), version), location(base, "drift"))
    return monitoring.monitor_months(monitored)
