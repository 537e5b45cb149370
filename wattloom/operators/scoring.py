"""Model metrics, scored tables and reports on them."""

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.functions.cleaning import at_least_zero
from wattloom.functions.numbers import steady_round
from wattloom.schemas import DEFAULT_MAE, INTERVAL_MAE, MAPE_FLOOR, MODEL_VERSION, SEED, TARGET


def floored(actual: Column) -> Column:
    """Denominator of percentage errors: |actual|, but not below the floor; NULL stays NULL."""
    return F.when(actual.isNotNull(), F.greatest(F.abs(actual), F.lit(MAPE_FLOOR)))


def metric_columns(actual="actual", predicted="prediction") -> list[Column]:
    """MAE, RMSE, R2, MAPE as aggregates, so several groups can be evaluated in one pass."""
    y, p = F.col(actual), F.col(predicted)
    err = y - p
    # var_pop * count is the sum of squares about the mean, computed stably.
    spread = F.var_pop(F.when(p.isNotNull(), y)) * F.count(err)
    return [F.avg(F.abs(err)).alias("MAE"),
            F.sqrt(F.avg(err * err)).alias("RMSE"),
            (1 - F.try_divide(F.sum(err * err), spread)).alias("R2"),
            (F.avg(F.abs(err) / floored(y)) * 100).alias("MAPE")]


def evaluate(df: DataFrame, label: str, actual=TARGET, predicted="prediction") -> DataFrame:
    return df.agg(*metric_columns(actual, predicted)).select(F.lit(label).alias("model"), "*")


def baseline_improvement(df: DataFrame, actual=TARGET, predicted="prediction") -> DataFrame:
    """MAE of always predicting the mean, and how much better the predictions are (percent)."""
    mean = df.agg(F.avg(actual)).scalar()
    errors = df.select(F.abs(F.col(actual) - mean).alias("of_mean"),
                       F.abs(F.col(actual) - F.col(predicted)).alias("of_model"))
    return (errors.agg(F.avg("of_mean").alias("baseline_mae"),
                       F.avg("of_model").alias("model_mae"))
            .withColumn("improvement_pct",
                        (1 - F.try_divide(F.col("model_mae"), F.col("baseline_mae"))) * 100))


def mae_interval(predicted: Column, mae: Column | float = DEFAULT_MAE) -> tuple[Column, Column]:
    """Interval of a model without per-tree spread."""
    margin = (mae if isinstance(mae, Column) else F.lit(float(mae))) * INTERVAL_MAE
    return predicted - margin, predicted + margin


def scored_table(df: DataFrame, lower: Column, upper: Column, predicted="prediction",
                 version=MODEL_VERSION, keys=()) -> DataFrame:
    """The predictions table: rounded prediction, interval and errors per row."""
    y, p = F.col(TARGET), F.col(predicted)
    return df.select(
        *keys, "Date", y.alias("actual_kwh"),
        steady_round(p, 4).alias("predicted_kwh"),
        steady_round(at_least_zero(lower), 4).alias("lower_bound"),
        steady_round(upper, 4).alias("upper_bound"),
        steady_round(F.abs(y - p), 4).alias("abs_error"),
        steady_round(F.abs(y - p) / floored(y) * 100, 2).alias("pct_error"),
        F.year("Date").alias("Year"), F.month("Date").alias("Month"),
        F.lit(version).alias("model_version"))


def score_summary(predictions: DataFrame) -> DataFrame:
    inside = F.col("actual_kwh").between(F.col("lower_bound"), F.col("upper_bound"))
    return predictions.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.avg("predicted_kwh").alias("mean_predicted"),
        F.avg("actual_kwh").alias("mean_actual"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("pct_error").alias("mean_pct_error"),
        (F.count_if(inside) * 100.0 / F.count(F.lit(1))).alias("within_interval_pct"))


def prediction_sample(predictions: DataFrame, n=10, seed=SEED) -> DataFrame:
    """``n`` rows in an order fixed by a hash of date and seed: random, but repeatable."""
    draw = F.md5(F.concat_ws(":", F.date_format("Date", "yyyy-MM-dd"), F.lit(str(seed))))
    return predictions.orderBy(draw, "Date").limit(n).orderBy("Date")


def prediction_preview(scored: DataFrame, models: dict[str, str], n=10) -> DataFrame:
    """First ``n`` days with the prediction and signed error of each model."""
    columns = [c for name, p in models.items() for c in
               (steady_round(p, 3).alias(f"{name}_pred"),
                steady_round(F.col(TARGET) - F.col(p), 3).alias(f"{name}_err"))]
    return (scored.orderBy("Date").limit(n)
            .select("Date", steady_round(TARGET, 3).alias("actual"), *columns))


def worst_predictions(predictions: DataFrame, n=5) -> DataFrame:
    return (predictions.orderBy(F.col("abs_error").desc_nulls_last(), "Date").limit(n)
            .select("Date", "actual_kwh", "predicted_kwh", "abs_error", "pct_error"))
