"""Rolling error metrics of predictions, alerts, and the monthly monitoring table."""

from pyspark.sql import DataFrame, functions as F

from wattloom.operators.series import _min_rows, over_series
from wattloom.schemas import (ALERTS_PER_MONTH, MAE_ALERT, MAPE_ALERT, MONITOR_MIN_ROWS,
                              MONITOR_ROWS)


def rolling_errors(predictions: DataFrame, keys=(), block_rows=None) -> DataFrame:
    """Mean errors of the current and the 29 rows before it, once 7 are known."""
    def build(window):
        frame = window.rowsBetween(1 - MONITOR_ROWS, 0)
        return {"rolling_mae": _min_rows("abs_error", frame, F.avg, MONITOR_MIN_ROWS),
                "rolling_mape": _min_rows("pct_error", frame, F.avg, MONITOR_MIN_ROWS)}
    return over_series(predictions, build, MONITOR_ROWS - 1, keys=keys, block_rows=block_rows)


def with_alerts(rolling: DataFrame, mae=MAE_ALERT, mape=MAPE_ALERT) -> DataFrame:
    def above(c, limit):
        return F.coalesce(F.col(c) > limit, F.lit(False))
    return rolling.withColumns({"mae_alert": above("rolling_mae", mae),
                                "mape_alert": above("rolling_mape", mape)})


def alert_totals(monitored: DataFrame) -> DataFrame:
    return monitored.agg(F.count_if("mae_alert").alias("n_mae_alerts"),
                         F.count_if("mape_alert").alias("n_mape_alerts"))


def monitor_months(monitored: DataFrame, keys=(), limit=ALERTS_PER_MONTH) -> DataFrame:
    return (monitored.groupBy(*keys, "Year", "Month")
            .agg(F.avg("abs_error").alias("avg_mae"), F.avg("pct_error").alias("avg_mape"),
                 F.count_if("mae_alert").alias("n_mae_alerts"),
                 F.count_if("mape_alert").alias("n_mape_alerts"),
                 F.count("abs_error").alias("n_days"))
            .withColumn("flag", F.when((F.col("n_mae_alerts") > limit)
                                       | (F.col("n_mape_alerts") > limit), "Alert")
                        .otherwise("")))


def monitor_log(monitored: DataFrame, keys=()) -> DataFrame:
    """The rows that have both rolling metrics."""
    return (monitored.select(*keys, "Date", "rolling_mae", "rolling_mape", "mae_alert",
                             "mape_alert").dropna())
