"""Hourly, daily and monthly aggregates of readings.

All are hash aggregations of algebraic functions: partial sums are formed before the shuffle,
so a hot key costs one row per task there, however many readings it has. ``keys`` adds series
keys (meter, site) in front of the time grain. Nothing is sorted; order when presenting.
"""

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.numbers import pearson, steady_round
from wattloom.operators.profile import per_column
from wattloom.schemas import (APPLIANCES, APPLIANCE_KWH, APPLIANCE_PCT, POWER, SUBMETERS, TARGET)

MONTHLY_APPLIANCES = ["avg_sm1_kitchen_wh", "avg_sm2_laundry_wh", "avg_sm3_hvac_wh",
                      "avg_sm_other_wh"]


def _rounder(digits):
    return (lambda c: steady_round(c, digits)) if digits is not None else (lambda c: c)


def hourly_patterns(readings: DataFrame, keys=()) -> DataFrame:
    kw = F.col(POWER)
    return readings.groupBy(*keys, F.hour("Datetime").alias("Hour")).agg(
        steady_round(F.avg(kw), 4).alias("avg_kw"),
        steady_round(F.max(kw), 4).alias("peak_kw"),
        steady_round(F.min(kw), 4).alias("min_kw"),
        steady_round(F.stddev(kw), 4).alias("stddev_kw"),
        F.count(F.lit(1)).alias("record_count"),
    )


def _kwh(digits):
    return _rounder(digits)(F.sum(POWER) / 60.0).alias(TARGET)


def _power_measures(digits):
    r = _rounder(digits)
    return [_kwh(digits), r(F.avg(POWER)).alias("avg_kw"), r(F.max(POWER)).alias("peak_kw")]


def _appliance_sums(digits):
    r = _rounder(digits)
    return [r(F.sum(m) / 1000.0).alias(c) for m, c in zip(SUBMETERS, APPLIANCE_KWH)]


def _by_day(readings, keys):
    return readings.groupBy(*keys, F.to_date("Datetime").alias("Date"), "Year", "Month")


def daily_totals(readings: DataFrame, keys=(), digits=4) -> DataFrame:
    return _by_day(readings, keys).agg(
        *_power_measures(digits), F.count(F.lit(1)).alias("minutes_recorded"))


def daily_with_appliances(readings: DataFrame, keys=(), digits=None) -> DataFrame:
    """Daily totals and sub-meter energy in one pass (the rebuild path; unrounded)."""
    return _by_day(readings, keys).agg(
        *_power_measures(digits), F.count(POWER).alias("minutes_recorded"),
        *_appliance_sums(digits))


def monthly_summary(readings: DataFrame, keys=()) -> DataFrame:
    return readings.groupBy(*keys, "Year", "Month").agg(
        *_power_measures(4),
        steady_round(F.stddev(POWER), 4).alias("stddev_kw"),
        *[steady_round(F.avg(m), 4).alias(n) for m, n in zip(SUBMETERS, MONTHLY_APPLIANCES)],
        F.count(F.lit(1)).alias("minutes_recorded"),
    )


def submetering_daily(readings: DataFrame, keys=()) -> DataFrame:
    """Daily energy per appliance group and its share of the day's rounded total."""
    return _with_shares(_by_day(readings, keys).agg(*_appliance_sums(4), _kwh(4)))


def _with_shares(daily: DataFrame) -> DataFrame:
    return daily.withColumns({
        pct: steady_round(F.try_divide(F.col(kwh), F.col(TARGET)) * 100, 2)
        for kwh, pct in zip(APPLIANCE_KWH, APPLIANCE_PCT)})


# ---- One scan for all batch tables -------------------------------------------------------

def hourly_cells(readings: DataFrame, keys=()) -> DataFrame:
    """Per day and hour all that the batch tables need: counts, sums, extremes, variance.

    The only pass over the readings; the tables below are roll-ups of this small one.
    """
    return readings.groupBy(*keys, F.to_date("Datetime").alias("Date"), "Year", "Month",
                            F.hour("Datetime").alias("Hour")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(POWER).alias("n"),
        F.sum(POWER).alias("total"), F.max(POWER).alias("peak"), F.min(POWER).alias("low"),
        F.avg(POWER).alias("mean"), F.var_pop(POWER).alias("variance"),
        *[c for m in SUBMETERS for c in (F.sum(m).alias(m), F.count(m).alias(f"n_{m}"))])


def _power_rollup():
    return [steady_round(F.sum("total") / 60.0, 4).alias(TARGET),
            steady_round(F.try_divide(F.sum("total"), F.sum("n")), 4).alias("avg_kw"),
            steady_round(F.max("peak"), 4).alias("peak_kw")]


def _stddev_rollup():
    """Sample deviation from the cells: inside them, plus of their means about the whole mean."""
    n, mean = F.sum("n"), F.try_divide(F.sum("total"), F.sum("n"))
    inside = F.sum(F.col("n") * F.col("variance"))
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    spread = F.greatest(inside + between, F.lit(0.0))
    return steady_round(F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1))), 4).alias("stddev_kw")


def hourly_from_cells(cells: DataFrame, keys=()) -> DataFrame:
    _, avg, peak = _power_rollup()
    return cells.groupBy(*keys, "Hour").agg(
        avg, peak, steady_round(F.min("low"), 4).alias("min_kw"), _stddev_rollup(),
        F.sum("n_rows").alias("record_count"))


def daily_from_cells(cells: DataFrame, keys=()) -> DataFrame:
    return cells.groupBy(*keys, "Date", "Year", "Month").agg(
        *_power_rollup(), F.sum("n_rows").alias("minutes_recorded"))


def monthly_from_cells(cells: DataFrame, keys=()) -> DataFrame:
    return cells.groupBy(*keys, "Year", "Month").agg(
        *_power_rollup(), _stddev_rollup(),
        *[steady_round(F.try_divide(F.sum(m), F.sum(f"n_{m}")), 4).alias(n)
          for m, n in zip(SUBMETERS, MONTHLY_APPLIANCES)],
        F.sum("n_rows").alias("minutes_recorded"))


def submetering_from_cells(cells: DataFrame, keys=()) -> DataFrame:
    return _with_shares(cells.groupBy(*keys, "Date", "Year", "Month").agg(
        *[steady_round(F.sum(m) / 1000.0, 4).alias(c) for m, c in zip(SUBMETERS, APPLIANCE_KWH)],
        steady_round(F.sum("total") / 60.0, 4).alias(TARGET)))


# ---- Reports on aggregates ----------------------------------------------------------------

def submetering_share_avg(submetering: DataFrame) -> DataFrame:
    return submetering.agg(*[steady_round(F.avg(f"{a}_pct"), 2).alias(f"{a}_pct") for a in APPLIANCES])


def daily_group_count(readings: DataFrame) -> DataFrame:
    """Number of days with readings."""
    return (readings.groupBy(F.to_date("Datetime").alias("Date"))
            .agg(F.sum(POWER).alias("total_power"))
            .agg(F.count(F.lit(1)).alias("daily_groups")))


def correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    """Pearson correlation over the pairs where both sides are known, and its sign in words."""
    r = pearson(left, right)
    return df.agg(r.alias("correlation")).withColumn(
        "interpretation",
        F.when(F.col("correlation") < 0, "negative").when(F.col("correlation").isNotNull(),
                                                          "positive"))


def correlation_ranking(features: DataFrame, columns, target=TARGET, top=10) -> DataFrame:
    """Features by absolute correlation with the target, strongest first.

    One aggregate over all columns at once: no row is repeated for a feature.
    """
    long = per_column(features, columns, lambda c: [pearson(c, target).alias("correlation")])
    return (long.withColumnRenamed("column", "feature")
            .where(F.col("correlation").isNotNull())
            .withColumn("direction", F.when(F.col("correlation") > 0, "up").otherwise("down"))
            .orderBy(F.abs("correlation").desc(), "feature").limit(top))


def prediction_months(predictions: DataFrame, keys=()) -> DataFrame:
    return predictions.groupBy(*keys, "Year", "Month").agg(
        F.sum("actual_kwh").alias("actual_kwh_sum"),
        F.sum("predicted_kwh").alias("predicted_kwh_sum"),
        F.avg("pct_error").alias("mean_pct_error"),
        F.count("actual_kwh").alias("n_days"),
    )
