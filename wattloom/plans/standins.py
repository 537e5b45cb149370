"""The star-schema tables in the roles of readings, weather, daily series and messages.

* ``events`` are readings: ``ts`` is the time, ``value`` the power, and the event type decides
  which sub-meter a reading belongs to.
* ``orders`` by day are the daily series; the order priority stands for the appliance group.
* ``lineitem`` by ship date is the daily weather.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.numbers import steady_round
from wattloom.operators.clean import with_month_columns
from wattloom.operators.joins import join_weather
from wattloom.operators.series import add_lags, feature_table
from wattloom.operators.scoring import mae_interval, scored_table
from wattloom.schemas import MEASURES, POWER, SUBMETERS

SUBMETER_OF_EVENT = dict(zip(["view", "click", "purchase", "signup"], SUBMETERS))
APPLIANCE_OF_PRIORITY = {"1-URGENT": "kitchen", "2-HIGH": "laundry", "3-MEDIUM": "hvac",
                         "4-NOT SPECIFIED": "other"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_readings(events: DataFrame, keep=()) -> DataFrame:
    meters = {m: F.when(F.col("event_type") == e, F.col("value")).otherwise(0.0)
              for e, m in SUBMETER_OF_EVENT.items()}
    return with_month_columns(events.select(
        *keep, F.col("ts").cast("timestamp").alias("Datetime"), F.col("value").alias(POWER),
        *[c.alias(m) for m, c in meters.items()]))


def readings(spark, sf, keep=()) -> DataFrame:
    return as_readings(table(spark, sf, "events"), keep)


def dirty(value, kind, label):
    """Text of a measure with every form of missing value, by event type and size."""
    return (F.when(kind == label, "?").when(value < 2, "").when(value < 4, "  ")
            .when(value < 6, F.lit(None)).when(value < 7, "abc").otherwise(value.cast("string")))


def raw_text(spark, sf, keep=()) -> DataFrame:
    """Raw readings as text, with missing tokens, blanks, unreadable numbers and dates."""
    e = table(spark, sf, "events")
    value, kind = F.col("value"), F.col("event_type")
    text = value.cast("string")
    day = F.when(value > 200, F.lit("31/31/2024")).otherwise(F.date_format("ts", "d/M/yyyy"))
    measures = {
        "Global_active_power": dirty(value, kind, "error"),
        "Global_reactive_power": F.when(kind == "click", "?").otherwise(text),
        "Voltage": F.concat(F.lit(" "), text, F.lit(" ")),
        "Global_intensity": F.when(value < 10, "").otherwise(text),
        "Sub_metering_1": F.when(kind == "view", F.lit(None)).otherwise(text),
        "Sub_metering_2": F.lit("1.5"),
        "Sub_metering_3": F.when(kind == "purchase", " ? ").otherwise(text),
    }
    return e.select(*keep, day.alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"),
                    *[measures[m].alias(m) for m in MEASURES])


def daily_series(spark, sf, keys=(), appliances=False) -> DataFrame:
    """Daily table of the orders: totals in units of 100,000."""
    o = table(spark, sf, "orders")
    price, unit = F.col("o_totalprice"), 1e5
    sums = [steady_round(F.sum(F.when(F.col("o_orderpriority") == p, price).otherwise(0.0)) / unit, 4)
            .alias(f"{a}_kwh") for p, a in APPLIANCE_OF_PRIORITY.items()] if appliances else []
    daily = o.groupBy(*keys, F.to_date("o_orderdate").alias("Date")).agg(
        steady_round(F.sum(price) / unit, 4).alias("total_kwh"),
        steady_round(F.avg(price) / unit, 4).alias("avg_kw"),
        steady_round(F.max(price) / unit, 4).alias("peak_kw"),
        F.count(F.lit(1)).alias("minutes_recorded"), *sums)
    return with_month_columns(daily, "Date")


def weather(spark, sf) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("Date")).agg(
        steady_round(F.avg(quantity) - 5, 4).alias("temp_mean_c"),
        F.max(quantity).alias("temp_max_c"), F.min(quantity).alias("temp_min_c"),
        steady_round(F.greatest(F.sum("l_tax") - 0.8, F.lit(0.0)), 4).alias("precip_mm"))


def daily_weather(spark, sf, keys=(), appliances=True) -> DataFrame:
    return join_weather(daily_series(spark, sf, keys, appliances), weather(spark, sf))


def features(spark, sf, keys=()) -> DataFrame:
    return feature_table(daily_weather(spark, sf, keys), keys)


def naive_scored(spark, sf, keys=(), mae=2.0) -> DataFrame:
    """Predictions table of the predictor 'same as seven rows ago'."""
    lagged = add_lags(daily_weather(spark, sf, keys, appliances=False), keys)
    scored = lagged.where(F.col("lag_7_kwh").isNotNull()).withColumn(
        "prediction", F.col("lag_7_kwh"))
    lower, upper = mae_interval(F.col("prediction"), mae)
    return scored_table(scored, lower, upper, keys=keys)
