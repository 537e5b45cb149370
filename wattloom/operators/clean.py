"""Cleaning of raw readings and weather rows."""

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.cleaning import clean_double, reading_time
from wattloom.functions.numbers import steady_round
from wattloom.schemas import (MEASURES, POWER, REMAINDER, SUBMETERS, WEATHER_DATE_FORMAT,
                              WEATHER_NAMES)


def remainder(power=POWER, submeters=SUBMETERS[:3]):
    """Energy of the minute (Wh) that no sub-meter accounts for."""
    unmetered = F.col(power) * 1000.0 / 60.0
    for meter in submeters:
        unmetered = unmetered - F.col(meter)
    return steady_round(unmetered, 4)


def type_readings(raw: DataFrame, keep=()) -> DataFrame:
    """Typed measures, event time and remainder; the raw text columns are gone."""
    typed = raw.select(
        *keep,
        *[clean_double(F.col(c)).alias(c) for c in MEASURES],
        reading_time(F.col("Date"), F.col("Time")).alias("Datetime"),
    )
    return typed.withColumn(REMAINDER, remainder())


def with_month_columns(df: DataFrame, time="Datetime") -> DataFrame:
    return df.withColumns({"Year": F.year(time), "Month": F.month(time)})


def clean_readings(raw: DataFrame, keep=()) -> DataFrame:
    """Rows with a usable power reading, typed and with partition columns."""
    return with_month_columns(type_readings(raw, keep).where(F.col(POWER).isNotNull()))


def drop_report(typed: DataFrame) -> DataFrame:
    """Rows before and after the mandatory-measure filter, in one pass."""
    total, kept = F.count(F.lit(1)), F.count(POWER)
    return typed.agg(
        total.alias("total_rows"),
        kept.alias("clean_rows"),
        (total - kept).alias("dropped_rows"),
        F.round(F.try_divide((total - kept) * 100.0, total), 2).alias("dropped_pct"),
    )


def clean_weather(raw: DataFrame) -> DataFrame:
    """Date-typed weather rows with partition columns; ``time`` becomes ``Date``."""
    dated = raw.withColumnRenamed("time", "Date").withColumn(
        "Date", F.try_to_date(F.col("Date").cast("string"), WEATHER_DATE_FORMAT))
    return with_month_columns(dated, "Date")


def weather_measures(weather: DataFrame, keys=()) -> DataFrame:
    """Only the measures the daily join uses, under their short names."""
    return weather.select(*keys, "Date", *[F.col(a).alias(b) for a, b in WEATHER_NAMES.items()])


def conform_types(df: DataFrame) -> DataFrame:
    """Cast the well-known columns that are present to their proper types."""
    wanted = {"Datetime": "timestamp", "Year": "int", "Month": "int", "Date": "date"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in wanted.items() if c in df.columns})
