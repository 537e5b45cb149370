"""Tables that are read if they exist and derived otherwise."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wattloom.operators.aggregates import daily_with_appliances
from wattloom.operators.joins import join_weather
from wattloom.schemas import APPLIANCE_KWH
from wattloom.sources.readings import read_table


def table_if_present(spark: SparkSession, path) -> DataFrame | None:
    try:
        return read_table(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def daily_with_weather(spark: SparkSession, path, readings: Callable[[], DataFrame],
                       weather: Callable[[], DataFrame], keys=(), weather_keys=()) -> DataFrame:
    """The prepared daily table at ``path``, or else the same columns rebuilt, unrounded."""
    ready = table_if_present(spark, path)
    if ready is not None:
        return ready
    return rebuild_daily(readings(), weather(), keys, weather_keys)


def rebuild_daily(readings: DataFrame, weather: DataFrame, keys=(), weather_keys=()) -> DataFrame:
    return join_weather(daily_with_appliances(readings, keys), weather, weather_keys)


def submetering_if_present(spark: SparkSession, path, keys=()) -> DataFrame | None:
    """Date and appliance energy of the sub-metering table, if there is one."""
    table = table_if_present(spark, path)
    return None if table is None else table.select(*keys, "Date", *APPLIANCE_KWH)
