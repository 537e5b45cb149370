"""Batch aggregates and the weather join, written to the layout."""

from pyspark.sql import DataFrame, SparkSession

from wattloom.operators import aggregates, joins
from wattloom.session import written
from wattloom.sinks.tables import land, location
from wattloom.sources.readings import read_table


def run_batch(spark: SparkSession, base: str, weather: DataFrame, keys=(),
              weather_keys=()) -> None:
    """All batch tables from the cleaned readings, which are scanned once.

    The scan yields one row per day and hour; that small table is stored and rolled up. ``daily``
    is read back for the join, so it is computed once as well.
    """
    readings = read_table(spark, location(base, "cleaned"))
    cells = written(aggregates.hourly_cells(readings, keys), "cells")
    land(aggregates.hourly_from_cells(cells, keys), base, "hourly")
    land(aggregates.daily_from_cells(cells, keys), base, "daily")
    land(aggregates.monthly_from_cells(cells, keys), base, "monthly")
    land(aggregates.submetering_from_cells(cells, keys), base, "submetering")
    daily = read_table(spark, location(base, "daily"))
    land(joins.join_weather(daily, weather, weather_keys), base, "daily_weather")
