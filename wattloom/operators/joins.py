"""Left joins of daily tables.

No side is hinted: Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution re-checks at run time) and sorts
and merges otherwise, splitting skewed partitions. Daily tables hold one row per key and day.
"""

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.numbers import steady_round
from wattloom.schemas import APPLIANCE_KWH, WEATHER_COLUMNS


def join_weather(daily: DataFrame, weather: DataFrame, keys=()) -> DataFrame:
    """Every daily row with the weather of its date, NULL where there is none.

    ``keys`` are the columns that tell places apart in ``weather``; without any, all series
    share its one row per date. Several rows of a date (see ``duplicate_dates``) become their
    mean, so days are never multiplied.
    """
    on = [*keys, "Date"]
    one = weather.groupBy(*on).agg(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS])
    return daily.join(one, on, "left")


def duplicate_dates(table: DataFrame, keys=()) -> DataFrame:
    """Dates (per key) that occur more than once and would fan out a join."""
    return (table.groupBy(*keys, "Date").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def match_counts(joined: DataFrame, column="temp_mean_c") -> DataFrame:
    return joined.agg(F.count(F.lit(1)).alias("daily_rows"),
                      F.count(column).alias("matched_rows"))


def join_submetering(daily: DataFrame, submetering: DataFrame | None, keys=()) -> DataFrame:
    """Add the appliance columns unless ``daily`` already has them or none are available."""
    if submetering is None or all(c in daily.columns for c in APPLIANCE_KWH):
        return daily
    return daily.join(submetering.select(*keys, "Date", *APPLIANCE_KWH), [*keys, "Date"], "left")


def batch_vs_stream(daily: DataFrame, stream_totals: DataFrame) -> DataFrame:
    """Batch totals beside stream totals: one row from two one-row aggregates."""
    batch = daily.agg(
        F.count(F.lit(1)).alias("batch_days"),
        F.coalesce(steady_round(F.sum("total_kwh"), 4), F.lit(0.0)).alias("batch_total_kwh"),
        F.coalesce(steady_round(F.avg("total_kwh"), 4), F.lit(0.0)).alias("batch_avg_kwh"))
    stream = stream_totals.select(F.struct("stream_records", "stream_latency_ms")).scalar()
    return batch.select("*", stream["stream_records"].alias("stream_records"),
                        stream["stream_latency_ms"].alias("stream_latency_ms"))


def join_calendar(readings: DataFrame, calendar: DataFrame, on=("Year", "Month")) -> DataFrame:
    """Rows of a table partitioned by ``on`` whose partition is in ``calendar``, with its columns.

    ``calendar`` has a row per partition, so at most as many as the table has folders. Which ones
    a filter on it leaves is known only when the query runs: Spark then prunes the scan to their
    folders. The hint makes the calendar the broadcast side, which pruning reuses.
    """
    return readings.join(F.broadcast(calendar), list(on))
