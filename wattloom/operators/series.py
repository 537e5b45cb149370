"""Row-offset features over date-ordered series: lags, trailing statistics, feature table.

Offsets count rows, not days. A series is the rows of one value of ``keys``.

A daily table has one row per key and day, so a series is bounded by the calendar (366 rows a
year) and one plain window per series is the cheapest plan: one shuffle, on the keys. For a
series without such a bound (raw readings of one busy meter) pass ``block_rows``: it is then cut
into blocks of that many rows, each preceded by the rows its windows look back on, and a block
is the most one task ever holds.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from wattloom.functions.calendar import (calendar_columns, cyclical_columns, interaction_columns,
                                         ratio_columns, weather_columns)
from wattloom.schemas import APPLIANCE_KWH, LAG_ROWS, REQUIRED_FEATURES, TARGET
from wattloom.session import written


def with_position(df: DataFrame, order, keys=()) -> DataFrame:
    """Add ``_pos``, the 0-based row number in ``order`` within ``keys``.

    ``order`` is a column or a list of columns; name enough of them to leave no ties. NULL keys
    are a series of their own, NULLs in ``order`` come first.

    Rows are range-partitioned, so that a busy series or a busy hour is spread over as many
    ranges as its size asks for, and stored with the number of their range. They are numbered
    inside the range and shifted by the row count of the series' earlier ranges.
    """
    order = [order] if isinstance(order, str) else list(order)
    ranged = written(df.repartitionByRange(*keys, *order)
                     .withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = (Window.partitionBy(*keys).orderBy("_range")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_range",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    same = F.col("r._range") == F.col("o._range")
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}"))
    joined = ranged.alias("r").join(offsets.alias("o"), same).select("r.*", "o._before")
    return (joined.withColumn("_pos", F.col("_before") + F.row_number().over(inside) - 1)
            .drop("_range", "_before"))


def over_series(df: DataFrame, build: Callable[[WindowSpec], dict[str, Column]], back: int,
                order="Date", keys=(), block_rows: int | None = None) -> DataFrame:
    """Add the columns ``build(window)`` returns; they may look back ``back`` rows at most."""
    if block_rows is None:
        by = [order] if isinstance(order, str) else list(order)
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*by)))
    if block_rows < back:
        raise ValueError("a block must be at least as long as the look-back")
    block = F.floor(F.col("_pos") / block_rows)
    is_tail = F.col("_pos") % block_rows >= block_rows - back
    # The tail of a block is repeated, as context only, in front of the next block.
    targets = F.when(is_tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = (with_position(df, order, keys)
              .withColumn("_own", block).withColumn("_block", F.explode(targets)))
    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    return (spread.withColumns(build(window)).where(F.col("_block") == F.col("_own"))
            .drop("_pos", "_own", "_block"))


def _min_rows(column: str, frame: WindowSpec, aggregate, minimum: int) -> Column:
    """A windowed aggregate that is NULL until ``minimum`` non-null values are in the frame."""
    return F.when(F.count(column).over(frame) >= minimum, aggregate(F.col(column)).over(frame))


def lag_columns(window: WindowSpec) -> dict[str, Column]:
    lags = {f"lag_{n}_kwh": F.lag(TARGET, n).over(window) for n in LAG_ROWS}
    return {**lags, "lag_1_temp": F.lag("temp_mean_c", 1).over(window)}


def rolling_columns(window: WindowSpec) -> dict[str, Column]:
    """Trailing statistics of the rows before the current one, and week-over-week change."""
    week, month = window.rowsBetween(-7, -1), window.rowsBetween(-30, -1)
    return {
        "roll_7_mean": _min_rows(TARGET, week, F.avg, 3),
        "roll_7_std": _min_rows(TARGET, week, F.stddev, 3),
        "roll_7_max": _min_rows(TARGET, week, F.max, 3),
        "roll_30_mean": _min_rows(TARGET, month, F.avg, 7),
        "roll_30_std": _min_rows(TARGET, month, F.stddev, 7),
        "wow_change": F.lag(TARGET, 1).over(window) - F.lag(TARGET, 8).over(window),
    }


def ratio_lag(window: WindowSpec) -> dict[str, Column]:
    return {"lag_1_hvac_ratio": F.lag("hvac_ratio", 1).over(window)}


def has_appliances(df: DataFrame) -> bool:
    return all(c in df.columns for c in APPLIANCE_KWH)


def add_calendar(df: DataFrame, date="Date") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date)))


def add_cyclical(df: DataFrame) -> DataFrame:
    """Needs the calendar columns."""
    return df.withColumns(cyclical_columns())


def add_weather(df: DataFrame) -> DataFrame:
    return df.withColumns(weather_columns())


def add_ratios(df: DataFrame, keys=(), block_rows=None) -> DataFrame:
    """Appliance shares of the day and yesterday's HVAC share; nothing if columns are missing."""
    if not has_appliances(df):
        return df
    return over_series(df.withColumns(ratio_columns()), ratio_lag, 1, keys=keys,
                       block_rows=block_rows)


def add_lags(df: DataFrame, keys=(), block_rows=None) -> DataFrame:
    return over_series(df, lag_columns, 30, keys=keys, block_rows=block_rows)


def add_rolling(df: DataFrame, keys=(), block_rows=None) -> DataFrame:
    return over_series(df, rolling_columns, 30, keys=keys, block_rows=block_rows)


def add_interactions(df: DataFrame) -> DataFrame:
    """Needs the calendar and weather columns."""
    return df.withColumns(interaction_columns())


def feature_table(daily: DataFrame, keys=(), block_rows=None) -> DataFrame:
    """All features of the daily series; rows without target or history are dropped."""
    base = add_weather(add_cyclical(add_calendar(daily)))
    ratios = has_appliances(base)
    if ratios:
        base = base.withColumns(ratio_columns())

    def windowed(w):
        return {**lag_columns(w), **rolling_columns(w), **(ratio_lag(w) if ratios else {})}

    # One window specification for all of it: one shuffle and one sort per series.
    full = add_interactions(over_series(base, windowed, 30, keys=keys, block_rows=block_rows))
    return full.dropna(subset=REQUIRED_FEATURES)


def feature_drop_report(daily: DataFrame, features: DataFrame) -> DataFrame:
    """Rows before and after the history filter."""
    after = features.agg(F.count(F.lit(1))).scalar()
    return daily.agg(F.count(F.lit(1)).alias("rows_before"), after.alias("rows_after")).withColumn(
        "rows_dropped", F.col("rows_before") - F.col("rows_after"))
