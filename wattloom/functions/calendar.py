"""Calendar and weather feature expressions of one row."""

import math

from pyspark.sql import Column, functions as F

from wattloom.functions.cleaning import at_least_zero, flag
from wattloom.schemas import (APPLIANCES, COMFORT_C, COOLING_BASE_C, HEATING_BASE_C, RAIN_MM,
                              SEASON_OF_MONTH)


def season(month: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SEASON_OF_MONTH.items() for x in pair])
    return table[month]


def calendar_columns(date: Column) -> dict[str, Column]:
    weekday = F.weekday(date)
    return {
        "day_of_week": weekday,
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "cal_month": F.month(date),
        "cal_year": F.year(date),
        "is_weekend": flag(weekday >= 5),
        "season": season(F.month(date)),
    }


def cyclical_columns() -> dict[str, Column]:
    out = {}
    for source, name, period in [("day_of_week", "dow", 7), ("cal_month", "month", 12),
                                 ("day_of_year", "doy", 365)]:
        angle = F.lit(2 * math.pi) * F.col(source) / F.lit(period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def weather_columns() -> dict[str, Column]:
    temp = F.col("temp_mean_c")
    return {
        "temp_range": F.col("temp_max_c") - F.col("temp_min_c"),
        "hdd": at_least_zero(F.lit(HEATING_BASE_C) - temp),
        "cdd": at_least_zero(temp - F.lit(COOLING_BASE_C)),
        "in_comfort_zone": flag(temp.between(*COMFORT_C)),
        "has_rain": flag(F.col("precip_mm") > RAIN_MM),
    }


def ratio_columns() -> dict[str, Column]:
    return {f"{a}_ratio": F.try_divide(F.col(f"{a}_kwh"), F.col("total_kwh")) for a in APPLIANCES}


def interaction_columns() -> dict[str, Column]:
    return {
        "hdd_x_weekend": F.col("hdd") * F.col("is_weekend"),
        "hdd_x_season": F.col("hdd") * F.col("season"),
        "temp_x_weekend": F.col("temp_mean_c") * F.col("is_weekend"),
    }
