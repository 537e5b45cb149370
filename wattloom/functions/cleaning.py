"""Column expressions that turn dirty text into typed values; bad input becomes NULL."""

from pyspark.sql import Column, functions as F

from wattloom.schemas import MISSING_TOKEN, READING_TIME_FORMAT


def is_missing(col: Column, token: str | None = MISSING_TOKEN) -> Column:
    """True for NULL, blank, or the missing token."""
    text = F.trim(col)
    missing = col.isNull() | (text == "")
    return missing | (text == token) if token else missing


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def to_double(col: Column) -> Column:
    """Cast to double without failing under ANSI rules; anything unreadable is NULL."""
    return nan_to_null(col.try_cast("double"))


def clean_double(col: Column, token: str | None = MISSING_TOKEN) -> Column:
    return F.when(~is_missing(col, token), to_double(col))


def number_or_zero(col: Column) -> Column:
    """The live-metrics rule: an unreadable or absent number counts as zero."""
    return F.coalesce(to_double(col), F.lit(0.0))


def reading_time(date: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(READING_TIME_FORMAT))


def flag(condition: Column) -> Column:
    """0/1 flag in which an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def at_least_zero(col: Column) -> Column:
    """max(0, x) that keeps NULL (``greatest`` alone would return 0)."""
    return F.when(col.isNotNull(), F.greatest(F.lit(0.0), col))
