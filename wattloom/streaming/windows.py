"""Windowed metrics. Each function takes a batch or a streaming DataFrame alike."""

from pyspark.sql import DataFrame, functions as F

from wattloom.functions.cleaning import number_or_zero
from wattloom.functions.numbers import steady_round
from wattloom.schemas import (APPLIANCE_KWH, POWER, SLIDE, SLIDING, SUBMETERS, TUMBLING)


def live_readings(parsed: DataFrame) -> DataFrame:
    """Parsed messages with an event time; unreadable measures count as zero."""
    measures = [POWER, *SUBMETERS]
    return parsed.where(F.col("event_time").isNotNull()).withColumns(
        {c: number_or_zero(F.col(c)) for c in measures if c in parsed.columns})


def _late_rule(df: DataFrame, watermark: str | None) -> DataFrame:
    return df.withWatermark("event_time", watermark) if watermark else df


def tumbling(df: DataFrame, size=TUMBLING, watermark: str | None = None, keys=()) -> DataFrame:
    kw = F.col(POWER)
    return (_late_rule(df, watermark)
            .groupBy(*keys, F.window("event_time", size).alias("w"))
            .agg(F.avg(kw).alias("avg_kw"), F.max(kw).alias("peak_kw"),
                 (F.sum(kw) / 60.0).alias("total_kwh"), F.count(F.lit(1)).alias("count"))
            .select(*keys, F.col("w.start").alias("window_start"), "avg_kw", "peak_kw",
                    "total_kwh", "count"))


def sliding(df: DataFrame, size=SLIDING, slide=SLIDE, watermark: str | None = None,
            keys=()) -> DataFrame:
    kw = F.col(POWER)
    return (_late_rule(df, watermark)
            .groupBy(*keys, F.window("event_time", size, slide).alias("w"))
            .agg(steady_round(F.avg(kw), 4).alias("sliding_avg_kw"),
                 steady_round(F.max(kw), 4).alias("sliding_peak_kw"),
                 F.count(F.lit(1)).alias("count"))
            .select(*keys, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"),
                    "sliding_avg_kw", "sliding_peak_kw", "count"))


def from_first_slide(windows: DataFrame, events: DataFrame, slide=SLIDE) -> DataFrame:
    """Batch only: drop the window that opens one slide before the first event's slide."""
    first = events.agg(F.min("event_time").alias("t")).select(F.window("t", slide).start).scalar()
    return windows.where(F.col("window_start") >= first)


def last_windows(windows: DataFrame, n=10) -> DataFrame:
    return windows.orderBy(F.col("window_start").desc()).limit(n)


def submetering_snapshot(df: DataFrame, now_ms=None) -> DataFrame:
    """Energy per appliance group over everything received so far, and the mean delay."""
    now_ms = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    delay = F.greatest(now_ms - F.coalesce("event_timestamp", now_ms), F.lit(0))
    return df.withColumn("_delay", delay).agg(
        *[steady_round(F.sum(m) / 1000.0, 3).alias(c) for m, c in zip(SUBMETERS, APPLIANCE_KWH)],
        steady_round(F.sum(POWER) / 60.0, 3).alias("total_kwh"),
        F.count(F.lit(1)).alias("records"),
        steady_round(F.avg("_delay"), 2).alias("avg_latency_ms"))


def submetering_shares(snapshot: DataFrame) -> DataFrame:
    """Share of each appliance group in the total, whose floor is 0.001."""
    total = F.greatest("total_kwh", F.lit(0.001))
    return snapshot.select("*", *[
        steady_round(F.col(c) / total * 100, 1).alias(c.replace("_kwh", "_pct"))
        for c in APPLIANCE_KWH])


def bucket_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def latency(df: DataFrame, now_ms, clamp=True) -> DataFrame:
    """Mean time from sending to ``now_ms``; a message without a stamp counts as 0."""
    delay = now_ms - F.coalesce("event_timestamp", now_ms)
    delay = F.greatest(delay, F.lit(0)) if clamp else delay
    return df.agg(F.count(F.lit(1)).alias("stream_records"),
                  steady_round(F.avg(delay), 2).alias("stream_latency_ms"))


def session_summary(df: DataFrame, now_ms=None) -> DataFrame:
    """Totals of a session; ``Datetime`` is the text form of the messages."""
    now_ms = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    delay = F.greatest(now_ms - F.coalesce("event_timestamp", now_ms), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("total_received"),
        steady_round(F.avg(delay), 2).alias("avg_latency_ms"),
        steady_round(F.sum(F.coalesce(F.col(POWER), F.lit(0.0))) / 60.0, 4).alias("total_kwh"),
        F.count_distinct(F.substring(F.coalesce("Datetime", F.lit("")), 1, 10))
        .alias("unique_days"))
