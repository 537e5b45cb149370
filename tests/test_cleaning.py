import datetime as dt

from pyspark.sql import functions as F

from wattloom.functions.classes import power_class, skew_class
from wattloom.functions.cleaning import at_least_zero, flag, nan_to_null
from wattloom.functions.numbers import steady_round
from wattloom.operators import aggregates, clean, profile
from wattloom.schemas import MEASURES, RAW_SCHEMA


def raw_row(date, time, *measures):
    return (date, time, *measures)


def test_dirty_rows(spark):
    raw = spark.createDataFrame([
        raw_row("16/12/2006", "17:24:00", "4.216", "0.4", "234.8", "18.4", "0", "1", "17"),
        raw_row("1/2/2007", "00:01:00", "?", "?", "?", "?", "?", "?", "?"),
        raw_row("1/2/2007", "00:02:00", " ", "", None, "abc", "nan", " ? ", " 5.5 "),
        raw_row("31/31/2007", "00:03:00", "1.2", "0", "0", "0", "0", "0", "0"),
        raw_row(None, "00:04:00", "6", "0", "0", "0", "0", "0", None),
    ], RAW_SCHEMA)
    typed = clean.type_readings(raw).collect()
    assert typed[0]["Global_active_power"] == 4.216
    assert typed[0]["Datetime"] == dt.datetime(2006, 12, 16, 17, 24)
    assert typed[0]["Sub_metering_remainder"] == round(4.216 * 1000 / 60 - 18, 4)
    assert all(typed[1][m] is None for m in MEASURES)
    assert typed[1]["Datetime"] == dt.datetime(2007, 2, 1, 0, 1)
    assert [typed[2][m] for m in MEASURES] == [None] * 6 + [5.5]
    assert typed[3]["Datetime"] is None and typed[4]["Datetime"] is None
    assert typed[4]["Sub_metering_remainder"] is None

    cleaned = clean.clean_readings(raw)
    assert "Date" not in cleaned.columns and cleaned.count() == 3
    report = clean.drop_report(clean.type_readings(raw)).first()
    assert report.asDict() == {"total_rows": 5, "clean_rows": 3, "dropped_rows": 2,
                               "dropped_pct": 40.0}


def test_missing_and_describe_in_one_pass(spark):
    raw = spark.createDataFrame([("1",), ("3",), ("?",), ("",), (None,)], "a string")
    missing = profile.missing_report(raw, ["a"]).first()
    assert (missing["missing"], missing["missing_pct"]) == (3, 60.0)
    stats = profile.describe(raw, ["a"]).first()
    assert (stats["count"], stats["mean"], stats["min"], stats["max"]) == (2, 2.0, 1.0, 3.0)


def test_date_range_is_chronological(spark):
    dates = spark.createDataFrame([("9/1/2007",), ("16/12/2006",), ("26/11/2010",)], "Date string")
    row = profile.date_range(dates).first()
    assert (row["first_date"], row["last_date"]) == (dt.date(2006, 12, 16), dt.date(2010, 11, 26))


def test_null_rules(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (2.0,)], "x double")
    out = df.select(at_least_zero(nan_to_null(F.col("x"))).alias("z"),
                    flag(nan_to_null(F.col("x")) > 0).alias("f")).collect()
    assert [r["z"] for r in out] == [None, None, 0.0, 2.0]
    assert [r["f"] for r in out] == [0, 0, 0, 1]


def test_bucket_edges(spark):
    values = [None, float("nan"), 0.49, 0.5, 1.0, 2.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(power_class(F.col("x"))).collect()] == [
        "unknown", "unknown", "0-0.5kW", "0.5-1kW", "1-2kW", "2-3kW", "3-5kW", "5+kW"]


def test_skew_classes(spark):
    df = spark.createDataFrame([(2.9,), (3.0,), (9.9,), (10.0,)], "r double")
    assert [r[0] for r in df.select(skew_class(F.col("r"))).collect()] == [
        "LOW", "MODERATE", "MODERATE", "HIGH"]


def test_zero_total_gives_null_share(spark):
    readings = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 2024, 1, 0.0, 0.0, 0.0, 0.0, 0.0)],
        "Datetime timestamp, Year int, Month int, Global_active_power double, "
        "Sub_metering_1 double, Sub_metering_2 double, Sub_metering_3 double, "
        "Sub_metering_remainder double")
    row = aggregates.submetering_daily(readings).first()
    assert row["total_kwh"] == 0.0 and row["kitchen_pct"] is None


def test_correlation_skips_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    row = aggregates.correlation(df, "a", "b").first()
    assert round(row["correlation"], 12) == 1.0 and row["interpretation"] == "positive"


def test_correlation_with_a_constant_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    assert aggregates.correlation(df, "a", "b").first()["correlation"] is None
    assert aggregates.correlation_ranking(df, ["a"], "b").count() == 0


def test_steady_round_ignores_summation_noise(spark):
    df = spark.createDataFrame([(24.69375,), (24.693749999999998,), (-0.00005,)], "x double")
    assert [r[0] for r in df.select(steady_round("x", 4)).collect()] == [24.6938, 24.6938, -0.0001]
