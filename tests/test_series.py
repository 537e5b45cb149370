import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.operators import monitoring, order_stats, series, splits

START = dt.date(2024, 1, 1)


def daily(spark, rows):
    return spark.createDataFrame(
        [(START + dt.timedelta(days=d), None if v is None else float(v), float(d)) for d, v in rows],
        "Date date, total_kwh double, temp_mean_c double")


def gaps():
    """40 values with three missing days and one NULL."""
    days = [d for d in range(43) if d not in (5, 17, 30)]
    return [(d, None if i == 20 else (i * 7) % 11 + i) for i, d in enumerate(days)]


def expected(values):
    s = pd.Series(values, dtype=float)
    prev = s.shift(1)
    return pd.DataFrame({
        "lag_7_kwh": s.shift(7), "lag_30_kwh": s.shift(30),
        "roll_7_mean": prev.rolling(7, min_periods=3).mean(),
        "roll_7_std": prev.rolling(7, min_periods=3).std(),
        "roll_7_max": prev.rolling(7, min_periods=3).max(),
        "roll_30_mean": prev.rolling(30, min_periods=7).mean(),
        "roll_30_std": prev.rolling(30, min_periods=7).std(),
        "wow_change": s.shift(1) - s.shift(8)})


@pytest.mark.parametrize("block_rows", [None, 30, 32, 1000])
def test_offsets_count_rows(spark, block_rows):
    rows = gaps()
    out = series.add_rolling(series.add_lags(daily(spark, rows), block_rows=block_rows),
                             block_rows=block_rows).orderBy("Date").toPandas()
    want = expected([v for _, v in rows])
    assert len(out) == len(rows)
    for c in want:
        np.testing.assert_allclose(out[c].astype(float), want[c], rtol=1e-12, err_msg=c)


@pytest.mark.parametrize("block_rows", [None, 64])
def test_series_do_not_mix(spark, block_rows):
    one = daily(spark, [(d, d) for d in range(40)]).withColumn("k", F.lit("a"))
    two = daily(spark, [(d, 1000 + d) for d in range(40)]).withColumn("k", F.lit("b"))
    out = series.add_lags(one.unionByName(two), keys=("k",), block_rows=block_rows)
    lags = {(r["k"], r["Date"]): r["lag_1_kwh"] for r in out.collect()}
    assert lags[("a", START)] is None and lags[("b", START)] is None
    assert lags[("b", START + dt.timedelta(days=1))] == 1000.0


def test_position_over_hot_days(spark):
    times = [dt.datetime(2024, 1, 1 + i // 50, 0, 0, i % 50) for i in range(120)]
    df = spark.createDataFrame([(t, float(i)) for i, t in enumerate(times)], "ts timestamp, v double")
    out = series.with_position(df.repartition(8), "ts").collect()
    assert all(r["_pos"] == r["v"] for r in out)


def test_block_shorter_than_look_back_is_refused(spark):
    with pytest.raises(ValueError):
        series.add_lags(daily(spark, [(0, 1)]), block_rows=10)


def test_weather_edges(spark):
    df = spark.createDataFrame(
        [(16.0, 0.1), (22.0, 0.11), (18.0, None), (None, 0.0)], "temp_mean_c double, precip_mm double"
    ).withColumns({"temp_max_c": F.lit(1.0), "temp_min_c": F.lit(0.0)})
    rows = series.add_weather(df).collect()
    assert [r["hdd"] for r in rows] == [2.0, 0.0, 0.0, None]
    assert [r["cdd"] for r in rows] == [0.0, 0.0, 0.0, None]
    assert [r["in_comfort_zone"] for r in rows] == [1, 1, 1, 0]
    assert [r["has_rain"] for r in rows] == [0, 1, 0, 0]


def test_feature_table_without_appliances(spark):
    df = daily(spark, gaps()).withColumns(
        {"temp_max_c": F.lit(1.0), "temp_min_c": F.lit(0.0), "precip_mm": F.lit(0.0)})
    out = series.feature_table(df)
    assert "hvac_ratio" not in out.columns
    assert out.where("total_kwh IS NULL OR lag_7_kwh IS NULL OR roll_7_mean IS NULL").count() == 0


@pytest.mark.parametrize("n", [10, 41, 100])
def test_split_by_position(spark, n):
    df = daily(spark, [(d, d) for d in range(n)])
    counts = {r["split"]: r["count"] for r in splits.time_split(df).groupBy("split").count().collect()}
    assert counts["train"] == int(n * 0.8)
    point = splits.split_point(df).first()
    assert (point["n_rows"], point["n_train"]) == (n, int(n * 0.8))


def test_split_keeps_dates_whole(spark):
    df = daily(spark, [(d // 7, d) for d in range(35)])
    out = splits.time_split(df).groupBy("Date").agg(F.count_distinct("split").alias("n"))
    assert out.where("n > 1").count() == 0


def test_folds(spark):
    n = 50
    df = splits.cv_folds(daily(spark, [(d, d) for d in range(n)])).orderBy("Date").collect()
    size = n // 6
    want = [0] * (n - 5 * size) + [k for k in range(1, 6) for _ in range(size)]
    assert [r["fold"] for r in df] == want


def test_rolling_errors_and_alerts(spark):
    errors = [5.0] * 10 + [6.0] * 40
    pred = spark.createDataFrame(
        [(START + dt.timedelta(days=i), e, 3 * e) for i, e in enumerate(errors)],
        "Date date, abs_error double, pct_error double")
    out = monitoring.with_alerts(monitoring.rolling_errors(pred)).orderBy("Date").collect()
    want = pd.Series(errors).rolling(30, min_periods=7).mean()
    assert [r["rolling_mae"] for r in out][:6] == [None] * 6
    np.testing.assert_allclose([r["rolling_mae"] for r in out][6:], want[6:])
    assert not out[3]["mae_alert"] and not out[9]["mae_alert"] and out[10]["mae_alert"]
    log = monitoring.monitor_log(monitoring.with_alerts(monitoring.rolling_errors(pred)))
    assert log.count() == len(errors) - 6


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 1001])
def test_exact_medians(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=n), rng.integers(0, 4, size=n).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b}))
    got = {r["feature"]: r["median"] for r in order_stats.exact_medians(df, ["a", "b"]).collect()}
    assert got == pytest.approx({"a": np.median(a), "b": np.median(b)}, abs=1e-15)


def test_running_counts_with_a_hot_value(spark):
    values = [7.0] * 3000 + list(np.random.default_rng(0).normal(size=500)) + [-0.0, 0.0]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    counts = order_stats.unpivot_doubles(df, ["x"]).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))
    got = order_stats.running_counts(counts, ["n"]).orderBy("value").collect()
    arr = np.sort(values)
    assert [r["n_upto"] for r in got] == [np.searchsorted(arr, r["value"], "right") for r in got]
    assert [r["n_before"] for r in got] == [np.searchsorted(arr, r["value"], "left") for r in got]
    assert {r["n_total"] for r in got} == {len(values)}


def test_impute(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 7), (3.0, None)], "a double, b int")
    rows = order_stats.impute_medians(df, ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in rows) == [(1.0, 5.0), (2.0, 7.0), (3.0, 6.0)]


def test_null_keys_and_ties_keep_their_rows(spark):
    rows = [(k, 7, i) for k in ("a", None) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, t int, i int").repartition(6)
    out = series.with_position(df, ["t", "i"], ("k",)).collect()
    assert len(out) == 100 and all(r["_pos"] == r["i"] for r in out)
