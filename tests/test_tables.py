import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattloom.operators import aggregates, clean, joins
from wattloom.plans import modelling, standins
from wattloom.plans.batch import run_batch
from wattloom.plans.ingest import ingest
from wattloom.session import fresh_path
from wattloom.sinks.tables import location, validate_counts, write_parquet, write_report
from wattloom.sources.readings import read_readings, read_readings_for_profiling, read_table
from wattloom.sources.tables import submetering_if_present, table_if_present
from wattloom.sources.weather import normal_name, read_weather, unreadable_dates

POWER_TEXT = """Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3
16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000
16/12/2006;17:25:00;?;?;?;?;?;?;
1/1/2007;00:00:00;2.580;0.136;241.970;10.600;0.000;0.000;0.000
"""
WEATHER_TEXT = """latitude,longitude,elevation
48.822495,2.2881355,43.0

time,temperature_2m_mean (C),temperature-2m max (C),temperature_2m_max (C),temperature_2m_min (C),precipitation_sum (mm)
2006-12-16,4.1,9,7.0,1.2,0.00
2007-01-01,,9,10.0,5.0,3.40
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "power.txt").write_text(POWER_TEXT)
    (tmp_path / "weather.csv").write_text(WEATHER_TEXT)
    return str(tmp_path / "power.txt"), str(tmp_path / "weather.csv")


def test_text_scan(spark, files):
    raw = read_readings(spark, files[0])
    assert raw.count() == 3 and dict(raw.dtypes)["Voltage"] == "string"
    assert raw.where("Voltage = '?'").count() == 1
    assert read_readings_for_profiling(spark, files[0]).where("Voltage IS NULL").count() == 1


def test_weather_scan(spark, files):
    assert normal_name("temperature-2m max (C)") == "temperature_2m_max"
    assert normal_name(" Precipitation Sum ") == "precipitation_sum"


def test_weather_values(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(WEATHER_TEXT.replace("temperature-2m max (C)", "cloud cover (%)"))
    weather = clean.weather_measures(clean.clean_weather(read_weather(spark, str(path))))
    rows = {r["Date"]: r for r in weather.collect()}
    assert len(rows) == 2
    assert rows[dt.date(2006, 12, 16)]["temp_max_c"] == 7.0
    assert rows[dt.date(2007, 1, 1)]["temp_mean_c"] is None
    with pytest.raises(ValueError):
        (tmp_path / "empty.csv").write_text("a,b\n1,2\n")
        read_weather(spark, str(tmp_path / "empty.csv"))


def test_ingest_layout(spark, files, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(WEATHER_TEXT.replace("temperature-2m max (C)", "cloud cover (%)"))
    base = str(tmp_path / "lake")
    report = ingest(spark, files[0], str(path), base)
    assert {r["label"]: (r["expected_rows"], r["status"]) for r in report.collect()} == {
        "cleaned": (2, "PASS"), "raw_weather": (2, "PASS")}
    assert spark.read.parquet(location(base, "raw_readings")).count() == 3
    cleaned = read_table(spark, location(base, "cleaned"))
    pruned = cleaned.where("Year = 2007 AND Month = 1")
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    bad = validate_counts(spark, location(base, "cleaned"), 5, "x").first()
    assert bad["status"] == "FAIL"


def test_join_keeps_unmatched_days(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in (1, 2)],
                                  "Date date, total_kwh double")
    weather = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, 2.0, 0.0, 0.3)],
                                    "Date date, temp_mean_c double, temp_max_c double, "
                                    "temp_min_c double, precip_mm double")
    joined = joins.join_weather(daily, weather)
    assert joins.match_counts(joined).first().asDict() == {"daily_rows": 2, "matched_rows": 1}
    assert joins.duplicate_dates(weather.union(weather)).count() == 1
    assert joins.join_submetering(daily, None) is daily


@pytest.mark.parametrize("keys", [(), ("user_id",)])
def test_tables_from_one_scan(spark, sf, keys):
    readings = standins.readings(spark, sf, keep=keys)
    # Some NULLs, as in cleaned readings with missing sub-meters.
    readings = readings.withColumn("Sub_metering_2", F.when(F.hour("Datetime") > 5,
                                                            F.col("Sub_metering_2")))
    cells = aggregates.hourly_cells(readings, keys)
    for direct, rolled in [
            (aggregates.hourly_patterns, aggregates.hourly_from_cells),
            (aggregates.daily_totals, aggregates.daily_from_cells),
            (aggregates.monthly_summary, aggregates.monthly_from_cells),
            (aggregates.submetering_daily, aggregates.submetering_from_cells)]:
        a = direct(readings, keys)
        b = rolled(cells, keys).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, direct.__name__


def test_missing_tables(spark):
    assert table_if_present(spark, fresh_path(spark, "none")) is None
    assert submetering_if_present(spark, fresh_path(spark, "none")) is None


def test_json_report(spark):
    path = fresh_path(spark, "report")
    for n in (1, 2):
        write_report(spark.range(1).select(F.lit(n).alias("n"), F.array(F.struct(
            F.lit("x").alias("feature"))).alias("results")), path)
    assert sorted(r["n"] for r in spark.read.json(path).collect()) == [1, 2]


def test_overwrite(spark):
    path = fresh_path(spark, "t")
    df = spark.range(10).withColumn("Year", (F.col("id") % 3).cast("int"))
    write_parquet(df, path, ("Year",))
    write_parquet(df.where("Year = 1"), path, ("Year",))
    assert read_table(spark, path).count() == 3


def test_whole_pipeline(spark, sf, tmp_path):
    """Readings to batch tables, features, models, scores, monitoring and drift."""
    base = str(tmp_path / "lake")
    # The events of the stand-in cover one month; a reading per order covers years of days.
    orders = standins.table(spark, sf, "orders")
    readings = clean.with_month_columns(orders.select(
        F.col("o_orderdate").cast("timestamp").alias("Datetime"),
        (F.col("o_totalprice") / 1000).alias("Global_active_power"),
        *[(F.col("o_totalprice") * w).alias(m) for w, m in zip(
            (.1, .2, .3, .4), ["Sub_metering_1", "Sub_metering_2", "Sub_metering_3",
                               "Sub_metering_remainder"])]))
    write_parquet(readings, location(base, "cleaned"), ("Year", "Month"))
    weather = standins.weather(spark, sf)
    run_batch(spark, base, weather)
    features = modelling.build_features(spark, base, weather)
    assert "hvac_ratio" in features.columns and features.count() > 500
    best, forest, boosted = modelling.train_models(features, numTrees=10, maxDepth=4)
    assert best.metrics["R2"] == max(forest.metrics["R2"], boosted.metrics["R2"])
    predictions = modelling.deploy(spark, base, forest, features)
    assert predictions.count() == features.count()
    assert predictions.where("lower_bound > predicted_kwh OR lower_bound < 0").count() == 0
    months = modelling.monitor(spark, base, predictions, features)
    assert months.agg(F.sum("n_days")).first()[0] == predictions.count()
    assert spark.read.json(location(base, "drift")).first()["features_checked"] == 8
    assert aggregates.prediction_months(predictions).count() == months.count()

def test_many_series_share_one_weather_table(spark):
    daily = spark.createDataFrame(
        [("u1", dt.date(2024, 1, 1), 1.0), ("u2", dt.date(2024, 1, 1), 2.0),
         (None, dt.date(2024, 1, 2), 3.0)], "user_id string, Date date, total_kwh double")
    weather = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 4.0, 5.0, 3.0, 0.0), (dt.date(2024, 1, 1), 6.0, 5.0, 3.0, 0.0)],
        "Date date, temp_mean_c double, temp_max_c double, temp_min_c double, precip_mm double")
    rows = joins.join_weather(daily, weather).orderBy("total_kwh").collect()
    assert [r["temp_mean_c"] for r in rows] == [5.0, 5.0, None]  # the mean, and no row twice


def test_keyed_batch_with_shared_weather(spark, sf, tmp_path):
    base = str(tmp_path / "keyed")
    readings = standins.readings(spark, sf, keep=("user_id",))
    write_parquet(readings, location(base, "cleaned"), ("Year", "Month"))
    run_batch(spark, base, standins.weather(spark, sf), keys=("user_id",))
    stored = read_table(spark, location(base, "daily_weather"))
    assert stored.count() == read_table(spark, location(base, "daily")).count()
    assert {"user_id", "temp_mean_c"} <= set(stored.columns)


def test_weather_files_of_different_layout(spark, tmp_path):
    folder = tmp_path / "weather"
    folder.mkdir()
    (folder / "a.csv").write_text("lat,lon\n1,2\n\ntime,temperature_2m_mean (C),"
                                  "precipitation_sum (mm)\n2024-01-01,5,30\n2024-13-01,6,7\n")
    (folder / "b.csv").write_text("time,precipitation_sum (mm),temperature_2m_mean (C),cloud\n"
                                  "2024-01-02,31,4,9\n")
    weather = read_weather(spark, str(folder))
    rows = {r["time"]: r for r in weather.collect()}
    assert (rows["2024-01-01"]["temperature_2m_mean"],
            rows["2024-01-01"]["precipitation_sum"]) == (5.0, 30.0)
    assert (rows["2024-01-02"]["temperature_2m_mean"],
            rows["2024-01-02"]["precipitation_sum"]) == (4.0, 31.0)
    assert rows["2024-01-01"]["cloud"] is None and rows["2024-01-02"]["cloud"] == 9.0
    assert unreadable_dates(weather).first().asDict() == {"rows": 3, "unreadable": 1}
