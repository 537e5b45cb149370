"""Every operator as a named query over the given tables: ``name -> f(spark, sf_dir)``.

Queries present results: they round floats, cast to plain types and drop time zones, so that an
independent SQL engine can be compared value by value.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.classes import power_class
from wattloom.functions.numbers import steady_round
from wattloom.operators import (aggregates, clean, drift, explain, joins, learning, monitoring,
                                order_stats, profile, registry, scoring, series, sketches, splits)
from wattloom.plans import standins
from wattloom.plans.ingest import ingest
from wattloom.plans.standins import table
from wattloom.schemas import FEATURE_GROUPS, MEASURES, POWER, REMAINDER, TARGET, WATERMARK
from wattloom.session import fresh_path, written
from wattloom.sinks.tables import (JavaFolder, as_messages, location, replace_partitions,
                                   write_parquet, write_report)
from wattloom.sources.messages import parse_messages, table_stream
from wattloom.sources.readings import read_readings, read_readings_for_profiling, read_table
from wattloom.sources.tables import daily_with_weather, submetering_if_present
from wattloom.sources.weather import read_weather
from wattloom.streaming import runs, windows

QUERIES = {}
# The monitoring thresholds that split the naive predictions of the stand-in series in halves.
ALERT_LIMITS = {"mae": 7.7, "mape": 66.0}
NOW_MS = 1_706_745_600_000  # 2024-02-01 00:00:00 UTC, the fixed "now" of latency queries


def query(function):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf)
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


def tidy(df: DataFrame, digits=6) -> DataFrame:
    """Round doubles and drop time zones."""
    def plain(name, dtype):
        if dtype == "double":
            return steady_round(name, digits).alias(name)
        if dtype == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)
    return df.select(*[plain(n, t) for n, t in df.dtypes])


# ---- Sources and cleaning ---------------------------------------------------------------

@query
def clean_numeric(spark, sf):
    raw = standins.raw_text(spark, sf, keep=("event_id",))
    return clean.type_readings(raw, keep=("event_id",)).select("event_id", *MEASURES)


@query
def parse_datetime(spark, sf):
    raw = standins.raw_text(spark, sf, keep=("event_id",))
    return tidy(clean.type_readings(raw, keep=("event_id",)).select("event_id", "Datetime"))


@query
def derive_remainder(spark, sf):
    raw = standins.raw_text(spark, sf, keep=("event_id",))
    return clean.type_readings(raw, keep=("event_id",)).select("event_id", REMAINDER)


@query
def clean_readings(spark, sf):
    """The whole cleaning chain: typed, filtered, with partition columns."""
    raw = standins.raw_text(spark, sf, keep=("event_id",))
    return tidy(clean.clean_readings(raw, keep=("event_id",)), 4)


@query
def drop_null_report(spark, sf):
    return clean.drop_report(clean.type_readings(standins.raw_text(spark, sf)))


@query
def partition_cols(spark, sf):
    return tidy(clean.with_month_columns(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate"))


@query
def clean_weather(spark, sf):
    raw = (table(spark, sf, "lineitem")
           .groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("time"))
           .agg(F.max("l_quantity").alias("temperature_2m_max")))
    return clean.clean_weather(raw)


@query
def conform_types(spark, sf):
    loose = standins.readings(spark, sf, keep=("event_id",)).select(
        "event_id", F.col("Datetime").cast("string"), F.col("Year").cast("string"),
        F.col("Month").cast("bigint"), F.to_date("Datetime").cast("string").alias("Date"))
    return tidy(clean.conform_types(loose))


@query
def consumption_bucket(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", power_class(F.col("value") / 25).alias("bucket"))


@query
def ingest_text(spark, sf):
    """Text files in, partitioned table out: rows and energy per month of the cleaned table."""
    base, _ = _ingested(spark, sf)
    cleaned = read_table(spark, location(base, "cleaned"))
    return cleaned.groupBy("Year", "Month").agg(
        F.count(F.lit(1)).alias("row_count"), steady_round(F.sum(POWER), 4).alias("total_power"))


def _ingested(spark, sf):
    """(base path, validation report) of an ingestion from text files."""
    base = fresh_path(spark, "ingest")
    _write_text(standins.raw_text(spark, sf), f"{base}/in/readings")
    _write_weather_text(spark, sf, f"{base}/in/weather")
    return base, ingest(spark, f"{base}/in/readings", f"{base}/in/weather", base)


def _write_text(raw: DataFrame, path: str) -> None:
    (raw.write.option("header", True).option("sep", ";")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _write_weather_text(spark, sf, path: str) -> None:
    """A weather export: preamble, blank line, header with units, rows."""
    head = ["latitude,longitude,elevation", "48.8,2.3,43.0", "",
            "time,temperature_2m_mean (C),temperature_2m_max (C),temperature_2m_min (C),"
            "precipitation_sum (mm)"]
    top = spark.createDataFrame([(line,) for line in head], "value string").coalesce(1)
    rows = standins.weather(spark, sf).select(F.concat_ws(
        ",", F.date_format("Date", "yyyy-MM-dd"), "temp_mean_c", "temp_max_c", "temp_min_c",
        "precip_mm").alias("value"))
    top.unionByName(rows).write.text(path)


@query
def validate_counts_report(spark, sf):
    """Read-back counts of the ingested tables against the counts observed while writing."""
    return _ingested(spark, sf)[1]


@query
def scan_readings_text(spark, sf):
    """Delimited-text scan with the null token: missing values left for later cleaning."""
    path = fresh_path(spark, "text")
    _write_text(standins.raw_text(spark, sf), path)
    plain = profile.missing_report(read_readings(spark, path)).withColumn("scan", F.lit("plain"))
    nulled = read_readings_for_profiling(spark, path)
    null_only = nulled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in MEASURES])
    counts = null_only.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_after_scan")) for c in MEASURES])))
    return plain.join(counts, "column").select("column", "missing", "missing_pct",
                                               "null_after_scan")


@query
def scan_weather_csv(spark, sf):
    """Weather export with preamble and units in its header."""
    path = fresh_path(spark, "weather")
    _write_weather_text(spark, sf, path)
    return clean.weather_measures(clean.clean_weather(read_weather(spark, path)))


@query
def roundtrip_parquet(spark, sf):
    return written(standins.daily_series(spark, sf), "daily").select(
        "Date", TARGET, "minutes_recorded")


@query
def roundtrip_partitioned(spark, sf):
    path = fresh_path(spark, "daily")
    write_parquet(standins.daily_series(spark, sf), path, ("Year", "Month"))
    return read_table(spark, path).select("Date", "Year", "Month", TARGET)


@query
def pruned_count(spark, sf):
    """Partition filters on a written table, beside its total."""
    path = fresh_path(spark, "orders")
    orders = clean.with_month_columns(table(spark, sf, "orders"), "o_orderdate")
    write_parquet(orders.select("o_orderkey", "Year", "Month"), path, ("Year", "Month"))
    stored = read_table(spark, path)
    return profile.volume(
        all=stored, january=stored.where("Month = 1"), year_1997=stored.where("Year = 1997"),
        january_1998=stored.where("Year = 1998 AND Month = 1"))


@query
def pruned_join(spark, sf):
    """Readings of the months that a filtered calendar names; other months' files are not read."""
    path = fresh_path(spark, "by-month")
    orders = clean.with_month_columns(table(spark, sf, "orders"), "o_orderdate")
    write_parquet(orders.select("o_orderkey", "o_totalprice", "Year", "Month"), path,
                  ("Year", "Month"))
    calendar = orders.select("Year", "Month").distinct().withColumn(
        "quarter", F.ceil(F.col("Month") / 3))
    joined = joins.join_calendar(read_table(spark, path), calendar.where(
        "quarter = 1 AND Year > 1996"))
    return joined.groupBy("Year", "Month").agg(F.count("*").alias("n")).select(
        F.col("Year").cast("int").alias("Year"), F.col("Month").cast("int").alias("Month"), "n")


@query
def reland_month(spark, sf):
    """A month landed again with corrected rows; the other months stay as they were."""
    path = fresh_path(spark, "by-month")
    orders = clean.with_month_columns(table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "Year", "Month")
    write_parquet(orders, path, ("Year", "Month"))
    march = orders.where("Year = 1997 AND Month = 3 AND o_orderkey % 2 = 0")
    replace_partitions(march, path, ("Year", "Month"))
    return read_table(spark, path).groupBy("Year", "Month").agg(F.count("*").alias("n")).select(
        F.col("Year").cast("int").alias("Year"), F.col("Month").cast("int").alias("Month"), "n")


@query
def filtered_join(spark, sf):
    """Line items of the urgent orders of a month: a Bloom filter of the order keys is applied to
    the line items before they are shuffled."""
    orders = table(spark, sf, "orders").where(
        "o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1995 AND month(o_orderdate) = 3")
    joined = sketches.bloom_join(table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")
    return joined.groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query
def daily_rebuild(spark, sf):
    """Daily table rebuilt from readings because no prepared one exists."""
    rebuilt = daily_with_weather(
        spark, fresh_path(spark, "absent"), lambda: standins.readings(spark, sf),
        lambda: standins.weather(spark, sf).withColumn("Date", F.date_add("Date", 9000)))
    return tidy(rebuilt.drop("Year", "Month"))


@query
def join_submetering(spark, sf):
    path = fresh_path(spark, "submetering")
    write_parquet(standins.daily_series(spark, sf, appliances=True).drop(TARGET), path,
                  ("Year", "Month"))
    daily = standins.daily_series(spark, sf).select("Date", TARGET)
    return joins.join_submetering(daily, submetering_if_present(spark, path))


@query
def publish_json(spark, sf):
    """All readings as keyed JSON messages, parsed back."""
    readings = standins.readings(spark, sf)
    messages = as_messages(readings, stamp=F.lit(NOW_MS))
    return parse_messages(messages, keep=("key",)).select(
        "key", F.col(POWER).try_cast("double").alias("power"),
        F.col("Sub_metering_1").try_cast("double").alias("kitchen"),
        F.col("Year").try_cast("int").alias("Year"), "event_timestamp",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"))


# ---- Profiling --------------------------------------------------------------------------

@query
def profile_volume(spark, sf):
    return profile.volume(readings=table(spark, sf, "events"), weather=standins.weather(spark, sf))


@query
def profile_range(spark, sf):
    return profile.date_range(standins.raw_text(spark, sf))


@query
def profile_schema(spark, sf):
    """Columns, types and rows of the given tables that stand in for readings and weather."""
    return profile.schema_listing(**{n: table(spark, sf, n)
                                     for n in ("events", "lineitem", "orders", "customer")})


@query
def profile_missing(spark, sf):
    return profile.missing_report(standins.raw_text(spark, sf))


@query
def profile_stats(spark, sf):
    return tidy(profile.describe(standins.raw_text(spark, sf)))


def _text_dates(spark, sf):
    """Order dates as text, one in ten of them unreadable."""
    text = F.when(F.col("o_orderkey") % 10 == 0, "?").otherwise(
        F.date_format("o_orderdate", "d/M/yyyy"))
    return table(spark, sf, "orders").select(text.alias("Date"))


@query
def rows_per_year(spark, sf):
    return profile.rows_per_year(_text_dates(spark, sf), "Date", "d/M/yyyy")


@query
def rows_per_month(spark, sf):
    return profile.rows_per_month(_text_dates(spark, sf), "Date", "d/M/yyyy")


@query
def partition_sizes(spark, sf):
    orders = clean.with_month_columns(table(spark, sf, "orders").select("o_orderdate"),
                                      "o_orderdate")
    return profile.partition_sizes(orders).drop("partition")


@query
def skew_report(spark, sf):
    orders = clean.with_month_columns(table(spark, sf, "orders").select("o_orderdate"),
                                      "o_orderdate")
    return profile.skew_report(orders)


@query
def feature_summary(spark, sf):
    return tidy(profile.feature_summary(standins.features(spark, sf)), 5)


# ---- Aggregates and joins ---------------------------------------------------------------

@query
def hourly_patterns(spark, sf):
    return aggregates.hourly_patterns(standins.readings(spark, sf))


@query
def daily_totals(spark, sf):
    return aggregates.daily_totals(standins.readings(spark, sf))


@query
def daily_totals_by_user(spark, sf):
    """Daily totals of many series at once."""
    return aggregates.daily_totals(standins.readings(spark, sf, keep=("user_id",)), ("user_id",))


@query
def monthly_summary(spark, sf):
    return aggregates.monthly_summary(standins.readings(spark, sf))


@query
def submetering_daily(spark, sf):
    return aggregates.submetering_daily(standins.readings(spark, sf))


@query
def batch_tables(spark, sf):
    """All four batch tables from one scan, as rows per table and their energy."""
    cells = written(aggregates.hourly_cells(standins.readings(spark, sf)), "cells")
    tables = {"hourly": aggregates.hourly_from_cells(cells).withColumn("x", F.col("stddev_kw")),
              "daily": aggregates.daily_from_cells(cells).withColumn("x", F.col(TARGET)),
              "monthly": aggregates.monthly_from_cells(cells).withColumn("x", F.col("stddev_kw")),
              "submetering": aggregates.submetering_from_cells(cells)
              .withColumn("x", F.col("hvac_pct"))}
    out = None
    for name, table_ in tables.items():
        row = table_.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"),
                         steady_round(F.sum("x"), 4).alias("checksum"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def submetering_share_avg(spark, sf):
    return aggregates.submetering_share_avg(
        aggregates.submetering_daily(standins.readings(spark, sf)))


@query
def daily_group_count(spark, sf):
    return aggregates.daily_group_count(standins.readings(spark, sf))


@query
def join_daily_weather(spark, sf):
    return standins.daily_weather(spark, sf, appliances=False)


@query
def join_match_counts(spark, sf):
    return joins.match_counts(standins.daily_weather(spark, sf, appliances=False))


@query
def corr_pair(spark, sf):
    joined = standins.daily_weather(spark, sf, appliances=False)
    return tidy(aggregates.correlation(joined, TARGET, "temp_mean_c"))


@query
def corr_topk(spark, sf):
    columns = [c for group in FEATURE_GROUPS.values() for c in group]
    return tidy(aggregates.correlation_ranking(standins.features(spark, sf), columns))


@query
def batch_vs_stream(spark, sf):
    daily = aggregates.daily_totals(standins.readings(spark, sf))
    messages = table(spark, sf, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_timestamp"))
    return joins.batch_vs_stream(daily, windows.latency(messages, F.lit(NOW_MS), clamp=False))


# ---- Features ---------------------------------------------------------------------------

def _daily(spark, sf, appliances=False):
    return standins.daily_weather(spark, sf, appliances=appliances)


CALENDAR = ["day_of_week", "day_of_year", "week_of_year", "cal_month", "cal_year", "is_weekend",
            "season"]
CYCLICAL = ["dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos"]
WEATHER = ["temp_range", "hdd", "cdd", "in_comfort_zone", "has_rain"]


@query
def feature_calendar(spark, sf):
    return series.add_calendar(standins.daily_series(spark, sf)).select("Date", *CALENDAR)


@query
def feature_cyclical(spark, sf):
    daily = series.add_calendar(standins.daily_series(spark, sf))
    return tidy(series.add_cyclical(daily).select("Date", *CYCLICAL))


@query
def feature_weather(spark, sf):
    return tidy(series.add_weather(_daily(spark, sf)).select("Date", *WEATHER))


@query
def feature_lags(spark, sf):
    return series.add_lags(_daily(spark, sf)).select("Date", *FEATURE_GROUPS["Lag"])


@query
def feature_rolling(spark, sf):
    return tidy(series.add_rolling(_daily(spark, sf)).select("Date", *FEATURE_GROUPS["Rolling"]))


@query
def feature_ratios(spark, sf):
    return tidy(series.add_ratios(_daily(spark, sf, True))
                .select("Date", *FEATURE_GROUPS["Sub-metering"]))


@query
def feature_interactions(spark, sf):
    base = series.add_weather(series.add_calendar(_daily(spark, sf)))
    return tidy(series.add_interactions(base).select("Date", *FEATURE_GROUPS["Interaction"]))


@query
def feature_table(spark, sf):
    return tidy(standins.features(spark, sf))


@query
def feature_table_by_status(spark, sf):
    """The feature table of several series at once, one per order status."""
    keys = ("o_orderstatus",)
    return tidy(standins.features(spark, sf, keys).select(
        *keys, "Date", *FEATURE_GROUPS["Lag"], *FEATURE_GROUPS["Rolling"]))


@query
def feature_drop_report(spark, sf):
    daily = _daily(spark, sf, True)
    return series.feature_drop_report(daily, series.feature_table(daily))


@query
def reading_lags(spark, sf):
    """Lags and trailing statistics over the raw readings: one series as long as the table."""
    readings = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias(TARGET))
    out = series.over_series(readings, series.rolling_columns, 30, order=["ts", "event_id"],
                             block_rows=4096)
    return tidy(out.drop("ts"))


# ---- Splits, learning inputs ------------------------------------------------------------

@query
def time_split(spark, sf):
    return splits.time_split(standins.daily_series(spark, sf)).select("Date", TARGET, "split")


@query
def cv_folds(spark, sf):
    return splits.fold_summary(standins.daily_series(spark, sf))


@query
def feature_columns(spark, sf):
    """Model features by the selection rule, with their value counts."""
    table_ = written(standins.features(spark, sf), "features")
    chosen = learning.feature_columns(table_)
    wide = table_.agg(*[F.count(c).alias(c) for c in chosen])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_values")) for c in chosen])))


@query
def impute_median(spark, sf):
    columns = ["lag_30_kwh", "roll_30_mean", "temp_mean_c", "lag_14_kwh"]
    stored = written(standins.features(spark, sf).select("Date", *columns), "features")
    return tidy(order_stats.impute_medians(stored, columns))


@query
def reading_medians(spark, sf):
    """Exact medians over raw-size columns."""
    items = table(spark, sf, "lineitem")
    return tidy(order_stats.exact_medians(
        items, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


# ---- Scoring and monitoring -------------------------------------------------------------

@query
def score_naive(spark, sf):
    return standins.naive_scored(spark, sf)


@query
def score_summary(spark, sf):
    return tidy(scoring.score_summary(standins.naive_scored(spark, sf)))


@query
def eval_metrics(spark, sf):
    return tidy(scoring.evaluate(standins.naive_scored(spark, sf), "naive", "actual_kwh",
                                 "predicted_kwh"))


@query
def baseline_improvement(spark, sf):
    return tidy(scoring.baseline_improvement(standins.naive_scored(spark, sf), "actual_kwh",
                                             "predicted_kwh"))


@query
def pred_monthly(spark, sf):
    return tidy(aggregates.prediction_months(standins.naive_scored(spark, sf)), 4)


@query
def pred_sample(spark, sf):
    return scoring.prediction_sample(standins.naive_scored(spark, sf))


@query
def pred_preview(spark, sf):
    split = splits.time_split(series.add_rolling(series.add_lags(_daily(spark, sf))))
    return scoring.prediction_preview(split.where(F.col("split") == "test"),
                                      {"naive": "lag_7_kwh", "mean": "roll_7_mean"})


@query
def worst_predictions(spark, sf):
    return scoring.worst_predictions(standins.naive_scored(spark, sf))


@query
def monitor_rolling(spark, sf):
    rolling = monitoring.rolling_errors(standins.naive_scored(spark, sf))
    return tidy(rolling.select("Date", "rolling_mae", "rolling_mape"))


def _monitored(spark, sf):
    return monitoring.with_alerts(
        monitoring.rolling_errors(standins.naive_scored(spark, sf)), **ALERT_LIMITS)


@query
def monitor_alerts(spark, sf):
    return monitoring.alert_totals(_monitored(spark, sf))


@query
def monitor_monthly(spark, sf):
    return tidy(monitoring.monitor_months(_monitored(spark, sf)), 4)


@query
def monitor_log(spark, sf):
    return tidy(monitoring.monitor_log(_monitored(spark, sf)))


# ---- Drift ------------------------------------------------------------------------------

def _split_features(spark, sf):
    """The stored feature table with its split, as drift checks and trainings read it."""
    return splits.time_split(written(standins.features(spark, sf), "features"))


@query
def drift_psi(spark, sf):
    return tidy(drift.psi(_split_features(spark, sf)))


@query
def drift_ks(spark, sf):
    return tidy(drift.ks(_split_features(spark, sf)))


@query
def drift_ks_readings(spark, sf):
    """KS over raw-size columns: early against late line items."""
    items = table(spark, sf, "lineitem").withColumn(
        "split", F.when(F.year("l_shipdate") < 2000, "train").otherwise("test"))
    return tidy(drift.ks(items, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query
def drift_report(spark, sf):
    report = drift.drift_report(_split_features(spark, sf), "v1.0",
                                F.lit("2024-02-01 00:00:00"))
    return report.select("run_at", "model_version", "features_checked", F.inline("results"))


# ---- Sketches ---------------------------------------------------------------------------

@query
def bucket_counts(spark, sf):
    events = table(spark, sf, "events").withColumn("kw", F.col("value") / 25)
    return windows.bucket_counts(sketches.with_power_class(events, "kw"))


@query
def bloom_build(spark, sf):
    return sketches.bloom_build(table(spark, sf, "events"), "user_id")


@query
def bloom_probe(spark, sf):
    """A filter of the customers with orders, probed with all customer keys."""
    words = sketches.bloom_build(table(spark, sf, "orders"), "o_custkey")
    return sketches.bloom_probe(table(spark, sf, "customer"), "c_custkey", words)


@query
def bloom_report(spark, sf):
    """Deduplication of order customers in order-key order, filter sized for 5000 keys."""
    return sketches.bloom_report(table(spark, sf, "orders"), "o_custkey", "o_orderkey")


@query
def bloom_first_seen(spark, sf):
    """A crowded filter (200 keys planned, all orders fed): which keys it takes for known."""
    return sketches.bloom_first_seen(table(spark, sf, "orders"), "o_custkey", "o_orderkey",
                                     capacity=200)


@query
def cms_build(spark, sf):
    return sketches.cms_build(
        table(spark, sf, "events").withColumn("item", F.col("user_id").cast("string")), "item")


@query
def cms_native(spark, sf):
    """Users counted by daily sketches that are merged: how far the estimates are from the truth."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = written(sketches.cms_native(events, "user_id", ["day"]), "daily-sketches")
    exact = events.groupBy("user_id").agg(F.count("*").alias("n"))
    whole = sketches.cms_native_merge(daily).scalar()  # one sketch of fixed size
    asked = written(sketches.cms_native_query(exact.withColumn("sketch", whole), "user_id").select(
        "n", "cms_estimate", F.lit(events.count()).alias("total")), "estimates")
    return asked.agg(
        F.count("*").alias("items"), F.sum("n").alias("updates"),
        F.count_if(F.col("cms_estimate") < F.col("n")).alias("below"),
        (F.count_if(F.col("cms_estimate") - F.col("n") > F.col("total") * 0.001)
         <= F.count("*") * (1 - 0.9921875)).alias("within_bound"))


@query
def cms_vs_exact(spark, sf):
    events = table(spark, sf, "events").withColumn("kw", F.col("value") / 25)
    return sketches.cms_vs_exact(sketches.with_power_class(events, "kw"))


@query
def cms_error_rate(spark, sf):
    events = table(spark, sf, "events").withColumn("kw", F.col("value") / 25)
    return sketches.cms_error_rate(sketches.cms_vs_exact(sketches.with_power_class(events, "kw")))


# ---- Streaming --------------------------------------------------------------------------

TRIGGERS, FILES_PER_TRIGGER = 3, 2
#: About the rows of a file of a stream: a task reads one, and messages are much work.
ROWS_PER_FILE = 50_000
#: The group of events without a time.
LATEST = 1 << 40


def _event_stream(spark, sf):
    """Events as a stream of several triggers, from files written in parallel.

    There are as many triggers for every table, whose files grow in number.
    """
    path, events = fresh_path(spark, "events"), table(spark, sf, "events")
    per_trigger = max(FILES_PER_TRIGGER, -(-events.count() // (TRIGGERS * ROWS_PER_FILE)))
    events.repartition(TRIGGERS * per_trigger, "event_id").write.parquet(path)
    return table_stream(spark, path, events.schema, max_files=per_trigger)


def _messages(events):
    """Events as JSON messages; small errors arrive as an array, not an object."""
    readings = standins.as_readings(events, keep=("event_type",))
    messages = as_messages(readings, stamp=F.unix_millis("Datetime"), keep=("event_type", POWER))
    broken = (F.col("event_type") == "error") & (F.col(POWER) < 5)
    return messages.select("key", F.when(broken, "[5]").otherwise(F.col("value")).alias("value"))


def _live(events):
    return windows.live_readings(parse_messages(_messages(events)))


def _run(spark, stream, name, mode="update", log=None) -> str:
    """Run a stream over all available input; returns where its triggers wrote."""
    path = fresh_path(spark, name)
    runs.finish(runs.start(stream, runs.per_trigger_sink(f"{path}/out"), f"{path}/checkpoint",
                           mode, available_now=True), log=log)
    return f"{path}/out"


def _feed(spark, sf, arrival, build, name, mode="update", sink=None, **options) -> str:
    """Events arriving in groups by the number ``arrival``, each taken up before the next one, and
    those without a number at last.

    The table is read once and stored by group; a group's folder is then moved into the folder
    that one running query reads. Returns where the query's triggers wrote.
    """
    path, events = fresh_path(spark, name), table(spark, sf, "events")
    numbered = events.withColumn("arrival", F.coalesce(arrival.cast("long"), F.lit(LATEST)))
    write_parquet(numbered, f"{path}/waiting", ("arrival",), ROWS_PER_FILE)
    groups = sorted(r[0] for r in spark.read.parquet(f"{path}/waiting").select("arrival")
                    .distinct().collect())  # a few
    store = JavaFolder(spark, f"{path}/in")
    sink = sink or runs.per_trigger_sink(f"{path}/out")
    stream = build(table_stream(spark, f"{path}/in", events.schema, nested=True))
    query = runs.start(stream, sink, f"{path}/checkpoint", mode, every="0 seconds", **options)
    try:
        for n in groups:
            store.take(f"{path}/waiting/arrival={n}")
            query.processAllAvailable()
    finally:
        query.stop()
        runs.finish(query)
    return f"{path}/out"


def _ten_days():
    """The ten days of its month that an event belongs to, in order."""
    tens = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    return F.year("ts") * 36 + F.month("ts") * 3 + tens


@query
def stream_source_parse(spark, sf):
    parsed = parse_messages(_messages(_event_stream(spark, sf)), keep=("key",)).select(
        "key", F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.col(POWER).try_cast("double").alias("power"), "event_timestamp")
    return spark.read.parquet(_run(spark, parsed, "parse", "append")).drop("trigger_id",
                                                                        "written_at")


@query
def stream_tumbling(spark, sf):
    """Windows of a stream in order of time, whose state the watermark keeps small."""
    out = _feed(spark, sf, _ten_days(), lambda e: windows.tumbling(_live(e), watermark=WATERMARK),
                "tumbling")
    return tidy(runs.latest(spark, out, ["window_start"]))


@query
def stream_sliding(spark, sf):
    out = _feed(spark, sf, _ten_days(), lambda e: windows.sliding(_live(e), watermark=WATERMARK),
                "sliding")
    return tidy(runs.latest(spark, out, ["window_start", "window_end"]), 4)


@query
def sliding_windows(spark, sf):
    """Batch form, from the first event's slide on."""
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("value").alias(POWER))
    return tidy(windows.from_first_slide(windows.sliding(events), events), 4)


@query
def sliding_last10(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("value").alias(POWER))
    return tidy(windows.last_windows(windows.sliding(events)), 4)


@query
def stream_submetering(spark, sf):
    snapshot = windows.submetering_snapshot(_live(_event_stream(spark, sf)), F.lit(NOW_MS))
    out = _run(spark, snapshot, "submetering", "complete")
    return windows.submetering_shares(runs.latest(spark, out, []))


@query
def stream_bucket_counts(spark, sf):
    live = _live(_event_stream(spark, sf)).withColumn("kw", F.col(POWER) / 25)
    out = _run(spark, windows.bucket_counts(sketches.with_power_class(live, "kw")), "buckets")
    return runs.latest(spark, out, ["bucket"])


@query
def stream_cms(spark, sf):
    """A Count-Min sketch that a stream of users updates."""
    users = _event_stream(spark, sf).select(F.col("user_id").cast("string").alias("item"))
    out = _run(spark, sketches.cms_update(users, "item"), "sketch")
    return runs.latest(spark, out, ["row", "col"])


@query
def stream_sink_batches(spark, sf):
    """Rows in the latest view of the three per-trigger outputs."""
    outputs = {
        "tumbling_windows": (windows.tumbling, ["window_start"], "update"),
        "sliding_windows": (windows.sliding, ["window_start"], "update"),
        "submetering": (windows.submetering_snapshot, [], "complete"),
    }
    latest = {name: runs.latest(spark, _run(spark, build(_live(_event_stream(spark, sf))), name,
                                            mode), keys)
              for name, (build, keys, mode) in outputs.items()}
    return profile.volume(**latest)


@query
def stream_watermark(spark, sf):
    """Five-minute windows of a stream with late rows, under the ten-minute watermark.

    Errors arrive two groups after their own ten days.
    """
    base = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    arrival = base + F.when(F.col("event_type") == "error", 2).otherwise(0)

    def build(events):
        readings = events.select(F.col("ts").cast("timestamp").alias("event_time"),
                                 F.col("value").alias(POWER))
        return windows.tumbling(readings, watermark=WATERMARK)
    out = _feed(spark, sf, arrival, build, "watermark")
    return tidy(runs.latest(spark, out, ["window_start"]))


@query
def stream_dedup(spark, sf):
    """Distinct keys of a stream, each kept once."""
    unique = runs.drop_duplicates(_event_stream(spark, sf).select("user_id"), ["user_id"])
    return spark.read.parquet(_run(spark, unique, "dedup", "append")).select("user_id")


@query
def stream_dedup_within(spark, sf):
    """Distinct keys of a stream, remembered for as long as the table spans."""
    events = _event_stream(spark, sf).select(
        "user_id", F.col("ts").cast("timestamp").alias("event_time"))
    unique = runs.drop_duplicates(events, ["user_id"], within="400 days")
    return spark.read.parquet(_run(spark, unique, "within", "append")).select("user_id")


@query
def stream_dedup_sketch(spark, sf):
    """Deduplication of a stream by a crowded Bloom filter: 200 keys planned, all users fed."""
    sink = runs.BloomDedup(fresh_path(spark, "bloom"), "user_id", capacity=200)
    _feed(spark, sf, _ten_days(), lambda e: e.select("user_id"), "bloom-in", "append", sink)
    return sketches.bloom_summary(sink.report(spark), 200)


@query
def stream_dedup_state(spark, sf):
    """Users that a crowded, sharded Bloom filter in stream state lets pass: 200 keys planned."""
    out = _feed(spark, sf, _ten_days(), lambda e: runs.drop_near_duplicates(
        e.select("user_id"), "user_id", capacity=200, shards=4), "state", "append",
        state_store=runs.ROCKS_DB)
    return spark.read.parquet(out).select("user_id")


@query
def session_report(spark, sf):
    """Totals of a stream session, from the progress kept for every trigger."""
    log = fresh_path(spark, "progress")
    _run(spark, _live(runs.observed(_event_stream(spark, sf))).select("event_time"), "session",
         "append", log)
    return runs.live_summary(spark, log).select(
        "total_received", "total_triggers", (F.col("elapsed_sec") > 0).alias("timed"),
        (F.col("throughput_rps") > 0).alias("rated"))


@query
def json_report(spark, sf):
    """A report appended as JSON lines, read back."""
    path = fresh_path(spark, "report")
    report = sketches.bloom_report(table(spark, sf, "orders"), "o_custkey", "o_orderkey")
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def latency_avg(spark, sf):
    stamped = table(spark, sf, "events").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_timestamp"))
    return windows.latency(stamped, F.lit(NOW_MS))


@query
def session_summary(spark, sf):
    messages = as_messages(standins.readings(spark, sf), stamp=F.unix_millis("Datetime"))
    return windows.session_summary(windows.live_readings(parse_messages(messages)),
                                   F.lit(NOW_MS))


# ---- Models: no SQL counterpart ---------------------------------------------------------

def _model_table(spark, sf):
    """The split feature table, written once for the many jobs of a training."""
    return written(_split_features(spark, sf), "split")


def _forest(table_):
    return learning.train_and_test(learning.forest(), table_, "random_forest")


def _metrics_row(spark, fitted):
    return spark.createDataFrame(
        [(fitted.name, *(float(fitted.metrics[k]) for k in ("MAE", "RMSE", "R2", "MAPE")))],
        "model string, MAE double, RMSE double, R2 double, MAPE double")


@query
def train_forest(spark, sf):
    return _metrics_row(spark, _forest(_model_table(spark, sf)))


@query
def train_boosted(spark, sf):
    fitted = learning.train_and_test(learning.boosted(), _model_table(spark, sf),
                                     "gradient_boosting")
    return _metrics_row(spark, fitted)


@query
def best_model(spark, sf):
    """Both models on the same split, and which of them is kept (the higher R2)."""
    table_ = _model_table(spark, sf)
    forest = _forest(table_)
    boosted = learning.train_and_test(learning.boosted(), table_, "gradient_boosting",
                                      features=forest.features, medians=forest.medians)
    best = learning.choose_best(forest, boosted)
    return _metrics_row(spark, forest).unionByName(_metrics_row(spark, boosted)).withColumn(
        "is_best", F.col("model") == best.name)


@query
def cv_forest(spark, sf):
    table_ = _model_table(spark, sf)
    return learning.cv_summary(learning.cross_validate(
        learning.forest_cv(), table_, learning.feature_columns(table_)))


@query
def cv_boosted(spark, sf):
    table_ = _model_table(spark, sf)
    return learning.cv_summary(learning.cross_validate(
        learning.boosted_cv(), table_, learning.feature_columns(table_)))


@query
def forest_importance(spark, sf):
    return explain.importance(_forest(_model_table(spark, sf)))


@query
def permutation_effects(spark, sf):
    table_ = _model_table(spark, sf)
    return explain.permutation_effects(_forest(table_), table_.where(F.col("split") == "test"))


@query
def score_forest(spark, sf):
    """Register a forest, load it again by its version, score all days with tree intervals."""
    table_ = _model_table(spark, sf)
    base = fresh_path(spark, "registry")
    path = registry.register(spark, base, _forest(table_), "v1.0", ("", ""), ("", ""))
    return learning.batch_score(registry.load(spark, base, "v1.0"), table_, model_path=path)


@query
def model_registry(spark, sf):
    """Two registered versions; the registry's latest pointer."""
    table_ = _model_table(spark, sf)
    base = fresh_path(spark, "registry")
    fitted = _forest(table_)
    for version, at in [("v1.0", "2024-01-01 00:00:00"), ("v1.1", "2024-02-01 00:00:00")]:
        registry.register(spark, base, fitted, version, ("", ""), ("", ""), now=at)
    return registry.latest(spark, base)
