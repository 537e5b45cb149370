"""Equivalent SQL (DuckDB dialect) for the catalog queries, written without the operators."""

import math



def half_up(sql):
    """Make every ``round(x, n)`` decimal, half away from zero, as Spark rounds doubles.

    DuckDB rounds the binary value, which differs where the decimal text ends in a 5.
    """
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        if start and (sql[start - 1].isalnum() or sql[start - 1] == "_"):
            out.append(sql[at:start + 6])
            at = start + 6
            continue
        depth, end, comma = 1, start + 6, None
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if sql[end] == "," and depth == 1:
                comma = end
            end += 1
        inner, digits = half_up(sql[start + 6:comma]), sql[comma + 1:end - 1].strip()
        out += [sql[at:start],
                f"CAST(round(CAST({inner} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"]
        at = end
    return "".join(out) + sql[at:]


class _Queries(dict):
    def __setitem__(self, name, sql):
        super().__setitem__(name, half_up(sql))


ORACLE = _Queries()

# ---- Stand-in tables --------------------------------------------------------------------

READINGS = """
readings AS (
  SELECT event_id, user_id, event_type, ts AS "Datetime", CAST(ts AS DATE) AS "Date",
         CAST(year(ts) AS INTEGER) AS "Year", CAST(month(ts) AS INTEGER) AS "Month", value AS kw,
         CASE WHEN event_type = 'view' THEN value ELSE 0 END AS sm1,
         CASE WHEN event_type = 'click' THEN value ELSE 0 END AS sm2,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS sm3,
         CASE WHEN event_type = 'signup' THEN value ELSE 0 END AS sm4
  FROM events)"""

RAW = """
raw AS (
  SELECT event_id, event_type, value AS v,
         CASE WHEN value > 200 THEN NULL ELSE date_trunc('second', ts) END AS dt,
         CASE WHEN event_type = 'error' OR value < 7 THEN NULL ELSE value END AS gap,
         CASE WHEN event_type = 'click' THEN NULL ELSE value END AS grp,
         value AS volt,
         CASE WHEN value < 10 THEN NULL ELSE value END AS inten,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS s1,
         CAST(1.5 AS DOUBLE) AS s2,
         CASE WHEN event_type = 'purchase' THEN NULL ELSE value END AS s3
  FROM events),
typed AS (
  SELECT *, round(gap * 1000 / 60 - s1 - s2 - s3, 4) AS rest FROM raw)"""


def daily(key=""):
    k = f"{key}, " if key else ""
    return f"""
daily AS (
  SELECT {k}CAST(o_orderdate AS DATE) AS "Date",
         CAST(year(o_orderdate) AS INTEGER) AS "Year",
         CAST(month(o_orderdate) AS INTEGER) AS "Month",
         round(sum(o_totalprice) / 1e5, 4) AS total_kwh,
         round(avg(o_totalprice) / 1e5, 4) AS avg_kw,
         round(max(o_totalprice) / 1e5, 4) AS peak_kw,
         count(*) AS minutes_recorded,
         round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) / 1e5, 4)
           AS kitchen_kwh,
         round(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice ELSE 0 END) / 1e5, 4)
           AS laundry_kwh,
         round(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice ELSE 0 END) / 1e5, 4)
           AS hvac_kwh,
         round(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice ELSE 0 END)
               / 1e5, 4) AS other_kwh
  FROM orders GROUP BY ALL)"""


WEATHER = """
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS "Date", round(avg(l_quantity) - 5, 4) AS temp_mean_c,
         max(l_quantity) AS temp_max_c, min(l_quantity) AS temp_min_c,
         round(greatest(sum(l_tax) - 0.8, 0), 4) AS precip_mm
  FROM lineitem GROUP BY ALL)"""

JOINED = """
joined AS (SELECT * FROM daily LEFT JOIN weather USING ("Date"))"""


def features(key=""):
    part = f"PARTITION BY {key} " if key else ""
    return f"""WITH {daily(key)}, {WEATHER}, {JOINED},
basic AS (
  SELECT *,
    CAST(isodow("Date") - 1 AS INTEGER) AS day_of_week,
    CAST(dayofyear("Date") AS INTEGER) AS day_of_year,
    CAST(weekofyear("Date") AS INTEGER) AS week_of_year,
    CAST(month("Date") AS INTEGER) AS cal_month, CAST(year("Date") AS INTEGER) AS cal_year,
    CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CAST((month("Date") % 12) // 3 AS INTEGER) AS season,
    temp_max_c - temp_min_c AS temp_range,
    CASE WHEN temp_mean_c IS NULL THEN NULL ELSE greatest(0, 18 - temp_mean_c) END AS hdd,
    CASE WHEN temp_mean_c IS NULL THEN NULL ELSE greatest(0, temp_mean_c - 22) END AS cdd,
    CASE WHEN temp_mean_c >= 16 AND temp_mean_c <= 22 THEN 1 ELSE 0 END AS in_comfort_zone,
    CASE WHEN precip_mm > 0.1 THEN 1 ELSE 0 END AS has_rain,
    kitchen_kwh / nullif(total_kwh, 0) AS kitchen_ratio,
    laundry_kwh / nullif(total_kwh, 0) AS laundry_ratio,
    hvac_kwh / nullif(total_kwh, 0) AS hvac_ratio,
    other_kwh / nullif(total_kwh, 0) AS other_ratio
  FROM joined),
lagged AS (
  SELECT *,
    sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
    sin(2 * pi() * cal_month / 12) AS month_sin, cos(2 * pi() * cal_month / 12) AS month_cos,
    sin(2 * pi() * day_of_year / 365) AS doy_sin, cos(2 * pi() * day_of_year / 365) AS doy_cos,
    lag(total_kwh, 1) OVER w AS lag_1_kwh, lag(total_kwh, 2) OVER w AS lag_2_kwh,
    lag(total_kwh, 7) OVER w AS lag_7_kwh, lag(total_kwh, 14) OVER w AS lag_14_kwh,
    lag(total_kwh, 30) OVER w AS lag_30_kwh, lag(temp_mean_c, 1) OVER w AS lag_1_temp,
    CASE WHEN count(total_kwh) OVER week >= 3 THEN avg(total_kwh) OVER week END AS roll_7_mean,
    CASE WHEN count(total_kwh) OVER week >= 3 THEN stddev_samp(total_kwh) OVER week END
      AS roll_7_std,
    CASE WHEN count(total_kwh) OVER week >= 3 THEN max(total_kwh) OVER week END AS roll_7_max,
    CASE WHEN count(total_kwh) OVER month >= 7 THEN avg(total_kwh) OVER month END AS roll_30_mean,
    CASE WHEN count(total_kwh) OVER month >= 7 THEN stddev_samp(total_kwh) OVER month END
      AS roll_30_std,
    lag(total_kwh, 1) OVER w - lag(total_kwh, 8) OVER w AS wow_change,
    lag(hvac_ratio, 1) OVER w AS lag_1_hvac_ratio,
    hdd * is_weekend AS hdd_x_weekend, hdd * season AS hdd_x_season,
    temp_mean_c * is_weekend AS temp_x_weekend
  FROM basic
  WINDOW w AS ({part}ORDER BY "Date"),
    week AS ({part}ORDER BY "Date" ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    month AS ({part}ORDER BY "Date" ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
features AS (
  SELECT * FROM lagged
  WHERE total_kwh IS NOT NULL AND lag_7_kwh IS NOT NULL AND roll_7_mean IS NOT NULL)"""


FEATURES = features()

CALENDAR = ["day_of_week", "day_of_year", "week_of_year", "cal_month", "cal_year", "is_weekend",
            "season"]
CYCLICAL = ["dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos"]
WEATHER_IN = ["temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm"]
WEATHER_OUT = ["temp_range", "hdd", "cdd", "in_comfort_zone", "has_rain"]
LAG = ["lag_1_kwh", "lag_2_kwh", "lag_7_kwh", "lag_14_kwh", "lag_30_kwh", "lag_1_temp"]
ROLLING = ["roll_7_mean", "roll_7_std", "roll_7_max", "roll_30_mean", "roll_30_std", "wow_change"]
RATIOS = ["kitchen_ratio", "laundry_ratio", "hvac_ratio", "other_ratio", "lag_1_hvac_ratio"]
INTERACTION = ["hdd_x_weekend", "hdd_x_season", "temp_x_weekend"]
GROUPS = {"Temporal": CALENDAR + CYCLICAL, "Weather": WEATHER_IN + WEATHER_OUT, "Lag": LAG,
          "Rolling": ROLLING, "Sub-metering": RATIOS, "Interaction": INTERACTION}
INTEGERS = {*CALENDAR, "in_comfort_zone", "has_rain"}


def rounded(columns, digits=6):
    return ", ".join(c if c in INTEGERS else f"round({c}, {digits}) AS {c}" for c in columns)


# ---- Cleaning ---------------------------------------------------------------------------

ORACLE["clean_numeric"] = f"""WITH {RAW}
SELECT event_id, gap AS "Global_active_power", grp AS "Global_reactive_power", volt AS "Voltage",
       inten AS "Global_intensity", s1 AS "Sub_metering_1", s2 AS "Sub_metering_2",
       s3 AS "Sub_metering_3" FROM raw"""
ORACLE["parse_datetime"] = f"""WITH {RAW} SELECT event_id, dt AS "Datetime" FROM raw"""
ORACLE["derive_remainder"] = f"""WITH {RAW}
SELECT event_id, rest AS "Sub_metering_remainder" FROM typed"""
ORACLE["clean_readings"] = f"""WITH {RAW}
SELECT event_id, round(gap, 4) AS "Global_active_power", round(grp, 4) AS "Global_reactive_power",
       round(volt, 4) AS "Voltage", round(inten, 4) AS "Global_intensity",
       round(s1, 4) AS "Sub_metering_1", round(s2, 4) AS "Sub_metering_2",
       round(s3, 4) AS "Sub_metering_3", dt AS "Datetime", rest AS "Sub_metering_remainder",
       CAST(year(dt) AS INTEGER) AS "Year", CAST(month(dt) AS INTEGER) AS "Month"
FROM typed WHERE gap IS NOT NULL"""
ORACLE["drop_null_report"] = f"""WITH {RAW}
SELECT count(*) AS total_rows, count(gap) AS clean_rows, count(*) - count(gap) AS dropped_rows,
       round((count(*) - count(gap)) * 100.0 / count(*), 2) AS dropped_pct FROM typed"""
ORACLE["partition_cols"] = """
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS "Year",
       CAST(month(o_orderdate) AS INTEGER) AS "Month" FROM orders"""
ORACLE["clean_weather"] = """
SELECT CAST(l_shipdate AS DATE) AS "Date", max(l_quantity) AS temperature_2m_max,
       CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(month(l_shipdate) AS INTEGER) AS "Month"
FROM lineitem GROUP BY ALL"""
ORACLE["conform_types"] = """
SELECT event_id, ts AS "Datetime", CAST(year(ts) AS INTEGER) AS "Year",
       CAST(month(ts) AS INTEGER) AS "Month", CAST(ts AS DATE) AS "Date" FROM events"""
BUCKET = """CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} < 0.5 THEN '0-0.5kW'
  WHEN {x} < 1 THEN '0.5-1kW' WHEN {x} < 2 THEN '1-2kW' WHEN {x} < 3 THEN '2-3kW'
  WHEN {x} < 5 THEN '3-5kW' ELSE '5+kW' END"""
EVENT_BUCKET = BUCKET.format(x="(value / 25)")
ORACLE["consumption_bucket"] = f"SELECT event_id, {EVENT_BUCKET} AS bucket FROM events"
ORACLE["ingest_text"] = f"""WITH {RAW}
SELECT CAST(year(dt) AS INTEGER) AS "Year", CAST(month(dt) AS INTEGER) AS "Month",
       count(*) AS row_count, round(sum(gap), 4) AS total_power
FROM typed WHERE gap IS NOT NULL GROUP BY ALL"""
ORACLE["validate_counts_report"] = f"""WITH {RAW}, {WEATHER}
SELECT 'cleaned' AS label, count(*) AS expected_rows, count(*) AS actual_rows, 'PASS' AS status
FROM typed WHERE gap IS NOT NULL
UNION ALL SELECT 'raw_weather', count(*), count(*), 'PASS' FROM weather"""
MISSING = {
    "Global_active_power": "event_type = 'error' OR v < 6",
    "Global_reactive_power": "event_type = 'click'",
    "Voltage": "false",
    "Global_intensity": "v < 10",
    "Sub_metering_1": "event_type = 'view'",
    "Sub_metering_2": "false",
    "Sub_metering_3": "event_type = 'purchase'",
}
ORACLE["profile_missing"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({cond}) AS missing,
    round(count(*) FILTER ({cond}) * 100.0 / count(*), 2) AS missing_pct FROM raw"""
    for c, cond in MISSING.items())
# Blank and quoted-empty text stays text at the scan; only NULL and the exact token become NULL.
SCAN_NULL = {
    "Global_active_power": "event_type = 'error' OR (v >= 4 AND v < 6)",
    "Global_reactive_power": "event_type = 'click'",
    "Voltage": "false",
    "Global_intensity": "false",
    "Sub_metering_1": "event_type = 'view'",
    "Sub_metering_2": "false",
    "Sub_metering_3": "false",
}
ORACLE["scan_readings_text"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({cond}) AS missing,
    round(count(*) FILTER ({cond}) * 100.0 / count(*), 2) AS missing_pct,
    count(*) FILTER ({SCAN_NULL[c]}) AS null_after_scan FROM raw"""
    for c, cond in MISSING.items())
ORACLE["scan_weather_csv"] = f"""WITH {WEATHER} SELECT * FROM weather"""
ORACLE["roundtrip_parquet"] = f"""WITH {daily()}
SELECT "Date", total_kwh, minutes_recorded FROM daily"""
ORACLE["roundtrip_partitioned"] = f"""WITH {daily()}
SELECT "Date", "Year", "Month", total_kwh FROM daily"""
ORACLE["pruned_count"] = """
SELECT 'all' AS dataset, count(*) AS row_count FROM orders
UNION ALL SELECT 'january', count(*) FROM orders WHERE month(o_orderdate) = 1
UNION ALL SELECT 'year_1997', count(*) FROM orders WHERE year(o_orderdate) = 1997
UNION ALL SELECT 'january_1998', count(*) FROM orders
  WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 1"""
ORACLE["daily_rebuild"] = f"""WITH {READINGS}, {WEATHER},
shifted AS (SELECT * REPLACE ("Date" + 9000 AS "Date") FROM weather),
days AS (
  SELECT "Date", round(sum(kw) / 60, 6) AS total_kwh, round(avg(kw), 6) AS avg_kw,
         round(max(kw), 6) AS peak_kw, count(kw) AS minutes_recorded,
         round(sum(sm1) / 1000, 6) AS kitchen_kwh, round(sum(sm2) / 1000, 6) AS laundry_kwh,
         round(sum(sm3) / 1000, 6) AS hvac_kwh, round(sum(sm4) / 1000, 6) AS other_kwh
  FROM readings GROUP BY ALL)
SELECT * FROM days LEFT JOIN shifted USING ("Date")"""
ORACLE["join_submetering"] = f"""WITH {daily()}
SELECT "Date", total_kwh, kitchen_kwh, laundry_kwh, hvac_kwh, other_kwh FROM daily"""
ORACLE["publish_json"] = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "key", value AS power,
       CASE WHEN event_type = 'view' THEN value ELSE 0 END AS kitchen,
       CAST(year(ts) AS INTEGER) AS "Year", CAST(1706745600000 AS BIGINT) AS event_timestamp,
       date_trunc('second', ts) AS event_time
FROM events"""

# ---- Profiling --------------------------------------------------------------------------

ORACLE["profile_volume"] = """
SELECT 'readings' AS dataset, count(*) AS row_count FROM events
UNION ALL SELECT 'weather', count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem"""
ORACLE["profile_range"] = """
SELECT min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date
FROM events WHERE value <= 200"""
ORACLE["profile_schema"] = """
SELECT table_name AS dataset, CAST(ordinal_position - 1 AS INTEGER) AS "position",
       column_name AS "column",
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS "type", row_count
FROM information_schema.columns JOIN (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ["events", "lineitem", "orders", "customer"]) + ") n USING (table_name)"
ORACLE["profile_stats"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
    round(stddev_samp({x}), 6) AS stddev, round(min({x}), 6) AS min, round(max({x}), 6) AS max
    FROM raw""" for c, x in zip(MISSING, ["gap", "grp", "volt", "inten", "s1", "s2", "s3"]))
ORACLE["rows_per_year"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year", count(*) AS row_count
FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY ALL"""
ORACLE["rows_per_month"] = """
SELECT CAST(month(o_orderdate) AS INTEGER) AS "Month", count(*) AS row_count
FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY ALL"""
ORACLE["partition_sizes"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year", count(*) AS row_count
FROM orders GROUP BY ALL"""
ORACLE["skew_report"] = """
WITH sizes AS (SELECT year(o_orderdate), month(o_orderdate), count(*) AS n
               FROM orders GROUP BY ALL),
s AS (SELECT count(*) AS num_partitions, min(n) AS min_rows, max(n) AS max_rows,
             round(avg(n), 0) AS avg_rows, round(stddev_samp(n), 0) AS stddev_rows FROM sizes)
SELECT *, round(max_rows / greatest(min_rows, 1), 2) AS skew_ratio,
       CASE WHEN max_rows / greatest(min_rows, 1) < 3 THEN 'LOW'
            WHEN max_rows / greatest(min_rows, 1) < 10 THEN 'MODERATE' ELSE 'HIGH' END
         AS assessment FROM s"""
ORACLE["feature_summary"] = FEATURES + " UNION ALL ".join(
    f"""
SELECT '{c}' AS feature, '{g}' AS feature_group, round(avg({c}), 5) AS mean,
       round(stddev_samp({c}), 5) AS stddev, count(*) - count({c}) AS missing FROM features"""
    for g, cols in GROUPS.items() for c in cols)

# ---- Aggregates and joins ---------------------------------------------------------------

ORACLE["hourly_patterns"] = f"""WITH {READINGS}
SELECT CAST(hour("Datetime") AS INTEGER) AS "Hour", round(avg(kw), 4) AS avg_kw,
       round(max(kw), 4) AS peak_kw, round(min(kw), 4) AS min_kw,
       round(stddev_samp(kw), 4) AS stddev_kw, count(*) AS record_count
FROM readings GROUP BY ALL"""
DAY = """"Date", "Year", "Month", round(sum(kw) / 60, 4) AS total_kwh, round(avg(kw), 4) AS avg_kw,
       round(max(kw), 4) AS peak_kw, count(*) AS minutes_recorded"""
ORACLE["daily_totals"] = f"WITH {READINGS} SELECT {DAY} FROM readings GROUP BY ALL"
ORACLE["daily_totals_by_user"] = f"WITH {READINGS} SELECT user_id, {DAY} FROM readings GROUP BY ALL"
ORACLE["monthly_summary"] = f"""WITH {READINGS}
SELECT "Year", "Month", round(sum(kw) / 60, 4) AS total_kwh, round(avg(kw), 4) AS avg_kw,
       round(max(kw), 4) AS peak_kw, round(stddev_samp(kw), 4) AS stddev_kw,
       round(avg(sm1), 4) AS avg_sm1_kitchen_wh, round(avg(sm2), 4) AS avg_sm2_laundry_wh,
       round(avg(sm3), 4) AS avg_sm3_hvac_wh, round(avg(sm4), 4) AS avg_sm_other_wh,
       count(*) AS minutes_recorded
FROM readings GROUP BY ALL"""
SUBMETER = f"""WITH {READINGS},
kwh AS (SELECT "Date", "Year", "Month", round(sum(sm1) / 1000, 4) AS kitchen_kwh,
               round(sum(sm2) / 1000, 4) AS laundry_kwh, round(sum(sm3) / 1000, 4) AS hvac_kwh,
               round(sum(sm4) / 1000, 4) AS other_kwh, round(sum(kw) / 60, 4) AS total_kwh
        FROM readings GROUP BY ALL),
sub AS (SELECT *, round(kitchen_kwh / nullif(total_kwh, 0) * 100, 2) AS kitchen_pct,
               round(laundry_kwh / nullif(total_kwh, 0) * 100, 2) AS laundry_pct,
               round(hvac_kwh / nullif(total_kwh, 0) * 100, 2) AS hvac_pct,
               round(other_kwh / nullif(total_kwh, 0) * 100, 2) AS other_pct FROM kwh)"""
ORACLE["submetering_daily"] = f"{SUBMETER} SELECT * FROM sub"
ORACLE["submetering_share_avg"] = f"""{SUBMETER}
SELECT round(avg(kitchen_pct), 2) AS kitchen_pct, round(avg(laundry_pct), 2) AS laundry_pct,
       round(avg(hvac_pct), 2) AS hvac_pct, round(avg(other_pct), 2) AS other_pct FROM sub"""
ORACLE["batch_tables"] = f"""{SUBMETER},
hourly AS (SELECT hour("Datetime"), round(stddev_samp(kw), 4) AS x FROM readings GROUP BY ALL),
monthly AS (SELECT "Year", "Month", round(stddev_samp(kw), 4) AS x FROM readings GROUP BY ALL)
SELECT 'hourly' AS dataset, count(*) AS row_count, round(sum(x), 4) AS checksum FROM hourly
UNION ALL SELECT 'daily', count(*), round(sum(total_kwh), 4) FROM sub
UNION ALL SELECT 'monthly', count(*), round(sum(x), 4) FROM monthly
UNION ALL SELECT 'submetering', count(*), round(sum(hvac_pct), 4) FROM sub"""
ORACLE["daily_group_count"] = "SELECT count(DISTINCT CAST(ts AS DATE)) AS daily_groups FROM events"
DAILY_COLUMNS = """"Date", "Year", "Month", total_kwh, avg_kw, peak_kw, minutes_recorded,
       temp_mean_c, temp_max_c, temp_min_c, precip_mm"""
ORACLE["join_daily_weather"] = f"""WITH {daily()}, {WEATHER}, {JOINED}
SELECT {DAILY_COLUMNS} FROM joined"""
ORACLE["join_match_counts"] = f"""WITH {daily()}, {WEATHER}, {JOINED}
SELECT count(*) AS daily_rows, count(temp_mean_c) AS matched_rows FROM joined"""
ORACLE["corr_pair"] = f"""WITH {daily()}, {WEATHER}, {JOINED},
c AS (SELECT corr(total_kwh, temp_mean_c) AS r FROM joined)
SELECT round(r, 6) AS correlation, CASE WHEN r < 0 THEN 'negative' ELSE 'positive' END
  AS interpretation FROM c"""
ORACLE["corr_topk"] = FEATURES + ", r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, total_kwh) AS r FROM features"
    for cols in GROUPS.values() for c in cols) + """)
SELECT feature, round(r, 6) AS correlation, CASE WHEN r > 0 THEN 'up' ELSE 'down' END AS direction
FROM r WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, feature LIMIT 10"""
ORACLE["batch_vs_stream"] = f"""WITH {READINGS},
d AS (SELECT "Date", round(sum(kw) / 60, 4) AS total_kwh FROM readings GROUP BY ALL)
SELECT count(*) AS batch_days, round(sum(total_kwh), 4) AS batch_total_kwh,
       round(avg(total_kwh), 4) AS batch_avg_kwh,
       (SELECT count(*) FROM events) AS stream_records,
       (SELECT round(avg(1706745600000 - epoch_us(ts) // 1000), 2) FROM events) AS stream_latency_ms
FROM d"""

# ---- Features ---------------------------------------------------------------------------

ORACLE["feature_calendar"] = f'{FEATURES} SELECT "Date", {", ".join(CALENDAR)} FROM lagged'
ORACLE["feature_cyclical"] = f'{FEATURES} SELECT "Date", {rounded(CYCLICAL)} FROM lagged'
ORACLE["feature_weather"] = f'{FEATURES} SELECT "Date", {rounded(WEATHER_OUT)} FROM lagged'
ORACLE["feature_lags"] = f'{FEATURES} SELECT "Date", {", ".join(LAG)} FROM lagged'
ORACLE["feature_rolling"] = f'{FEATURES} SELECT "Date", {rounded(ROLLING)} FROM lagged'
ORACLE["feature_ratios"] = f'{FEATURES} SELECT "Date", {rounded(RATIOS)} FROM lagged'
ORACLE["feature_interactions"] = f'{FEATURES} SELECT "Date", {rounded(INTERACTION)} FROM lagged'
ORACLE["feature_table"] = f"""{FEATURES}
SELECT "Date", "Year", "Month", minutes_recorded,
       {rounded(["total_kwh", "avg_kw", "peak_kw", "kitchen_kwh", "laundry_kwh", "hvac_kwh",
                 "other_kwh", *[c for cols in GROUPS.values() for c in cols]])} FROM features"""
ORACLE["feature_table_by_status"] = f"""{features("o_orderstatus")}
SELECT o_orderstatus, "Date", {rounded(LAG + ROLLING)} FROM features"""
ORACLE["feature_drop_report"] = f"""{FEATURES}
SELECT count(*) AS rows_before, (SELECT count(*) FROM features) AS rows_after,
       count(*) - (SELECT count(*) FROM features) AS rows_dropped FROM joined"""
ORACLE["reading_lags"] = """
SELECT event_id, round(value, 6) AS total_kwh,
  round(CASE WHEN count(value) OVER week >= 3 THEN avg(value) OVER week END, 6) AS roll_7_mean,
  round(CASE WHEN count(value) OVER week >= 3 THEN stddev_samp(value) OVER week END, 6)
    AS roll_7_std,
  round(CASE WHEN count(value) OVER week >= 3 THEN max(value) OVER week END, 6) AS roll_7_max,
  round(CASE WHEN count(value) OVER month >= 7 THEN avg(value) OVER month END, 6) AS roll_30_mean,
  round(CASE WHEN count(value) OVER month >= 7 THEN stddev_samp(value) OVER month END, 6)
    AS roll_30_std,
  round(lag(value, 1) OVER w - lag(value, 8) OVER w, 6) AS wow_change
FROM events
WINDOW w AS (ORDER BY ts, event_id),
  week AS (ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  month AS (ORDER BY ts, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""

# ---- Splits and learning inputs ---------------------------------------------------------

POSITIONS = """
p AS (SELECT *, row_number() OVER (ORDER BY "Date") - 1 AS pos, count(*) OVER () AS n FROM {t})"""
ORACLE["time_split"] = f"""WITH {daily()}, {POSITIONS.format(t="daily")}
SELECT "Date", total_kwh,
       CASE WHEN pos < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM p"""
ORACLE["cv_folds"] = f"""WITH {daily()}, {POSITIONS.format(t="daily")},
f AS (SELECT *, n // 6 AS size, n - 5 * (n // 6) AS first FROM p),
g AS (SELECT *, CASE WHEN pos < first THEN 0 ELSE (pos - first) // size + 1 END AS fold FROM f)
SELECT CAST(fold AS INTEGER) AS fold, min(pos) AS n_train, count(*) AS n_test,
       min("Date") AS test_from, max("Date") AS test_to
FROM g WHERE fold > 0 GROUP BY fold"""
MODEL_FEATURES = [c for cols in GROUPS.values() for c in cols if c != "cal_year"]
ORACLE["feature_columns"] = FEATURES + " UNION ALL ".join(
    f"\nSELECT '{c}' AS feature, count({c}) AS n_values FROM features HAVING count({c}) > 0"
    for c in MODEL_FEATURES)
ORACLE["impute_median"] = f"""{FEATURES}
SELECT "Date", """ + ", ".join(
    f"""round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM features)), 6) AS {c}"""
    for c in ["lag_30_kwh", "roll_30_mean", "temp_mean_c", "lag_14_kwh"]) + " FROM features"
ORACLE["reading_medians"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}, 0.5), 6) AS median FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])

# ---- Scoring and monitoring -------------------------------------------------------------

SCORED = f"""{FEATURES},
scored AS (
  SELECT "Date", total_kwh AS actual_kwh, round(lag_7_kwh, 4) AS predicted_kwh,
         round(greatest(lag_7_kwh - 3, 0), 4) AS lower_bound,
         round(lag_7_kwh + 3, 4) AS upper_bound,
         round(abs(total_kwh - lag_7_kwh), 4) AS abs_error,
         round(abs(total_kwh - lag_7_kwh) / greatest(abs(total_kwh), 0.1) * 100, 2) AS pct_error,
         "Year", "Month", 'v1.0' AS model_version
  FROM lagged WHERE lag_7_kwh IS NOT NULL)"""
ORACLE["score_naive"] = f"{SCORED} SELECT * FROM scored"
ORACLE["score_summary"] = f"""{SCORED}
SELECT count(*) AS n_scored, round(avg(predicted_kwh), 6) AS mean_predicted,
       round(avg(actual_kwh), 6) AS mean_actual, round(avg(abs_error), 6) AS mean_abs_error,
       round(avg(pct_error), 6) AS mean_pct_error,
       round(count(*) FILTER (actual_kwh BETWEEN lower_bound AND upper_bound) * 100.0 / count(*), 6)
         AS within_interval_pct FROM scored"""
ORACLE["eval_metrics"] = f"""{SCORED}
SELECT 'naive' AS model, round(avg(abs(actual_kwh - predicted_kwh)), 6) AS "MAE",
       round(sqrt(avg((actual_kwh - predicted_kwh) ** 2)), 6) AS "RMSE",
       round(1 - sum((actual_kwh - predicted_kwh) ** 2)
             / sum((actual_kwh - (SELECT avg(actual_kwh) FROM scored)) ** 2), 6) AS "R2",
       round(avg(abs(actual_kwh - predicted_kwh) / greatest(abs(actual_kwh), 0.1)) * 100, 6)
         AS "MAPE" FROM scored"""
ORACLE["baseline_improvement"] = f"""{SCORED},
b AS (SELECT avg(abs(actual_kwh - (SELECT avg(actual_kwh) FROM scored))) AS base,
             avg(abs(actual_kwh - predicted_kwh)) AS model FROM scored)
SELECT round(base, 6) AS baseline_mae, round(model, 6) AS model_mae,
       round((1 - model / base) * 100, 6) AS improvement_pct FROM b"""
ORACLE["pred_monthly"] = f"""{SCORED}
SELECT "Year", "Month", round(sum(actual_kwh), 4) AS actual_kwh_sum,
       round(sum(predicted_kwh), 4) AS predicted_kwh_sum,
       round(avg(pct_error), 4) AS mean_pct_error, count(actual_kwh) AS n_days
FROM scored GROUP BY ALL"""
ORACLE["pred_sample"] = f"""{SCORED}
SELECT * FROM scored ORDER BY md5(strftime("Date", '%Y-%m-%d') || ':42'), "Date" LIMIT 10"""
ORACLE["pred_preview"] = f"""{FEATURES}, {POSITIONS.format(t="lagged")}
SELECT "Date", round(total_kwh, 3) AS actual, round(lag_7_kwh, 3) AS naive_pred,
       round(total_kwh - lag_7_kwh, 3) AS naive_err, round(roll_7_mean, 3) AS mean_pred,
       round(total_kwh - roll_7_mean, 3) AS mean_err
FROM p WHERE pos >= floor(n * CAST(0.8 AS DOUBLE)) ORDER BY "Date" LIMIT 10"""
ORACLE["worst_predictions"] = f"""{SCORED}
SELECT "Date", actual_kwh, predicted_kwh, abs_error, pct_error FROM scored
ORDER BY abs_error DESC NULLS LAST, "Date" LIMIT 5"""
MONITORED = f"""{SCORED},
rolling AS (
  SELECT *, CASE WHEN count(abs_error) OVER m >= 7 THEN avg(abs_error) OVER m END AS rolling_mae,
         CASE WHEN count(pct_error) OVER m >= 7 THEN avg(pct_error) OVER m END AS rolling_mape
  FROM scored WINDOW m AS (ORDER BY "Date" ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
monitored AS (
  SELECT *, coalesce(rolling_mae > 7.7, false) AS mae_alert,
         coalesce(rolling_mape > 66, false) AS mape_alert FROM rolling)"""
ORACLE["monitor_rolling"] = f"""{MONITORED}
SELECT "Date", round(rolling_mae, 6) AS rolling_mae, round(rolling_mape, 6) AS rolling_mape
FROM monitored"""
ORACLE["monitor_alerts"] = f"""{MONITORED}
SELECT count(*) FILTER (mae_alert) AS n_mae_alerts, count(*) FILTER (mape_alert) AS n_mape_alerts
FROM monitored"""
ORACLE["monitor_monthly"] = f"""{MONITORED},
m AS (SELECT "Year", "Month", round(avg(abs_error), 4) AS avg_mae,
             round(avg(pct_error), 4) AS avg_mape, count(*) FILTER (mae_alert) AS n_mae_alerts,
             count(*) FILTER (mape_alert) AS n_mape_alerts, count(abs_error) AS n_days
      FROM monitored GROUP BY ALL)
SELECT *, CASE WHEN n_mae_alerts > 5 OR n_mape_alerts > 5 THEN 'Alert' ELSE '' END AS flag FROM m"""
ORACLE["monitor_log"] = f"""{MONITORED}
SELECT "Date", round(rolling_mae, 6) AS rolling_mae, round(rolling_mape, 6) AS rolling_mape,
       mae_alert, mape_alert FROM monitored
WHERE rolling_mae IS NOT NULL AND rolling_mape IS NOT NULL"""

# ---- Drift ------------------------------------------------------------------------------

DRIFT = ["temp_mean_c", "hdd", "cdd", "lag_1_kwh", "roll_7_mean", "roll_30_mean", "is_weekend",
         "cal_month"]
SPLIT = f"""{FEATURES}, {POSITIONS.format(t="features")},
sides AS (SELECT *, CASE WHEN pos < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END
          AS side FROM p),
long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, side, CAST({c} AS DOUBLE) AS x FROM sides WHERE {c} IS NOT NULL"
    for c in DRIFT) + ")"
EDGES = " + ".join(f"CAST(x >= {i} * ((hi - lo) / 10) + lo AS INTEGER)" for i in range(1, 10))
PSI = """
span AS (
  SELECT feature, min(x) FILTER (side = 'train') AS mn, max(x) FILTER (side = 'train') AS mx,
         count(*) FILTER (side = 'train') AS n_train, count(*) FILTER (side = 'test') AS n_test
  FROM long GROUP BY feature),
ranges AS (
  SELECT feature, n_train, n_test, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
         CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
  FROM span WHERE n_train >= 10 AND n_test >= 10),
binned AS (
  SELECT feature, """ + EDGES + """ AS bin, side FROM long JOIN ranges USING (feature)
  WHERE x >= lo - 0.000001 AND x <= hi + 0.000001),
shares AS (
  SELECT r.feature, b.bin,
    (SELECT count(*) FROM binned d WHERE d.feature = r.feature AND d.bin = b.bin
      AND d.side = 'train') / r.n_train AS a,
    (SELECT count(*) FROM binned d WHERE d.feature = r.feature AND d.bin = b.bin
      AND d.side = 'test') / r.n_test AS c
  FROM ranges r CROSS JOIN range(10) b(bin)),
filled AS (SELECT feature, CASE WHEN a = 0 THEN 1e-6 ELSE a END AS p,
                  CASE WHEN c = 0 THEN 1e-6 ELSE c END AS q FROM shares),
psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM filled GROUP BY feature)"""
PSI_STATUS = """CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.25 THEN 'moderate'
  ELSE 'significant' END AS psi_status"""
ORACLE["drift_psi"] = f"{SPLIT}, {PSI} SELECT feature, round(psi, 6) AS psi, {PSI_STATUS} FROM psi"

SERIES = " + ".join(f"({2 * (-1) ** (k - 1)}) * exp(-2 * {k * k} * lam2)" for k in range(1, 61))
KS = f"""
per AS (SELECT feature, x, count(*) FILTER (side = 'train') AS a,
               count(*) FILTER (side = 'test') AS b FROM long GROUP BY ALL),
cum AS (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER f AS na,
               sum(b) OVER f AS nb FROM per
        WINDOW w AS (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING),
               f AS (PARTITION BY feature)),
stat AS (SELECT feature, CAST(max(na) AS BIGINT) AS n_train, CAST(max(nb) AS BIGINT) AS n_test,
                max(abs(ca / na - cb / nb)) AS d
         FROM cum WHERE na >= 10 AND nb >= 10 GROUP BY feature),
lam AS (SELECT *, d * d * n_train * n_test / (n_train + n_test) AS lam2 FROM stat),
pv AS (SELECT *, CASE WHEN lam2 < 0.04 THEN 1.0
                 ELSE least(1.0, greatest(0.0, {SERIES})) END AS pvalue FROM lam),
ks AS (SELECT feature, n_train, n_test, d AS ks_statistic, pvalue AS ks_pvalue,
              CASE WHEN pvalue < 0.05 THEN 'drift detected' ELSE 'no drift' END AS ks_result
       FROM pv)"""
KS_OUT = """SELECT feature, n_train, n_test, round(ks_statistic, 6) AS ks_statistic,
       round(ks_pvalue, 6) AS ks_pvalue, ks_result FROM ks"""
ORACLE["drift_ks"] = f"{SPLIT}, {KS} {KS_OUT}"
ORACLE["drift_ks_readings"] = "WITH long AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {c} AS x,
    CASE WHEN year(l_shipdate) < 2000 THEN 'train' ELSE 'test' END AS side FROM lineitem"""
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + f"), {KS} {KS_OUT}"
ORACLE["drift_report"] = f"""{SPLIT}, {PSI}, {KS}
SELECT '2024-02-01 00:00:00' AS run_at, 'v1.0' AS model_version,
       count(*) OVER () AS features_checked, feature, round(psi, 4) AS psi, {PSI_STATUS},
       round(ks_pvalue, 4) AS ks_pvalue, ks_result
FROM psi JOIN ks USING (feature)"""

# ---- Sketches ---------------------------------------------------------------------------


def hex_mod(digest, digits, modulus):
    """A hex digest modulo ``modulus`` in steps that fit a BIGINT."""
    total = "0"
    for start in range(1, digits + 1, 8):
        chunk = f"CAST('0x' || substr({digest}, {start}, 8) AS BIGINT)"
        total = f"(({total}) * 4294967296 + {chunk}) % {modulus}"
    return total


def positions(source, key, capacity, carry=""):
    """CTEs ``keys`` and ``pos``: every bit position of every distinct key."""
    bits = math.ceil(-capacity * math.log(0.01) / math.log(2) ** 2)
    hashes = round(bits / capacity * math.log(2))
    text = f"CAST({key} AS VARCHAR)"
    return f"""
keys AS ({source}),
digests AS (SELECT *, {hex_mod(f"sha256({text})", 64, bits)} AS h1,
                   {hex_mod(f"md5({text})", 32, bits)} AS h2 FROM keys),
pos AS (SELECT {key}{carry}, (h1 + i * h2) % {bits} AS bit
        FROM digests, range({hashes}) r(i))"""


WORDS = """
words AS (SELECT bit // 64 AS word, bit_or(CASE WHEN bit % 64 = 63
            THEN CAST(-9223372036854775808 AS BIGINT)
            ELSE CAST(1 AS BIGINT) << CAST(bit % 64 AS BIGINT) END) AS bits
          FROM pos GROUP BY ALL)"""
ORACLE["bloom_build"] = f"""WITH {positions("SELECT DISTINCT user_id FROM events", "user_id", 5000)},
{WORDS} SELECT word, bits FROM words"""
_probe = positions("SELECT DISTINCT c_custkey FROM customer", "c_custkey", 5000)
for _name in ("keys", "digests", "pos"):
    _probe = _probe.replace(f"{_name} AS (", f"probe_{_name} AS (")
_probe = _probe.replace("FROM keys", "FROM probe_keys").replace("FROM digests",
                                                                "FROM probe_digests")
ORACLE["bloom_probe"] = f"""WITH
{positions("SELECT DISTINCT o_custkey FROM orders", "o_custkey", 5000)}, {_probe},
bits AS (SELECT DISTINCT bit FROM pos)
SELECT c_custkey, bool_and(bits.bit IS NOT NULL) AS maybe_present
FROM probe_pos LEFT JOIN bits USING (bit) GROUP BY c_custkey"""


def first_seen(capacity, source="orders", key="o_custkey", order="o_orderkey"):
    keys = f"""SELECT {key}, count(*) AS n, min({order}) AS first_seen
              FROM {source} GROUP BY {key}"""
    return f"""WITH {positions(keys, key, capacity, ", n, first_seen")},
set_at AS (SELECT bit, min(first_seen) AS set_at FROM pos GROUP BY bit),
seen AS (SELECT {key}, any_value(n) AS n, any_value(first_seen) AS first_seen,
                bool_or(set_at >= first_seen) AS is_new
         FROM pos JOIN set_at USING (bit) GROUP BY {key})"""


ORACLE["bloom_first_seen"] = f"{first_seen(200)} SELECT * FROM seen"


def bloom_figures(counts, capacity=5000):
    bits = math.ceil(-capacity * math.log(0.01) / math.log(2) ** 2)
    kilobytes = math.ceil(bits / 8) / 1024
    return f"""SELECT processed, processed - unique_keys AS duplicates_caught, unique_keys,
       round((1 - exp(-7.0 * unique_keys / {bits})) ** 7, 6) AS est_fp_rate,
       CAST({round(kilobytes, 2)} AS DOUBLE) AS memory_kb,
       round(processed * 20.0 / 1024 / {kilobytes}, 1) AS memory_saving_factor,
       CAST({capacity} AS BIGINT) AS capacity, CAST(0.01 AS DOUBLE) AS target_fp_rate,
       CAST({round(kilobytes, 2)} AS DOUBLE) AS bit_array_kb, 7 AS hash_functions,
       unique_keys AS n_inserted FROM ({counts})"""


ORACLE["bloom_report"] = first_seen(5000) + bloom_figures(
    """SELECT (SELECT count(*) FROM orders) AS processed,
              count(*) FILTER (is_new) AS unique_keys FROM seen""")
SEEDS = [i * 2654435761 % 2 ** 32 for i in range(1, 8)]


def cells(item):
    rows = ", ".join(f"({i}, '{s:08x}')" for i, s in enumerate(SEEDS))
    return f"""
cells AS (
  SELECT item, n, r."row", CAST('0x' || substr(sha256(unhex(r.seed) || encode(item)), 1, 8)
                                AS BIGINT) % 2000 AS col
  FROM {item} CROSS JOIN (VALUES {rows}) r("row", seed)),
sketch AS (SELECT "row", col, CAST(sum(n) AS BIGINT) AS count FROM cells GROUP BY ALL)"""


ORACLE["cms_build"] = f"""WITH items AS (
  SELECT CAST(user_id AS VARCHAR) AS item, count(*) AS n FROM events GROUP BY ALL), {cells("items")}
SELECT "row", col, count FROM sketch"""
ORACLE["bucket_counts"] = f"SELECT {EVENT_BUCKET} AS bucket, count(*) AS n FROM events GROUP BY ALL"
CLASSES = ", ".join(f"('{c}')" for c in ["0-0.5kW", "0.5-1kW", "1-2kW", "2-3kW", "3-5kW", "5+kW",
                                         "unknown"])
CMS_TABLE = f"""WITH counted AS ({ORACLE["bucket_counts"]}),
items AS (SELECT c.bucket AS item, coalesce(n, 0) AS n
          FROM (VALUES {CLASSES}) c(bucket) LEFT JOIN counted USING (bucket)), {cells("items")},
compared AS (
  SELECT item AS bucket, min(count) AS cms_estimate, any_value(n) AS exact
  FROM cells JOIN sketch USING ("row", col) GROUP BY item)"""
ORACLE["cms_vs_exact"] = f"""{CMS_TABLE}
SELECT bucket, cms_estimate, exact, cms_estimate - exact AS error,
       round((cms_estimate - exact) * 100.0 / greatest(exact, 1), 2) AS error_pct FROM compared"""
ORACLE["cms_error_rate"] = f"""{CMS_TABLE}
SELECT CAST(sum(abs(cms_estimate - exact)) AS BIGINT) AS total_abs_error,
       round(sum(abs(cms_estimate - exact)) * 100.0 / greatest(sum(exact), 1), 4)
         AS error_rate_pct FROM compared"""

# ---- Streaming --------------------------------------------------------------------------

LIVE = """
live AS (SELECT date_trunc('second', ts) AS t, value AS kw, event_type, ts FROM events
         WHERE NOT (event_type = 'error' AND value < 5))"""
ORACLE["stream_source_parse"] = f"""WITH {LIVE}
SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS "key", t AS event_time, kw AS power,
       epoch_us(ts) // 1000 AS event_timestamp FROM live"""
TUMBLE = """SELECT time_bucket(INTERVAL '5 minutes', t) AS window_start, round(avg(kw), 6) AS avg_kw,
       round(max(kw), 6) AS peak_kw, round(sum(kw) / 60, 6) AS total_kwh, count(*) AS count"""
ORACLE["stream_tumbling"] = f"WITH {LIVE} {TUMBLE} FROM live GROUP BY ALL"


def slide(source):
    return f"""
halves AS (
  SELECT time_bucket(INTERVAL '5 minutes', t) - to_minutes(5 * k) AS window_start, kw
  FROM {source} CROSS JOIN range(2) r(k)),
slid AS (
  SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end,
         round(avg(kw), 4) AS sliding_avg_kw, round(max(kw), 4) AS sliding_peak_kw,
         count(*) AS count FROM halves GROUP BY window_start)"""


EVENTS = "ev AS (SELECT ts AS t, value AS kw FROM events)"
ORACLE["stream_sliding"] = f"WITH {LIVE}, {slide('live')} SELECT * FROM slid"
ORACLE["sliding_windows"] = f"""WITH {EVENTS}, {slide('ev')}
SELECT * FROM slid
WHERE window_start >= (SELECT time_bucket(INTERVAL '5 minutes', min(t)) FROM ev)"""
ORACLE["sliding_last10"] = f"""WITH {EVENTS}, {slide('ev')}
SELECT * FROM slid ORDER BY window_start DESC LIMIT 10"""
ORACLE["stream_submetering"] = f"""WITH {LIVE},
s AS (SELECT round(sum(CASE WHEN event_type = 'view' THEN kw ELSE 0 END) / 1000, 3) AS kitchen_kwh,
             round(sum(CASE WHEN event_type = 'click' THEN kw ELSE 0 END) / 1000, 3) AS laundry_kwh,
             round(sum(CASE WHEN event_type = 'purchase' THEN kw ELSE 0 END) / 1000, 3) AS hvac_kwh,
             round(sum(CASE WHEN event_type = 'signup' THEN kw ELSE 0 END) / 1000, 3) AS other_kwh,
             round(sum(kw) / 60, 3) AS total_kwh, count(*) AS records,
             round(avg(greatest(1706745600000 - epoch_us(ts) // 1000, 0)), 2)
               AS avg_latency_ms FROM live)
SELECT *, round(kitchen_kwh / greatest(total_kwh, 0.001) * 100, 1) AS kitchen_pct,
       round(laundry_kwh / greatest(total_kwh, 0.001) * 100, 1) AS laundry_pct,
       round(hvac_kwh / greatest(total_kwh, 0.001) * 100, 1) AS hvac_pct,
       round(other_kwh / greatest(total_kwh, 0.001) * 100, 1) AS other_pct FROM s"""
ORACLE["stream_bucket_counts"] = f"""WITH {LIVE}
SELECT {BUCKET.format(x="(kw / 25)")} AS bucket, count(*) AS n FROM live GROUP BY ALL"""
ORACLE["stream_sink_batches"] = f"""WITH {LIVE}, {slide('live')}
SELECT 'tumbling_windows' AS dataset,
       count(DISTINCT time_bucket(INTERVAL '5 minutes', t)) AS row_count FROM live
UNION ALL SELECT 'sliding_windows', count(*) FROM slid
UNION ALL SELECT 'submetering', 1"""
# Between groups the stream catches up, so a group's rows are late if their window ended before
# the latest time of all earlier groups, less ten minutes.
ORACLE["stream_watermark"] = f"""WITH arrived AS (
  SELECT ts AS t, value AS kw, least((day(ts) - 1) // 10, 2)
         + CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS batch FROM events),
marks AS (SELECT b.batch, (SELECT max(a.t) - INTERVAL '10 minutes' FROM arrived a
                           WHERE a.batch <= b.batch - 1) AS mark
          FROM (SELECT DISTINCT batch FROM arrived) b),
kept AS (SELECT a.* FROM arrived a JOIN marks m USING (batch)
         WHERE m.mark IS NULL
            OR time_bucket(INTERVAL '5 minutes', a.t) + INTERVAL '5 minutes' > m.mark)
{TUMBLE} FROM kept GROUP BY ALL"""
ORACLE["stream_dedup"] = "SELECT DISTINCT user_id FROM events"
ORACLE["stream_dedup_within"] = ORACLE["stream_dedup"]
# A key is new in the group of its first record unless keys of earlier groups had set its bits.
ORACLE["stream_dedup_sketch"] = first_seen(200, """(
    SELECT user_id, year(ts) * 36 + month(ts) * 3 + least((day(ts) - 1) // 10, 2) AS ten
    FROM events)""", "user_id", "ten") + bloom_figures("""
SELECT (SELECT count(*) FROM events) AS processed, count(*) FILTER (is_new) AS unique_keys
FROM seen""", 200)
SHARD = "('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 4"
ORACLE["stream_dedup_state"] = first_seen(50, """(
    SELECT user_id, year(ts) * 36 + month(ts) * 3 + least((day(ts) - 1) // 10, 2) AS ten
    FROM events)""", "user_id", "ten").replace(
        "SELECT bit, min", f"SELECT {SHARD} AS shard, bit, min").replace(
        "GROUP BY bit", "GROUP BY ALL").replace(
        "USING (bit)", f"ON pos.bit = set_at.bit AND shard = {SHARD}") + """
SELECT user_id FROM seen WHERE is_new"""
MONTHS = "CAST(year(o_orderdate) AS INTEGER) AS \"Year\", CAST(month(o_orderdate) AS INTEGER) AS \"Month\""
ORACLE["pruned_join"] = f"""
SELECT {MONTHS}, count(*) AS n FROM orders
WHERE month(o_orderdate) <= 3 AND year(o_orderdate) > 1996 GROUP BY ALL"""
ORACLE["reland_month"] = f"""
SELECT {MONTHS}, count(*) AS n FROM orders
WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) = 3 AND o_orderkey % 2 = 1) GROUP BY ALL"""
ORACLE["filtered_join"] = """
SELECT o_orderkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1995 AND month(o_orderdate) = 3
GROUP BY o_orderkey"""
ORACLE["cms_native"] = """
SELECT count(DISTINCT user_id) AS items, count(user_id) AS updates, CAST(0 AS BIGINT) AS below,
       true AS within_bound FROM events"""
ORACLE["stream_cms"] = ORACLE["cms_build"]
ORACLE["json_report"] = ORACLE["bloom_report"]
ORACLE["session_report"] = """
SELECT count(*) AS total_received, CAST(3 AS BIGINT) AS total_triggers, true AS timed, true AS rated
FROM events"""
ORACLE["latency_avg"] = """
SELECT count(*) AS stream_records,
       round(avg(greatest(1706745600000 - epoch_us(ts) // 1000, 0)), 2) AS stream_latency_ms FROM events"""
ORACLE["session_summary"] = """
SELECT count(*) AS total_received,
       round(avg(greatest(1706745600000 - epoch_us(ts) // 1000, 0)), 2) AS avg_latency_ms,
       round(sum(value) / 60, 4) AS total_kwh, count(DISTINCT CAST(ts AS DATE)) AS unique_days
FROM events"""
