"""Column names, schemas, formats, thresholds and labels."""

from pyspark.sql import types as T

# ---- Raw readings (delimited text) ------------------------------------------------------
MEASURES = [
    "Global_active_power",
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
]
POWER = "Global_active_power"
REMAINDER = "Sub_metering_remainder"
SUBMETERS = ["Sub_metering_1", "Sub_metering_2", "Sub_metering_3", REMAINDER]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["Date", "Time", *MEASURES]])
READING_TIME_FORMAT = "d/M/yyyy HH:mm:ss"
READING_DATE_FORMAT = "d/M/yyyy"
FIELD_SEPARATOR = ";"
MISSING_TOKEN = "?"

# ---- Raw weather ------------------------------------------------------------------------
WEATHER_DATE_FORMAT = "yyyy-MM-dd"
WEATHER_NAMES = {
    "temperature_2m_mean": "temp_mean_c",
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "precipitation_sum": "precip_mm",
}
WEATHER_COLUMNS = list(WEATHER_NAMES.values())

# ---- Daily tables -----------------------------------------------------------------------
APPLIANCES = ["kitchen", "laundry", "hvac", "other"]
APPLIANCE_KWH = [f"{a}_kwh" for a in APPLIANCES]
APPLIANCE_PCT = [f"{a}_pct" for a in APPLIANCES]
APPLIANCE_RATIO = [f"{a}_ratio" for a in APPLIANCES]
TARGET = "total_kwh"

# ---- Stream messages --------------------------------------------------------------------
MESSAGE_FIELDS = ["Datetime", *MEASURES, REMAINDER, "Year", "Month", "event_timestamp"]
TUMBLING = "5 minutes"
SLIDING = "10 minutes"
SLIDE = "5 minutes"
WATERMARK = "10 minutes"
TRIGGER = "10 seconds"

# ---- Consumption classes: upper bounds in kW, exclusive -----------------------------------
POWER_CLASSES = [
    (0.5, "0-0.5kW"),
    (1.0, "0.5-1kW"),
    (2.0, "1-2kW"),
    (3.0, "2-3kW"),
    (5.0, "3-5kW"),
]
TOP_CLASS = "5+kW"
UNKNOWN_CLASS = "unknown"

# ---- Sketches ---------------------------------------------------------------------------
BLOOM_CAPACITY = 5000
BLOOM_FPP = 0.01
CMS_WIDTH = 2000
CMS_DEPTH = 7
CMS_SEED_STEP = 2654435761
NATIVE_CMS = dict(eps=0.001, confidence=0.9921875, seed=42)  # width 2000, depth 7
BYTES_PER_KEY = 20

# ---- Features ---------------------------------------------------------------------------
SEASON_OF_MONTH = {1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2, 9: 3, 10: 3, 11: 3, 12: 0}
LAG_ROWS = [1, 2, 7, 14, 30]
HEATING_BASE_C = 18.0
COOLING_BASE_C = 22.0
COMFORT_C = (16, 22)
RAIN_MM = 0.1
FEATURE_GROUPS = {
    "Temporal": ["day_of_week", "day_of_year", "week_of_year", "cal_month", "cal_year",
                 "is_weekend", "season", "dow_sin", "dow_cos", "month_sin", "month_cos",
                 "doy_sin", "doy_cos"],
    "Weather": ["temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "temp_range", "hdd",
                "cdd", "in_comfort_zone", "has_rain"],
    "Lag": ["lag_1_kwh", "lag_2_kwh", "lag_7_kwh", "lag_14_kwh", "lag_30_kwh", "lag_1_temp"],
    "Rolling": ["roll_7_mean", "roll_7_std", "roll_7_max", "roll_30_mean", "roll_30_std",
                "wow_change"],
    "Sub-metering": ["kitchen_ratio", "laundry_ratio", "hvac_ratio", "other_ratio",
                     "lag_1_hvac_ratio"],
    "Interaction": ["hdd_x_weekend", "hdd_x_season", "temp_x_weekend"],
}
REQUIRED_FEATURES = ["total_kwh", "lag_7_kwh", "roll_7_mean"]

# ---- Models -----------------------------------------------------------------------------
NON_FEATURES = ["Date", "total_kwh", "avg_kw", "peak_kw", "minutes_recorded", "cal_year",
                "kitchen_kwh", "laundry_kwh", "hvac_kwh", "other_kwh", "Year", "Month"]
TRAIN_RATIO = 0.80
SEED = 42
FOREST = dict(numTrees=200, maxDepth=12, minInstancesPerNode=5, featureSubsetStrategy="sqrt")
FOREST_CV = dict(numTrees=100, maxDepth=10, minInstancesPerNode=1, featureSubsetStrategy="all")
BOOSTED = dict(maxIter=300, stepSize=0.05, maxDepth=5, minInstancesPerNode=10, l2=0.1)
BOOSTED_CV = dict(maxIter=100, stepSize=0.05, maxDepth=5, minInstancesPerNode=20)
VALIDATION_FRACTION = 0.1
CV_SPLITS = 5
MAPE_FLOOR = 0.1
INTERVAL_Z = 1.96
INTERVAL_MAE = 1.5
DEFAULT_MAE = 2.0
MODEL_VERSION = "v1.0"

# ---- Monitoring and drift ---------------------------------------------------------------
MONITOR_ROWS = 30
MONITOR_MIN_ROWS = 7
MAE_ALERT = 5.0
MAPE_ALERT = 15.0
ALERTS_PER_MONTH = 5
PSI_BINS = 10
PSI_EDGE = 1e-6
PSI_EMPTY = 1e-6
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
KS_ALPHA = 0.05
DRIFT_MIN_ROWS = 10
DRIFT_FEATURES = ["temp_mean_c", "hdd", "cdd", "lag_1_kwh", "roll_7_mean", "roll_30_mean",
                  "is_weekend", "cal_month"]
