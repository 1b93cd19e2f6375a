"""Schemas, column lists and fixed values of the sensor data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------------------
# Raw long-format schema: one row per (datetime, station, pollutant); weather repeated on every row.
# year/month/day/hour are supplied by the source, not computed.
# ---------------------------------------------------------------------------------------------------------
RAW_FIELDS = [
    ("station_id", T.StringType()),
    ("state", T.StringType()),
    ("city", T.StringType()),
    ("station_name", T.StringType()),
    ("timestamp", T.StringType()),
    ("datetime", T.TimestampNTZType()),
    ("at_c", T.DoubleType()),
    ("rh_percent", T.DoubleType()),
    ("ws_m_s", T.DoubleType()),
    ("wd_deg", T.DoubleType()),
    ("rf_mm", T.DoubleType()),
    ("tot_rf_mm", T.DoubleType()),
    ("sr_w_mt2", T.DoubleType()),
    ("bp_mmhg", T.DoubleType()),
    ("vws_m_s", T.DoubleType()),
    ("pollutant", T.StringType()),
    ("value", T.DoubleType()),
    ("station", T.StringType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("hour", T.IntegerType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]
DOUBLE_COLUMNS = [n for n, t in RAW_FIELDS if isinstance(t, T.DoubleType)]

# Columns removed by cleaning: the all-null vertical wind speed, the text copy of datetime and the
# name copy of station_id.
DROPPED_BY_CLEANING = ["vws_m_s", "timestamp", "station"]
CLEAN_COLUMNS = [c for c in RAW_COLUMNS if c not in DROPPED_BY_CLEANING]

# Weather columns imputed with the station-month median, in the order cleaning visits them.
WEATHER_COLUMNS = ["at_c", "rh_percent", "ws_m_s", "wd_deg", "rf_mm", "tot_rf_mm", "sr_w_mt2", "bp_mmhg"]

# Keys of the imputation groups: station and calendar month (years pooled).
IMPUTE_KEYS = ["station_id", "month"]

# ---------------------------------------------------------------------------------------------------------
# Star schema
# ---------------------------------------------------------------------------------------------------------
STATIONS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
])
POLLUTANTS_SCHEMA = T.StructType([
    T.StructField("pollutant_id", T.IntegerType(), False),
    T.StructField("pollutant_name", T.StringType(), True),
])
# Measurement columns after the surrogate id, in table order.
FACT_VALUE_COLUMNS = ["datetime", "station_id", "pollutant_id", "value", "year", "month", "day", "hour",
                      "at_c", "rh_percent", "bp_mmhg", "ws_m_s", "wd_deg", "rf_mm", "sr_w_mt2"]
RAW_FACT_COLUMNS = ["measurement_id"] + FACT_VALUE_COLUMNS + ["vws_m_s"]
CLEAN_FACT_COLUMNS = ["measurement_id"] + FACT_VALUE_COLUMNS
MEASUREMENTS_SCHEMA = T.StructType(
    [T.StructField("measurement_id", T.LongType(), True),
     T.StructField("datetime", T.TimestampNTZType(), True),
     T.StructField("station_id", T.StringType(), True),
     T.StructField("pollutant_id", T.IntegerType(), True),
     T.StructField("value", T.DoubleType(), True)]
    + [T.StructField(c, T.IntegerType(), True) for c in ("year", "month", "day", "hour")]
    + [T.StructField(c, T.DoubleType(), True)
       for c in ("at_c", "rh_percent", "bp_mmhg", "ws_m_s", "wd_deg", "rf_mm", "sr_w_mt2", "vws_m_s")]
)

RAW_TABLES = ["stations", "pollutants", "measurements"]
SERVING_TABLES = ["stations", "pollutants", "measurements_clean", "monthly_aggregates", "daily_peaks"]

# ---------------------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------------------------------------

# PM2.5 level ladder of the map-reduce classification: upper bounds (inclusive) and code names; anything
# above the last bound, and a missing value, is "hazardous".
LEVEL_BOUNDS = [5.0, 35.0, 55.0, 150.0]
LEVEL_NAMES = ["safe", "moderate", "unhealthy", "very_unhealthy", "hazardous"]

# PM2.5 AQI category of the ETL: right-closed bins (0,5] (5,35] (35,55] (55,150] (150,inf];
# 0, negatives and missing values get no category.
AQI_EDGES = [0.0, 5.0, 35.0, 55.0, 150.0, float("inf")]
AQI_LABELS = ["Safe", "Moderate", "Unhealthy", "Very Unhealthy", "Hazardous"]

# Six-level display scale of the dashboard: upper bound (inclusive), label, colour, emoji, advice.
DISPLAY_LEVELS = [
    (5.0, "Safe", "#1abc9c", "😊", "Perfect — breathe easy!"),
    (35.0, "Moderate", "#3498db", "🙂", "Generally okay for most."),
    (55.0, "Unhealthy (sensitive)", "#f39c12", "😐", "Sensitive groups take care."),
    (150.0, "Unhealthy", "#e67e22", "😷", "Limit time outdoors."),
    (250.0, "Very Unhealthy", "#e74c3c", "😨", "Stay inside if you can."),
    (None, "Hazardous", "#8e44ad", "🚨", "Avoid going out!"),
]

# WHO annual PM2.5 guideline (µg/m³) used for the "multiple of the limit" figure.
WHO_PM25_LIMIT = 5.0

# Weekday names, Monday first (dow 0 = Monday).
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Dashboard display prefix swap: station codes are shown as "Station NNN".
STATION_CODE_PREFIX = "site_"
STATION_DISPLAY_PREFIX = "Station "

# Forecast horizon of the dashboard (hours ahead).
FORECAST_HORIZON = 24
