"""Test fixture: project the driver's ``events`` table into the 22-column raw sensor schema.

The driver's tables hold no sensor data, so events are mapped onto stations (user_id % 10), pollutants
(event_type), a 24-month calendar (ts shifted by event_id % 701 days) and weather readings, with planted
defects: NULL / zero / negative values, exact duplicate rows (event_id % 89 = 0 is emitted twice) and
station-months whose weather is entirely missing. The same SQL text runs on Spark and DuckDB; only two
dialect tokens differ. Every event is used — the modulo expressions plant defects, they do not sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.schema import RAW_COLUMNS

# Fixed fixture mapping (shared with the DuckDB oracle). {STR} and {SHIFT} are dialect tokens.
FIXTURE_CTES = """
e AS (SELECT event_id, user_id, event_type, value AS v, ts + {SHIFT} AS dt FROM events),
f AS (SELECT *, CAST(extract(month FROM dt) AS INT) AS m, user_id % 10 AS u FROM e),
g AS (SELECT 'site_' || CAST(100 + u AS {STR}) AS station_id, 'Delhi' AS state, 'Delhi' AS city,
  'Name ' || CAST(100 + u AS {STR}) AS station_name, CAST(dt AS {STR}) AS timestamp, dt AS datetime,
  CASE WHEN event_id % 3 = 0 OR (u = 3 AND m = 1) THEN NULL ELSE CAST(10 + event_id % 31 AS DOUBLE) END AS at_c,
  CASE WHEN event_id % 5 = 0 OR (u = 3 AND m = 2) THEN NULL ELSE CAST(60 + event_id % 31 AS DOUBLE) END AS rh_percent,
  CASE WHEN event_id % 2 = 0 OR (u = 3 AND m = 3) THEN NULL ELSE CAST(event_id % 31 AS DOUBLE) END AS ws_m_s,
  CASE WHEN event_id % 4 = 0 OR (u = 3 AND m = 4) THEN NULL ELSE CAST(90 + event_id % 31 AS DOUBLE) END AS wd_deg,
  CASE WHEN event_id % 7 = 0 OR (u = 3 AND m = 5) THEN NULL ELSE CAST(event_id % 31 AS DOUBLE) END AS rf_mm,
  CAST(event_id % 2 AS DOUBLE) AS tot_rf_mm,
  CASE WHEN event_id % 6 = 0 OR (u = 3 AND m = 6) THEN NULL ELSE CAST(200 + event_id % 31 AS DOUBLE) END AS sr_w_mt2,
  CASE WHEN event_id % 8 = 0 OR (u = 3 AND m = 7) THEN NULL ELSE CAST(740 + event_id % 31 AS DOUBLE) END AS bp_mmhg,
  CAST(NULL AS DOUBLE) AS vws_m_s,
  CASE event_type WHEN 'click' THEN 'pm25' WHEN 'error' THEN 'pm10' WHEN 'purchase' THEN 'no2'
                  WHEN 'signup' THEN 'so2' WHEN 'view' THEN 'ozone' END AS pollutant,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 61 = 0 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 97 = 0 THEN -v ELSE v END AS value,
  'Name ' || CAST(100 + u AS {STR}) AS station,
  CAST(extract(year FROM dt) AS INT) AS year, m AS month,
  CAST(extract(day FROM dt) AS INT) AS day, CAST(extract(hour FROM dt) AS INT) AS hour, event_id
  FROM f),
raw AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE event_id % 89 = 0)
"""

SPARK_TOKENS = {"STR": "STRING", "SHIFT": "make_dt_interval(CAST(event_id % 701 AS INT))"}
DUCKDB_TOKENS = {"STR": "VARCHAR", "SHIFT": "to_days(CAST(event_id % 701 AS INTEGER))"}


def fixture_ctes(dialect: str) -> str:
    tokens = SPARK_TOKENS if dialect == "spark" else DUCKDB_TOKENS
    return FIXTURE_CTES.replace("{STR}", tokens["STR"]).replace("{SHIFT}", tokens["SHIFT"])


def raw_from_events(spark: SparkSession, events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """The 22-column raw frame (plus ``event_id`` when asked) derived from an ``events`` DataFrame."""
    cols = RAW_COLUMNS + (["event_id"] if keep_event_id else [])
    sql = "WITH " + fixture_ctes("spark").replace("FROM events", "FROM {events}") + \
          " SELECT " + ", ".join(cols) + " FROM raw"
    return spark.sql(sql, events=events)


def load_fixture_raw(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """Read ``<sf_dir>/events.parquet`` and map it to the raw sensor schema."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return raw_from_events(spark, events, keep_event_id)
