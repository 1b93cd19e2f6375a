"""Independent DuckDB SQL for every registered query, over the driver's ``events`` view.

Each statement starts from the shared fixture CTEs (events -> 22-column raw rows) and re-derives the result
with plain SQL: DISTINCT + median + LEFT JOIN for cleaning, ``row_number()`` windows for surrogate ids,
self-joins for the look-back and the seasonal forecast. Nothing here calls the Spark code.
"""

from __future__ import annotations

from aerolake.schema import CLEAN_COLUMNS, DISPLAY_LEVELS, FACT_VALUE_COLUMNS, RAW_COLUMNS, WEATHER_COLUMNS
from aerolake.sources.fixture import fixture_ctes


_GRID = f"{2.0**80!r}"  # readings, hourly means and their differences are whole multiples of 2^-80


def ESUM(c: str) -> str:
    """The double nearest to the true sum: whole numbers on a binary grid, rounded once (through their digits)."""
    return f"CAST(CAST(SUM(CAST(({c}) * {_GRID} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {_GRID}"


def EA(c: str) -> str:
    """Exact average: the nearest double to the true sum, divided by the count."""
    return f"{ESUM(c)} / COUNT({c})"


def R2E(x: str) -> str:
    """numpy-style 2-decimal rounding."""
    return f"round_even({x}, 2)"


def R2A(x: str) -> str:
    """SQL ROUND(x, 2), half away from zero on the scaled value."""
    return (f"CASE WHEN ({x}) >= 0 THEN CAST(FLOOR(({x}) * 100 + 0.5) AS DOUBLE) / 100 "
            f"ELSE -CAST(FLOOR(-({x}) * 100 + 0.5) AS DOUBLE) / 100 END")


def PCT(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100"


_COLS = ", ".join(RAW_COLUMNS)

LEVEL_CASE = ("CASE WHEN value <= 5 THEN 'safe' WHEN value <= 35 THEN 'moderate' WHEN value <= 55 THEN 'unhealthy' "
              "WHEN value <= 150 THEN 'very_unhealthy' ELSE 'hazardous' END")
AQI_CASE = ("CASE WHEN value > 0 AND value <= 5 THEN 'Safe' WHEN value > 5 AND value <= 35 THEN 'Moderate' "
            "WHEN value > 35 AND value <= 55 THEN 'Unhealthy' WHEN value > 55 AND value <= 150 THEN 'Very Unhealthy' "
            "WHEN value > 150 THEN 'Hazardous' END")


def _display_case(x: str, field: int) -> str:
    parts = []
    for row in DISPLAY_LEVELS:
        v = row[field].replace("'", "''")
        if row[0] is None:
            return "CASE " + " ".join(parts) + f" ELSE '{v}' END"
        parts.append(f"WHEN {x} <= {row[0]} THEN '{v}'")
    raise AssertionError


def _clean_ctes() -> str:
    body = ", ".join(CLEAN_COLUMNS)
    meds = ", ".join(f"median({c}) AS m_{c}" for c in WEATHER_COLUMNS)
    sel = ", ".join(f"coalesce(c0.{c}, med.m_{c}) AS {c}" if c in WEATHER_COLUMNS else f"c0.{c}"
                    for c in CLEAN_COLUMNS)
    return f""",
r AS (SELECT {_COLS} FROM raw),
c0 AS (SELECT DISTINCT {body} FROM r WHERE NOT coalesce(value < 0, false)),
med AS (SELECT station_id, month, {meds} FROM c0 GROUP BY station_id, month),
clean AS (SELECT {sel} FROM c0 LEFT JOIN med ON c0.station_id = med.station_id AND c0.month = med.month)"""


def _star_ctes() -> str:
    return """,
pol AS (SELECT CAST(row_number() OVER (ORDER BY pollutant NULLS LAST) AS INTEGER) AS pollutant_id,
               pollutant AS pollutant_name FROM (SELECT DISTINCT pollutant FROM r)),
st AS (SELECT DISTINCT station_id, city, state FROM r),
m AS (SELECT r.*, pol.pollutant_id FROM r JOIN pol ON r.pollutant = pol.pollutant_name),
polc AS (SELECT CAST(row_number() OVER (ORDER BY pollutant NULLS LAST) AS BIGINT) AS pollutant_id,
                pollutant AS pollutant_name FROM (SELECT DISTINCT pollutant FROM clean)),
stc AS (SELECT DISTINCT station_id, city, state FROM clean),
mc AS (SELECT clean.*, polc.pollutant_id FROM clean JOIN polc ON clean.pollutant = polc.pollutant_name)"""


def _insight_ctes() -> str:
    return f""",
sh AS (SELECT station_id, hour, {EA('value')} AS pm25 FROM clean
       WHERE pollutant = 'pm25' AND station_id IS NOT NULL AND hour IS NOT NULL GROUP BY station_id, hour),
hs AS (SELECT station_id, date_trunc('hour', datetime) AS hour_ts, {EA('value')} AS pm25 FROM clean
       WHERE pollutant = 'pm25' AND station_id IS NOT NULL AND datetime IS NOT NULL GROUP BY 1, 2)"""


def with_all(final: str) -> str:
    return "WITH " + fixture_ctes("duckdb") + _clean_ctes() + _star_ctes() + _insight_ctes() + "\n" + final


def _fact_order(cols: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


def _missing_union(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS missing_count, count(*) AS n FROM {table}"
        for c in cols)


def _quality_cte(name: str, table: str, cols: list[str]) -> str:
    miss = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    return (f"{name} AS (SELECT CAST(count(*) AS DOUBLE) AS rows_, CAST({len(cols)} AS DOUBLE) AS cols_, "
            f"CAST({miss} AS DOUBLE) AS miss_, "
            f"100.0 - CAST({miss} AS DOUBLE) / NULLIF(CAST(count(*) * {len(cols)} AS DOUBLE), 0) * 100.0 AS q_ "
            f"FROM {table})")


LOOKBACK = 4
MAX_GAP = 24  # hours that a reading is carried over
ONE_PARTITION = (2024, 3)
STATION_RANK_HOUR = 8


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    fv_raw = FACT_VALUE_COLUMNS + ["vws_m_s"]
    fv_clean = FACT_VALUE_COLUMNS

    q["monthly_pm25_direct"] = f"SELECT year, month, {EA('value')} AS avg_pm25 FROM r WHERE pollutant = 'pm25' GROUP BY year, month"
    q["monthly_pm25_star"] = f"SELECT year, month, {EA('value')} AS avg_pm25 FROM m WHERE pollutant_id = (SELECT pollutant_id FROM pol WHERE pollutant_name = 'pm25') GROUP BY year, month"
    q["top3_pm10"] = (f"SELECT s.station_id, s.city, {EA('m.value')} AS avg_pm10 FROM m JOIN st s ON m.station_id = s.station_id "
                      "WHERE m.pollutant = 'pm10' GROUP BY s.station_id, s.city "
                      "ORDER BY avg_pm10 DESC NULLS LAST, s.station_id, s.city LIMIT 3")
    q["count_per_pollutant"] = "SELECT pollutant AS pollutant_name, count(*) AS n FROM m GROUP BY pollutant"
    q["daily_peak_no2"] = ("SELECT year, month, day, max(value) AS peak_no2 FROM m WHERE pollutant = 'no2' "
                           "AND station_id = (SELECT min(station_id) FROM st) GROUP BY year, month, day")
    q["clean"] = "SELECT * FROM clean"
    aud = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT count(*) FROM c0 WHERE {c} IS NULL) AS b, "
        f"(SELECT count(*) FROM clean WHERE {c} IS NULL) AS a" for c in WEATHER_COLUMNS)
    q["clean_imputation_audit"] = (
        f"SELECT column_name, CAST(b AS BIGINT) AS missing_before, CAST(a AS BIGINT) AS missing_after, "
        f"CAST(b - a AS BIGINT) AS filled FROM ({aud}) "
        f"UNION ALL SELECT 'total', CAST(sum(b) AS BIGINT), CAST(sum(a) AS BIGINT), CAST(sum(b - a) AS BIGINT) FROM ({aud})")
    q["batch_stats"] = (f"SELECT pollutant, {R2E(EA('value'))} AS avg_value, {R2E('max(value)')} AS max_value, "
                        f"{R2E('min(value)')} AS min_value, count(value) AS reading_count, "
                        f"{R2E('stddev_samp(value)')} AS std_value, year, month FROM clean "
                        "WHERE year IS NOT NULL AND month IS NOT NULL AND pollutant IS NOT NULL GROUP BY year, month, pollutant")
    q["streaming_batch_stats"] = q["monthly_reload"] = q["streamed_months"] = q["batch_stats"]
    q["level_counts"] = (f"SELECT station_id AS station, {LEVEL_CASE} AS pollution_level, count(*) AS \"count\" "
                         "FROM clean WHERE pollutant = 'pm25' GROUP BY 1, 2")
    q["monthly_avg"] = (f"SELECT year, month, pollutant, {R2E(EA('value'))} AS value FROM clean "
                        "WHERE year IS NOT NULL AND month IS NOT NULL AND pollutant IS NOT NULL GROUP BY year, month, pollutant")
    q["pm25_aqi"] = f"SELECT datetime, station_id, value, {AQI_CASE} AS aqi_category FROM clean WHERE pollutant = 'pm25'"
    q["daily_peaks"] = ("SELECT year, month, day, station_id, pollutant, max(value) AS value FROM clean "
                        "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND station_id IS NOT NULL "
                        "AND pollutant IS NOT NULL GROUP BY year, month, day, station_id, pollutant")
    q["dim_stations"] = "SELECT station_id, city, state FROM st"
    q["dim_pollutants"] = "SELECT pollutant_id, pollutant_name FROM pol"
    q["fact_raw"] = (f"SELECT CAST(row_number() OVER (ORDER BY {_fact_order(fv_raw)}) AS BIGINT) AS measurement_id, "
                     f"{', '.join(fv_raw)} FROM m")
    q["fact_clean"] = (f"SELECT CAST(row_number() OVER (ORDER BY {_fact_order(fv_clean)}) AS BIGINT) AS measurement_id, "
                       f"{', '.join(fv_clean)} FROM mc")
    q["served_monthly_pm25"] = (f"SELECT year, month, {R2A(EA('value'))} AS avg_pm25 FROM mc "
                                "WHERE pollutant_id = (SELECT pollutant_id FROM polc WHERE pollutant_name = 'pm25') GROUP BY year, month")
    q["served_top3_pm25"] = (f"SELECT s.station_id, {R2A(EA('m.value'))} AS avg_pm25 FROM mc m JOIN stc s ON m.station_id = s.station_id "
                             "WHERE m.pollutant = 'pm25' GROUP BY s.station_id ORDER BY avg_pm25 DESC NULLS LAST, s.station_id LIMIT 3")
    q["served_preagg_slice"] = (f"SELECT * FROM (SELECT year, month, pollutant, {R2E(EA('value'))} AS value FROM clean "
                                "WHERE year IS NOT NULL AND month IS NOT NULL AND pollutant IS NOT NULL GROUP BY year, month, pollutant) "
                                "WHERE pollutant = 'pm25' ORDER BY year, month LIMIT 6")
    q["monthly_pm25_clean"] = (f"SELECT year, month, {R2E(EA('value'))} AS avg_pm25 FROM clean "
                               "WHERE pollutant = 'pm25' AND year IS NOT NULL AND month IS NOT NULL GROUP BY year, month")
    q["summary_counts"] = ("SELECT count(*) AS total_records, CAST(22 AS INTEGER) AS n_columns, "
                           "CAST(count(*) * 22 AS BIGINT) AS total_cells, min(datetime) AS date_min, "
                           "max(datetime) AS date_max, "
                           "'[' || array_to_string(list_sort(list(DISTINCT year) FILTER (WHERE year IS NOT NULL)), ', ') || ']' AS years, "
                           "count(DISTINCT station_id) AS stations, count(DISTINCT pollutant) AS pollutant_species FROM r")
    q["rows_per_year"] = "SELECT year, count(*) AS n_records FROM r WHERE year IS NOT NULL GROUP BY year"
    q["rows_per_month"] = ("SELECT year, month, count(*) AS n_records FROM r WHERE year IS NOT NULL AND month IS NOT NULL "
                           "GROUP BY year, month")
    q["rows_per_pollutant"] = "SELECT pollutant, count(*) AS n_records FROM r WHERE pollutant IS NOT NULL GROUP BY pollutant"
    q["missing_profile"] = (f"SELECT column_name, CAST(missing_count AS BIGINT) AS missing_count, "
                            f"{R2E(PCT('missing_count', 'n'))} AS missing_pct FROM ({_missing_union('r', RAW_COLUMNS)}) "
                            "WHERE missing_count > 0")
    miss22 = " + ".join(f"count_if({c} IS NULL)" for c in RAW_COLUMNS)
    q["completeness"] = (f"SELECT CAST({miss22} AS BIGINT) AS total_missing, CAST(count(*) * 22 AS BIGINT) AS total_cells, "
                         f"100.0 - CAST({miss22} AS DOUBLE) / NULLIF(CAST(count(*) * 22 AS BIGINT), 0) * 100.0 AS quality_pct FROM r")
    q["quality_before_after"] = (
        f"SELECT metric, before_value, after_value, after_value - before_value AS delta FROM ("
        f"WITH {_quality_cte('qb', 'r', RAW_COLUMNS)}, {_quality_cte('qa', 'clean', CLEAN_COLUMNS)} "
        "SELECT 'rows' AS metric, qb.rows_ AS before_value, qa.rows_ AS after_value FROM qb, qa UNION ALL "
        "SELECT 'columns', qb.cols_, qa.cols_ FROM qb, qa UNION ALL "
        "SELECT 'missing_cells', qb.miss_, qa.miss_ FROM qb, qa UNION ALL "
        "SELECT 'quality_pct', qb.q_, qa.q_ FROM qb, qa)")
    q["value_describe"] = (
        "SELECT stat, round_even(v, 2) AS value FROM ("
        "SELECT 'count' AS stat, CAST(count(value) AS DOUBLE) AS v FROM r UNION ALL "
        f"SELECT 'mean', {EA('value')} FROM r UNION ALL "
        f"SELECT 'std', sqrt({ESUM('(value - m_) * (value - m_)')} / NULLIF(count(value) - 1, 0)) "
        f"FROM (SELECT value, (SELECT {EA('value')} FROM r) AS m_ FROM r) UNION ALL "
        "SELECT 'min', min(value) FROM r UNION ALL "
        "SELECT '25%', quantile_cont(value, 0.25) FROM r UNION ALL "
        "SELECT '50%', quantile_cont(value, 0.5) FROM r UNION ALL "
        "SELECT '75%', quantile_cont(value, 0.75) FROM r UNION ALL "
        "SELECT 'max', max(value) FROM r)")
    q["negative_audit"] = (
        f"SELECT 'all' AS scope, CAST(NULL AS VARCHAR) AS pollutant, CAST(count_if(value < 0) AS BIGINT) AS n_negative, "
        f"{R2E(PCT('count_if(value < 0)', 'count(*)'))} AS pct_of_rows FROM r UNION ALL "
        f"SELECT 'pollutant', pollutant, count(*), {R2E(PCT('count(*)', '(SELECT count(*) FROM r)'))} "
        "FROM r WHERE value < 0 GROUP BY pollutant")
    q["duplicate_audit"] = (f"SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_rows, "
                            f"CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT {_COLS}, count(*) AS n FROM r GROUP BY {_COLS})")
    q["duplicate_rows"] = (f"SELECT {_COLS} FROM (SELECT *, count(*) OVER (PARTITION BY {_COLS}) AS c_ FROM r) WHERE c_ > 1")
    sample_cols = ["datetime", "station_id", "pollutant", "value", "at_c", "ws_m_s", "rh_percent"]
    q["dirty_sample"] = (f"SELECT {', '.join(sample_cols)} FROM r WHERE at_c IS NULL OR ws_m_s IS NULL "
                         f"ORDER BY {_fact_order(sample_cols)} LIMIT 10")
    q["distinct_values"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(v AS VARCHAR) AS value, CAST(dense_rank() OVER (ORDER BY v) AS INTEGER) AS position "
        f"FROM (SELECT DISTINCT {c} AS v FROM r WHERE {c} IS NOT NULL)"
        for c in ["year", "month", "state", "city", "station_id", "pollutant"])
    per = (f"SELECT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period, {EA('value')} AS avg_pm25 "
           "FROM r WHERE pollutant = 'pm25' AND year IS NOT NULL AND month IS NOT NULL GROUP BY year, month")
    q["distinct_counts"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(v AS VARCHAR) AS value, CAST(dense_rank() OVER (ORDER BY v) AS INTEGER) AS position, n AS n_rows "
        f"FROM (SELECT {c} AS v, count(*) AS n FROM r WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in ["year", "month", "state", "city", "station_id", "pollutant"])
    q["ordered_level_counts"] = (
        'SELECT CAST(row_number() OVER (ORDER BY station, "count" DESC, pollution_level) AS INTEGER) AS place, station, pollution_level, "count" '
        f"FROM ({q['level_counts']})")
    q["loaded_raw_star"], q["loaded_serving_star"] = q["fact_raw"], q["fact_clean"]
    q["loaded_monthly_aggregates"], q["written_clean"], q["clean_by_fingerprint"] = q["monthly_avg"], q["clean"], q["clean"]
    q["loaded_table_counts"] = ("SELECT 'measurements' AS table_name, count(*) AS n_rows FROM m UNION ALL "
                                "SELECT 'pollutants', count(*) FROM pol UNION ALL SELECT 'stations', count(*) FROM st")
    # A timestamp prints its fraction without trailing zeros.
    shown = "CASE WHEN strftime({0}, '%f') = '000000' THEN strftime({0}, '%Y-%m-%d %H:%M:%S') ELSE strftime({0}, '%Y-%m-%d %H:%M:%S.%f') END"
    low, high = shown.format("min(datetime)"), shown.format("max(datetime)")
    q["ingestion_report"] = (
        "SELECT part, item, CAST(shown AS VARCHAR) AS shown FROM ("
        "SELECT 'summary' AS part, unnest(['total_records', 'n_columns', 'date_min', 'date_max', 'years', 'stations', 'pollutant_species']) AS item, "
        f"unnest([CAST(count(*) AS VARCHAR), '22', {low}, {high}, "
        "'[' || array_to_string(list_sort(list(DISTINCT year) FILTER (WHERE year IS NOT NULL)), ', ') || ']', "
        "CAST(count(DISTINCT station_id) AS VARCHAR), CAST(count(DISTINCT pollutant) AS VARCHAR)]) AS shown FROM r UNION ALL "
        "SELECT 'per_month', CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0'), CAST(count(*) AS VARCHAR) "
        "FROM r WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month UNION ALL "
        "SELECT 'per_pollutant', pollutant, CAST(count(*) AS VARCHAR) FROM r WHERE pollutant IS NOT NULL GROUP BY pollutant)")
    q["sql_on_path"] = ("SELECT pollutant, count(*) AS n, count(value) AS n_values, max(value) AS highest, count(vws_m_s) AS n_wind "
                        "FROM r WHERE month < 7 GROUP BY pollutant")
    q["one_partition"] = (f"SELECT year, month, pollutant, count(*) AS n FROM r WHERE year = {ONE_PARTITION[0]} "
                          f"AND month = {ONE_PARTITION[1]} GROUP BY year, month, pollutant")
    q["parsed_timestamps"] = "SELECT CAST(datetime AS DATE) AS day, count(*) AS n, count(*) AS n_equal FROM r GROUP BY 1"
    q["month_extremes_who"] = (
        f"SELECT kind, period, avg_pm25, avg_pm25 / 5.0 AS who_multiple FROM ("
        f"(SELECT 'cleanest' AS kind, period, avg_pm25 FROM ({per}) WHERE avg_pm25 IS NOT NULL ORDER BY avg_pm25, period LIMIT 1) "
        f"UNION ALL (SELECT 'worst', period, avg_pm25 FROM ({per}) WHERE avg_pm25 IS NOT NULL ORDER BY avg_pm25 DESC, period LIMIT 1))")
    bper = ("SELECT CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period, count(*) AS n_rows "
            "FROM clean WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month")
    q["batch_size_extremes"] = (
        f"(SELECT 'smallest' AS kind, period, n_rows FROM ({bper}) ORDER BY n_rows, period LIMIT 1) UNION ALL "
        f"(SELECT 'largest', period, n_rows FROM ({bper}) ORDER BY n_rows DESC, period LIMIT 1)")
    q["partition_roundtrip"] = ("SELECT year, month, count(*) AS n_rows FROM r WHERE year IS NOT NULL AND month IS NOT NULL "
                                "GROUP BY year, month")
    q["station_hourly"] = "SELECT station_id, hour, pm25 FROM sh"
    q["pollutant_avg"] = f"SELECT pollutant AS pollutant_name, {EA('value')} AS avg_val FROM clean WHERE pollutant IS NOT NULL GROUP BY pollutant"
    q["dow_pattern"] = (f"SELECT dow, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][dow + 1] AS day, pm25 FROM ("
                        f"SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS dow, {EA('value')} AS pm25 FROM clean "
                        "WHERE pollutant = 'pm25' AND datetime IS NOT NULL GROUP BY 1)")
    q["station_means"] = f"SELECT station_id, {R2E(EA('pm25'))} AS pm25 FROM sh GROUP BY station_id"
    meds = ", ".join(f"median({c}) AS {c}" for c in WEATHER_COLUMNS)
    q["station_month_medians"] = f"SELECT station_id, month, {meds} FROM c0 GROUP BY station_id, month"
    q["station_month_medians_narrowed"] = q["station_month_medians"]
    q["station_slice"] = f"SELECT station_id, hour, pm25 FROM sh WHERE station_id = (SELECT min(station_id) FROM sh)"
    level = _display_case("pm25", 1)
    q["station_rank"] = (
        f"SELECT rank, station_id, replace(station_id, 'site_', 'Station ') AS display_name, pm25, {level} AS level, "
        "CASE WHEN rank = 1 THEN 'SAFEST' WHEN rank = n_ THEN 'AVOID' ELSE '' END AS badge, "
        "CASE WHEN src = 0 THEN 'hour_snapshot' ELSE 'station_mean' END AS basis FROM ("
        "SELECT *, CAST(row_number() OVER (ORDER BY pm25 NULLS LAST, station_id) AS INTEGER) AS rank, "
        "CAST(count(*) OVER () AS INTEGER) AS n_ FROM ("
        "WITH cand AS ("
        f"SELECT station_id, pm25, 0 AS src FROM sh WHERE hour = {STATION_RANK_HOUR} UNION ALL "
        f"SELECT station_id, {R2E(EA('pm25'))} AS pm25, 1 AS src FROM sh GROUP BY station_id) "
        "SELECT * FROM cand WHERE src = (SELECT min(src) FROM cand)))")
    bw = ("SELECT station_id, hour, pm25, row_number() OVER (PARTITION BY station_id ORDER BY pm25, hour) AS rb, "
          "row_number() OVER (PARTITION BY station_id ORDER BY pm25 DESC, hour) AS rw FROM sh WHERE pm25 IS NOT NULL")
    q["station_best_worst_hour"] = (
        "SELECT x.station_id, x.hour AS best_hour, lpad(CAST(x.hour AS VARCHAR), 2, '0') || ':00' AS best_label, "
        "x.pm25 AS best_pm25, y.hour AS worst_hour, lpad(CAST(y.hour AS VARCHAR), 2, '0') || ':00' AS worst_label, "
        f"y.pm25 AS worst_pm25 FROM ({bw}) x JOIN ({bw}) y ON x.station_id = y.station_id AND x.rb = 1 AND y.rw = 1")
    q["display_levels"] = (f"SELECT station_id, hour, pm25, {_display_case('pm25', 1)} AS level, "
                           f"{_display_case('pm25', 2)} AS color, {_display_case('pm25', 3)} AS emoji, "
                           f"{_display_case('pm25', 4)} AS advice FROM sh")
    q["scaler_params"] = "SELECT min(pm25) AS scaler_min, max(pm25) AS scaler_max FROM hs"
    L = LOOKBACK
    q["lookback_sequences"] = (
        "SELECT station_id, hour_ts, step, CASE WHEN step = 0 THEN x0 WHEN step = 1 THEN x1 WHEN step = 2 THEN x2 ELSE x3 END "
        "AS value_scaled FROM ("
        f"SELECT *, lag(x3, 3) OVER s AS x0, lag(x3, 2) OVER s AS x1, lag(x3, 1) OVER s AS x2 FROM ("
        "SELECT station_id, hour_ts, (v - (SELECT min(pm25) FROM hs)) / "
        "NULLIF((SELECT max(pm25) FROM hs) - (SELECT min(pm25) FROM hs), 0) AS x3 FROM ("
        f"SELECT g.station_id, g.hour_ts, last_value(hs.pm25 IGNORE NULLS) OVER (PARTITION BY g.station_id ORDER BY g.hour_ts "
        f"ROWS BETWEEN {MAX_GAP} PRECEDING AND CURRENT ROW) AS v FROM ("
        "SELECT station_id, unnest(generate_series(min(hour_ts), max(hour_ts), INTERVAL 1 HOUR)) AS hour_ts FROM hs "
        "GROUP BY station_id) g LEFT JOIN hs ON hs.station_id = g.station_id AND hs.hour_ts = g.hour_ts)) "
        "WINDOW s AS (PARTITION BY station_id ORDER BY hour_ts)), (SELECT CAST(unnest(range(4)) AS INTEGER) AS step) "
        "WHERE x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL")
    q["lookback_observations"] = (
        f"SELECT e.station_id, e.hour_ts, CAST(b.rn - (e.rn - {L - 1}) AS INTEGER) AS step, b.x AS value_scaled FROM ("
        "SELECT station_id, hour_ts, (pm25 - (SELECT min(pm25) FROM hs)) / "
        "NULLIF((SELECT max(pm25) FROM hs) - (SELECT min(pm25) FROM hs), 0) AS x, "
        "row_number() OVER (PARTITION BY station_id ORDER BY hour_ts) AS rn FROM hs) e JOIN ("
        "SELECT station_id, hour_ts, (pm25 - (SELECT min(pm25) FROM hs)) / "
        "NULLIF((SELECT max(pm25) FROM hs) - (SELECT min(pm25) FROM hs), 0) AS x, "
        "row_number() OVER (PARTITION BY station_id ORDER BY hour_ts) AS rn FROM hs) b "
        f"ON e.station_id = b.station_id AND b.rn BETWEEN e.rn - {L - 1} AND e.rn WHERE e.rn >= {L}")
    sf = ("SELECT a.station_id, a.hour_ts, a.pm25 AS actual, "
          "CASE WHEN b.pm25 IS NULL THEN NULL ELSE greatest(b.pm25, 0.0) END AS predicted "
          "FROM hs a JOIN hs b ON a.station_id = b.station_id AND a.hour_ts = b.hour_ts + INTERVAL 24 HOUR")
    q["seasonal_forecast"] = sf
    q["forecast_mae"] = (f"SELECT station_id, {R2E(EA('abs(actual - predicted)'))} AS mae, count(*) AS n_hours "
                         f"FROM ({sf}) GROUP BY station_id")
    fc = ("SELECT h.station_id, CAST(date_diff('hour', l.t - INTERVAL 23 HOUR, h.hour_ts) AS INTEGER) AS step, "
          "greatest(h.pm25, 0.0) AS predicted FROM hs h JOIN (SELECT station_id, max(hour_ts) AS t FROM hs GROUP BY station_id) l "
          "ON h.station_id = l.station_id WHERE h.hour_ts >= l.t - INTERVAL 23 HOUR AND h.pm25 IS NOT NULL")
    rk = (f"SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY predicted, step) AS rb, "
          f"row_number() OVER (PARTITION BY station_id ORDER BY predicted DESC, step) AS rw, "
          f"count(*) OVER (PARTITION BY station_id) AS n FROM ({fc})")
    q["feature_bundle_mae"] = q["forecast_mae"]
    q["forecast_best_worst_step"] = (
        "SELECT x.station_id, x.step AS best_step, '+' || CAST(x.step AS VARCHAR) || 'h' AS best_label, "
        "x.predicted AS best_pm25, y.step AS worst_step, '+' || CAST(y.step AS VARCHAR) || 'h' AS worst_label, "
        f"y.predicted AS worst_pm25, x.n AS n_steps FROM ({rk}) x JOIN ({rk}) y "
        "ON x.station_id = y.station_id AND x.rb = 1 AND y.rw = 1")
    return {k: with_all(v) for k, v in q.items()}
