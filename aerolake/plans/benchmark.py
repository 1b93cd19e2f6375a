"""Benchmark queries Q1-Q4 (A14-A17, C4), the direct-on-Parquet Q1 (S7) and the serving queries.

Written as Spark SQL over DataFrame parameters (``{m}`` measurements, ``{p}`` pollutants, ``{s}``
stations), so the same text runs over catalog tables, freshly built frames or Parquet paths. Expected
plan for the star queries: the fact scan reads only the referenced columns, the one-row pollutant filter
is pushed into the dimension, the dimension joins are broadcast hash joins, partial aggregation runs before
the only shuffle, and the top-k is a ``TakeOrderedAndProject``.

Averages are ``functions.exact_avg``, so results do not depend on partitioning; SQL
``ROUND(x, 2)`` is written out as half-away-from-zero on the scaled value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.functions.rounding import exact_avg_sql
from aerolake.sources.parquet import load_raw


def round2_away_sql(x: str) -> str:
    return (f"CASE WHEN ({x}) >= 0 THEN CAST(FLOOR(({x}) * 100 + 0.5) AS DOUBLE) / 100 "
            f"ELSE -CAST(FLOOR(-({x}) * 100 + 0.5) AS DOUBLE) / 100 END")


Q1_AVG_PM25_PER_MONTH = f"""
SELECT year, month, {exact_avg_sql('value')} AS avg_pm25
FROM {{m}} m JOIN {{p}} p ON m.pollutant_id = p.pollutant_id
WHERE p.pollutant_name = 'pm25'
GROUP BY year, month
ORDER BY year, month
"""

Q2_TOP3_PM10 = f"""
SELECT s.station_id, s.city, {exact_avg_sql('m.value')} AS avg_pm10
FROM {{m}} m JOIN {{p}} p ON m.pollutant_id = p.pollutant_id
             JOIN {{s}} s ON m.station_id = s.station_id
WHERE p.pollutant_name = 'pm10'
GROUP BY s.station_id, s.city
ORDER BY avg_pm10 DESC NULLS LAST, s.station_id, s.city
LIMIT 3
"""

Q3_COUNT_PER_POLLUTANT = """
SELECT p.pollutant_name, COUNT(*) AS n
FROM {m} m JOIN {p} p ON m.pollutant_id = p.pollutant_id
GROUP BY p.pollutant_name
ORDER BY n DESC, p.pollutant_name
"""

# The source picks "the first station" with an unordered LIMIT 1; the smallest id is the deterministic
# reading of that.
Q4_DAILY_PEAK_NO2 = """
SELECT year, month, day, MAX(value) AS peak_no2
FROM {m} m JOIN {p} p ON m.pollutant_id = p.pollutant_id
WHERE p.pollutant_name = 'no2'
  AND m.station_id = (SELECT MIN(station_id) FROM {s})
GROUP BY year, month, day
ORDER BY year, month, day
"""

Q1_DIRECT = f"""
SELECT year, month, {exact_avg_sql('value')} AS avg_pm25
FROM {{raw}}
WHERE pollutant = 'pm25'
GROUP BY year, month
ORDER BY year, month
"""

SERVED_MONTHLY_PM25 = f"""
SELECT year, month, {round2_away_sql(exact_avg_sql('value'))} AS avg_pm25
FROM {{m}} m JOIN {{p}} p ON m.pollutant_id = p.pollutant_id
WHERE p.pollutant_name = 'pm25'
GROUP BY year, month
ORDER BY year, month
"""

SERVED_TOP3_PM25 = f"""
SELECT s.station_id, {round2_away_sql(exact_avg_sql('m.value'))} AS avg_pm25
FROM {{m}} m JOIN {{p}} p ON m.pollutant_id = p.pollutant_id
             JOIN {{s}} s ON m.station_id = s.station_id
WHERE p.pollutant_name = 'pm25'
GROUP BY s.station_id
ORDER BY avg_pm25 DESC NULLS LAST, s.station_id
LIMIT 3
"""

SERVED_PREAGG_SLICE = """
SELECT * FROM {monthly}
WHERE pollutant = 'pm25'
ORDER BY year, month
LIMIT 6
"""

# Q1 on the clean frame with numpy-style rounding (the pandas / in-memory comparison of the source).
MONTHLY_PM25_CLEAN = f"""
SELECT year, month, rint(({exact_avg_sql('value')}) * 100) / 100 AS avg_pm25
FROM {{clean}}
WHERE pollutant = 'pm25' AND year IS NOT NULL AND month IS NOT NULL
GROUP BY year, month
ORDER BY year, month
"""


def _star(spark: SparkSession, sql: str, fact: DataFrame, pollutants: DataFrame,
          stations: DataFrame | None = None) -> DataFrame:
    args = {"m": fact, "p": pollutants}
    if stations is not None:
        args["s"] = stations
    return spark.sql(sql, **args)


def q1_avg_pm25_per_month(spark, fact, pollutants) -> DataFrame:
    return _star(spark, Q1_AVG_PM25_PER_MONTH, fact, pollutants)


def q2_top3_pm10(spark, fact, pollutants, stations) -> DataFrame:
    return _star(spark, Q2_TOP3_PM10, fact, pollutants, stations)


def q3_count_per_pollutant(spark, fact, pollutants) -> DataFrame:
    return _star(spark, Q3_COUNT_PER_POLLUTANT, fact, pollutants)


def q4_daily_peak_no2(spark, fact, pollutants, stations) -> DataFrame:
    return _star(spark, Q4_DAILY_PEAK_NO2, fact, pollutants, stations)


def q1_direct(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Q1 straight on the raw rows (a Parquet scan when ``raw`` is one): no star load needed."""
    return spark.sql(Q1_DIRECT, raw=raw)


def q1_direct_on_path(spark: SparkSession, parquet_path: str) -> DataFrame:
    """The same query with the file as the table. The path is resolved by ``load_raw``, so NaN counts as missing
    and nanosecond files are read; the scan still reads the query's columns only."""
    return q1_direct(spark, load_raw(spark, parquet_path))


def served_monthly_pm25(spark, fact, pollutants) -> DataFrame:
    return _star(spark, SERVED_MONTHLY_PM25, fact, pollutants)


def served_top3_pm25(spark, fact, pollutants, stations) -> DataFrame:
    return _star(spark, SERVED_TOP3_PM25, fact, pollutants, stations)


def served_preagg_slice(spark, monthly: DataFrame) -> DataFrame:
    return spark.sql(SERVED_PREAGG_SLICE, monthly=monthly)


def monthly_pm25_clean(spark, clean: DataFrame) -> DataFrame:
    return spark.sql(MONTHLY_PM25_CLEAN, clean=clean)


def run_benchmark_queries(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """C4: Q1-Q4 over the raw star tables of ``database`` (lazy; the caller times and collects)."""
    m = spark.table(f"{database}.measurements")
    p = spark.table(f"{database}.pollutants")
    s = spark.table(f"{database}.stations")
    return {"q1_avg_pm25_per_month": q1_avg_pm25_per_month(spark, m, p),
            "q2_top3_pm10": q2_top3_pm10(spark, m, p, s),
            "q3_count_per_pollutant": q3_count_per_pollutant(spark, m, p),
            "q4_daily_peak_no2": q4_daily_peak_no2(spark, m, p, s)}
