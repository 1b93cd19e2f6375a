"""Marts over the clean frame: batch statistics (A10), monthly averages (A11), daily peaks (A12),
PM2.5 level counts (A13), PM2.5 AQI rows (F3 + P1) and the three-output ETL (C2).

All aggregates are single hash aggregates with map-side partial aggregation; their outputs are bounded by
the number of keys (months x pollutants, station-days x pollutants, stations x levels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions import aqi_category, exact_avg, pm25_level, round2_half_even
from aerolake.operators.util import non_null_keys
from aerolake.sources.sinks import write_outputs

PM25 = "pm25"


def batch_stats(clean: DataFrame, exact: bool = True) -> DataFrame:
    """A10: per (year, month, pollutant): mean, max, min, count of non-missing values and sample standard
    deviation, all rounded to 2 decimals like numpy (a one-row group has a NULL deviation).

    The reference loops over months and concatenates; one grouped aggregate gives the same rows."""
    keys = ["year", "month", "pollutant"]
    g = non_null_keys(clean, keys).groupBy(*keys).agg(
        round2_half_even(exact_avg("value", exact)).alias("avg_value"),
        round2_half_even(F.max("value")).alias("max_value"),
        round2_half_even(F.min("value")).alias("min_value"),
        F.count("value").alias("reading_count"),
        round2_half_even(F.stddev_samp("value")).alias("std_value"),
    )
    return g.select("pollutant", "avg_value", "max_value", "min_value", "reading_count", "std_value",
                    "year", "month")


def level_counts(clean: DataFrame) -> DataFrame:
    """PM2.5 readings per (station, level). The map step is the F2 ladder, the shuffle/reduce step a
    grouped count whose map-side partial aggregation plays the combiner."""
    pm = clean.where(F.col("pollutant") == PM25)
    return (pm.select(F.col("station_id").alias("station"), pm25_level("value").alias("pollution_level"))
              .groupBy("station", "pollution_level").agg(F.count(F.lit(1)).alias("count")))


def sorted_level_counts(clean: DataFrame) -> DataFrame:
    """A13 presented like the reference: station ascending, count descending (level breaks ties)."""
    return level_counts(clean).orderBy(F.asc("station"), F.desc("count"), F.asc("pollution_level"))


def monthly_avg(clean: DataFrame, exact: bool = True) -> DataFrame:
    """Mean value per (year, month, pollutant), 2 decimals; the column keeps the name ``value``."""
    keys = ["year", "month", "pollutant"]
    return non_null_keys(clean, keys).groupBy(*keys).agg(
        round2_half_even(exact_avg("value", exact)).alias("value"))


def pm25_aqi(clean: DataFrame) -> DataFrame:
    """PM2.5 rows with their AQI category (F3): datetime, station_id, value, aqi_category."""
    return clean.where(F.col("pollutant") == PM25).select(
        "datetime", "station_id", "value", aqi_category("value").alias("aqi_category"))


def daily_peaks(clean: DataFrame) -> DataFrame:
    """Highest value per (year, month, day, station_id, pollutant)."""
    keys = ["year", "month", "day", "station_id", "pollutant"]
    return non_null_keys(clean, keys).groupBy(*keys).agg(F.max("value").alias("value"))


def transform_outputs(clean: DataFrame) -> dict[str, DataFrame]:
    """C2 transform step: the three ETL tables, all derived from the same clean frame."""
    return {"monthly_avg": monthly_avg(clean), "pm25_aqi": pm25_aqi(clean), "daily_peaks": daily_peaks(clean)}


def run_etl(clean: DataFrame, output_dir: str) -> dict[str, DataFrame]:
    """Transform and write ``<output_dir>/<name>.parquet`` for each of the three tables.

    ``clean`` should be a materialized frame (the written clean dataset read back), so the three jobs
    scan Parquet instead of re-running the cleaning."""
    outputs = transform_outputs(clean)
    write_outputs(outputs, output_dir)
    return outputs
