"""Column expressions. Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; no Python UDF is involved."""

from aerolake.functions.rounding import exact_avg, exact_avg_sql, exact_std, exact_sum_sql, round2_half_even, round2_half_away
from aerolake.functions.levels import pm25_level, aqi_category, display_level, display_level_columns
from aerolake.functions.labels import (period_label, station_display_name, weekday_name, hour_label,
                                       step_label, clip_lower, minmax_scale, minmax_unscale, pct,
                                       parse_timestamp, thousands)

__all__ = [
    "exact_avg", "exact_avg_sql", "exact_std", "exact_sum_sql", "round2_half_even", "round2_half_away",
    "pm25_level", "aqi_category", "display_level", "display_level_columns",
    "period_label", "station_display_name", "weekday_name", "hour_label", "step_label",
    "clip_lower", "minmax_scale", "minmax_unscale", "pct", "parse_timestamp", "thousands",
]
