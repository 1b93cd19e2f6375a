"""Dashboard feature tables and forecasting helpers (A18-A22, A31, A32, W4-W6, F4, F16), re-aimed from a
single-machine dashboard bundle to Spark marts.

Sizes: the hourly profile is bounded by stations x 24, the weekday pattern by 7, the pollutant averages by
the pollutant vocabulary. The hourly series has one row per station-hour, so a per-station window holds at
most the hours of the covered time span (8,760 per year) no matter how many raw rows feed it — windows
partitioned by station are safe for that reason. The seasonal forecast is an equi-join of the series with
itself shifted by 24 hours (robust to gaps, unlike a 24-row lag).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions import (clip_lower, display_level, display_level_columns, exact_avg, hour_label,
                                minmax_scale, round2_half_even, station_display_name, step_label, weekday_name)
from aerolake.operators.util import non_null_keys
from aerolake.schema import FORECAST_HORIZON

PM25 = "pm25"


def _pm25(clean: DataFrame) -> DataFrame:
    return clean.where(F.col("pollutant") == PM25)


def station_hourly(clean: DataFrame, exact: bool = True) -> DataFrame:
    """Mean PM2.5 per station and hour of day: station_id, hour, pm25."""
    return (non_null_keys(_pm25(clean), ["station_id", "hour"]).groupBy("station_id", "hour")
              .agg(exact_avg("value", exact).alias("pm25")))


def pollutant_avg(clean: DataFrame, exact: bool = True) -> DataFrame:
    """Mean level per pollutant: pollutant_name, avg_val."""
    return (clean.where(F.col("pollutant").isNotNull()).groupBy(F.col("pollutant").alias("pollutant_name"))
                 .agg(exact_avg("value", exact).alias("avg_val")))


def dow_pattern(clean: DataFrame, exact: bool = True) -> DataFrame:
    """Mean PM2.5 per weekday, dow 0 = Monday, with the day name."""
    pm = _pm25(clean).where(F.col("datetime").isNotNull())
    g = pm.groupBy(F.weekday("datetime").cast("int").alias("dow")).agg(exact_avg("value", exact).alias("pm25"))
    return g.select("dow", weekday_name("dow").alias("day"), "pm25")


def station_means(profile: DataFrame) -> DataFrame:
    """Unweighted mean of a station's hourly means (2 decimals)."""
    return profile.groupBy("station_id").agg(round2_half_even(exact_avg("pm25")).alias("pm25"))


def station_rank(profile: DataFrame, hour=None) -> DataFrame:
    """W4 (+P9): stations ranked cleanest -> worst. With ``hour`` (an int, a Column, or ``"now"`` for the
    current hour of the session clock) the ranking uses that hour's profile snapshot; when the snapshot is
    empty (or no hour is given) it falls back to the station means (A21). The first station is badged
    SAFEST, the last AVOID.

    One aggregate per station carries both the snapshot value and the mean, so the profile (and whatever
    produced it) is computed once; the choice between them is a window over the per-station rows, which
    are bounded by the number of stations."""
    if hour is None:
        in_snap = F.lit(False)
    else:
        h = F.hour(F.current_timestamp()) if isinstance(hour, str) and hour == "now" else \
            (hour if not isinstance(hour, int) else F.lit(hour))
        in_snap = F.coalesce(F.col("hour") == h, F.lit(False))
    per = profile.groupBy("station_id").agg(
        F.max(in_snap).alias("__has"),
        F.max(F.when(in_snap, F.col("pm25"))).alias("__snap"),
        round2_half_even(exact_avg("pm25")).alias("__mean"))
    any_snap = F.max(F.col("__has")).over(Window.partitionBy())
    chosen = per.withColumn("__any", any_snap).where(~F.col("__any") | F.col("__has")).select(
        "station_id",
        F.when(F.col("__any"), F.col("__snap")).otherwise(F.col("__mean")).alias("pm25"),
        F.when(F.col("__any"), F.lit("hour_snapshot")).otherwise(F.lit("station_mean")).alias("basis"))
    w = Window.orderBy(F.col("pm25").asc_nulls_last(), F.col("station_id"))
    ranked = chosen.select(
        "station_id", "pm25", "basis",
        F.row_number().over(w).cast("int").alias("rank"),
        F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("__n"))
    badge = F.when(F.col("rank") == 1, F.lit("SAFEST")).when(F.col("rank") == F.col("__n"), F.lit("AVOID")) \
        .otherwise(F.lit(""))
    return ranked.select("rank", "station_id", station_display_name("station_id").alias("display_name"),
                         "pm25", display_level("pm25").alias("level"), badge.alias("badge"), "basis")


def station_slice(profile: DataFrame, station_id) -> DataFrame:
    """P10: one station's hourly profile, by hour. ``station_id`` may be a literal or a Column (e.g. a
    scalar subquery)."""
    sid = station_id if not isinstance(station_id, str) else F.lit(station_id)
    return profile.where(F.col("station_id") == sid).orderBy("hour")


def station_best_worst_hour(profile: DataFrame) -> DataFrame:
    """Per station the cleanest and the worst hour of day (the earliest hour wins ties)."""
    p = profile.where(F.col("pm25").isNotNull())
    g = p.groupBy("station_id").agg(
        F.min(F.struct(F.col("pm25"), F.col("hour"))).alias("b"),
        F.max(F.struct(F.col("pm25"), (-F.col("hour")).alias("neg_hour"))).alias("w"))
    return g.select("station_id",
                    F.col("b.hour").alias("best_hour"), hour_label(F.col("b.hour")).alias("best_label"),
                    F.col("b.pm25").alias("best_pm25"),
                    (-F.col("w.neg_hour")).alias("worst_hour"), hour_label(-F.col("w.neg_hour")).alias("worst_label"),
                    F.col("w.pm25").alias("worst_pm25"))


def display_levels(profile: DataFrame) -> DataFrame:
    """F4 applied to the hourly profile: level, colour, emoji and advice per station-hour."""
    return profile.select("station_id", "hour", "pm25", *display_level_columns("pm25"))


# --------------------------------------------------------------------------------- hourly series, W5/W6
def hourly_series(clean: DataFrame, exact: bool = True) -> DataFrame:
    """Hourly PM2.5 series per station: station_id, hour_ts (truncated to the hour), pm25."""
    pm = _pm25(clean).where(F.col("station_id").isNotNull() & F.col("datetime").isNotNull())
    ts = F.date_trunc("HOUR", F.col("datetime")).cast("timestamp_ntz")
    return pm.groupBy("station_id", ts.alias("hour_ts")).agg(exact_avg("value", exact).alias("pm25"))


def scaler_params(series: DataFrame) -> DataFrame:
    """min/max of the hourly series (the min-max scaler's parameters)."""
    return series.agg(F.min("pm25").alias("scaler_min"), F.max("pm25").alias("scaler_max"))


def gap_filled(series: DataFrame, max_gap: int) -> DataFrame:
    """The hourly series on a grid without gaps: station_id, hour_ts, pm25, is_gap, one row for each hour from a
    station's first to its last reading. An hour without a reading is marked and carries the last reading of at most
    ``max_gap`` hours before, else NULL.

    The grid is made from one row per station (its first and last hour) in two steps, days and then hours, dealt by
    station and day in between, so a station with a long history is not expanded by one task. The window holds the hours of
    one station (8,760 a year), however many raw rows they came from."""
    ends = series.groupBy("station_id").agg(F.min("hour_ts").alias("__lo"), F.max("hour_ts").alias("__hi"))
    day = F.sequence(F.date_trunc("DAY", "__lo"), F.date_trunc("DAY", "__hi"), F.expr("INTERVAL 1 DAY"))
    days = ends.select("station_id", "__lo", "__hi", F.explode(day).alias("__day")).repartition("station_id", "__day")
    grid = days.select("station_id", "__lo", "__hi", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("__day") + F.make_dt_interval(F.lit(0), h))).alias("__ts"))
    grid = grid.select("station_id", F.col("__ts").cast("timestamp_ntz").alias("hour_ts"), "__lo", "__hi") \
        .where((F.col("hour_ts") >= F.col("__lo")) & (F.col("hour_ts") <= F.col("__hi"))).select("station_id", "hour_ts")
    last = Window.partitionBy("station_id").orderBy("hour_ts").rowsBetween(-max_gap, 0)
    return grid.join(series, ["station_id", "hour_ts"], "left").select(
        "station_id", "hour_ts", F.last("pm25", ignorenulls=True).over(last).alias("pm25"),
        F.col("pm25").isNull().alias("is_gap"))


def lookback_sequences(series: DataFrame, lookback: int, require_contiguous: bool = True) -> DataFrame:
    """For each station-hour, the scaled values of the last ``lookback`` hours ending there.

    Scaling uses the series' min/max as scalar subqueries. With ``require_contiguous`` only windows of
    exactly ``lookback`` consecutive hours are kept. Returns station_id, hour_ts, seq (array<double>)."""
    params = scaler_params(series)
    lo, hi = params.select("scaler_min").scalar(), params.select("scaler_max").scalar()
    w = Window.partitionBy("station_id").orderBy("hour_ts").rowsBetween(-(lookback - 1), 0)
    scaled = series.select("station_id", "hour_ts", minmax_scale("pm25", lo, hi).alias("__x"))
    framed = scaled.select(
        "station_id", "hour_ts",
        # collect_list drops NULLs; wrapping each value in a struct keeps a missing hour in its position
        F.transform(F.collect_list(F.struct(F.col("__x").alias("x"))).over(w), lambda e: e["x"]).alias("seq"),
        F.count(F.lit(1)).over(w).alias("__len"),
        F.first("hour_ts").over(w).alias("__first"))
    keep = F.col("__len") == lookback
    if require_contiguous:
        keep = keep & (F.col("__first") == F.col("hour_ts") - F.make_dt_interval(F.lit(0), F.lit(lookback - 1)))
    return framed.where(keep).select("station_id", "hour_ts", "seq")


def seasonal_forecast(series: DataFrame, season_hours: int = FORECAST_HORIZON) -> DataFrame:
    """W6 backtest: the prediction for an hour is the value ``season_hours`` earlier, clipped at 0.
    Rows: station_id, hour_ts, actual, predicted (only hours whose source hour exists)."""
    a = series.select("station_id", "hour_ts", F.col("pm25").alias("actual"))
    b = series.select(F.col("station_id").alias("__sid"),
                      (F.col("hour_ts") + F.make_dt_interval(F.lit(0), F.lit(season_hours))).alias("__target"),
                      F.col("pm25").alias("__src"))
    j = a.join(b, (a["station_id"] == b["__sid"]) & (a["hour_ts"] == b["__target"]), "inner")
    return j.select("station_id", "hour_ts", "actual", clip_lower("__src").alias("predicted"))


def forecast_mae(backtest: DataFrame) -> DataFrame:
    """Mean absolute error of the forecast per station (2 decimals) and the hours it covers."""
    return backtest.groupBy("station_id").agg(
        round2_half_even(exact_avg("abs(actual - predicted)")).alias("mae"),
        F.count(F.lit(1)).alias("n_hours"))


def forecast_next(series: DataFrame, horizon: int = FORECAST_HORIZON) -> DataFrame:
    """The next ``horizon`` hours after each station's last observed hour, seasonal-naive: step i (0-based)
    targets last + (i+1) h and takes the value observed ``horizon`` hours before it, clipped at 0.
    Steps whose source hour is missing are absent. Rows: station_id, step, target_ts, predicted."""
    last = F.max("hour_ts").over(Window.partitionBy("station_id"))
    s = series.withColumn("__last", last)
    first_src = F.col("__last") - F.make_dt_interval(F.lit(0), F.lit(horizon - 1))
    s = s.where(F.col("hour_ts") >= first_src)
    step = F.timestamp_diff("HOUR", first_src, F.col("hour_ts")).cast("int")
    return s.select("station_id", step.alias("step"),
                    (F.col("hour_ts") + F.make_dt_interval(F.lit(0), F.lit(horizon))).alias("target_ts"),
                    clip_lower("pm25").alias("predicted"))


def forecast_best_worst_step(series: DataFrame, horizon: int = FORECAST_HORIZON) -> DataFrame:
    """F16: per station, the forecast step with the lowest and the highest prediction (first step wins
    ties), with ``+Nh`` labels."""
    f = forecast_next(series, horizon).where(F.col("predicted").isNotNull())
    g = f.groupBy("station_id").agg(
        F.min(F.struct(F.col("predicted"), F.col("step"))).alias("b"),
        F.max(F.struct(F.col("predicted"), (-F.col("step")).alias("neg_step"))).alias("w"),
        F.count(F.lit(1)).alias("n_steps"))
    return g.select("station_id",
                    F.col("b.step").alias("best_step"), step_label(F.col("b.step")).alias("best_label"),
                    F.col("b.predicted").alias("best_pm25"),
                    (-F.col("w.neg_step")).alias("worst_step"), step_label(-F.col("w.neg_step")).alias("worst_label"),
                    F.col("w.predicted").alias("worst_pm25"), "n_steps")


def feature_bundle(clean: DataFrame, hour: int | None = None, exact: bool = True) -> dict[str, DataFrame]:
    """S14 re-aimed: the dashboard's feature tables as named marts (write them with
    ``sources.write_feature_bundle``). Every table is an aggregate bounded by stations, hours, weekdays or
    pollutants; the hourly series feeds the scaler and the forecast error."""
    profile = station_hourly(clean, exact)
    series = hourly_series(clean, exact)
    backtest = seasonal_forecast(series)
    return {
        "station_hourly": profile,
        "station_profile": station_rank(profile, hour),
        "all_pollutants": pollutant_avg(clean, exact),
        "dow_pattern": dow_pattern(clean, exact),
        "best_worst_hour": station_best_worst_hour(profile),
        "scaler": scaler_params(series),
        "mae": forecast_mae(backtest),
        "forecast_steps": forecast_best_worst_step(series),
    }
