"""Scalar functions F1-F17 on edge values."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from aerolake.functions import (aqi_category, clip_lower, display_level, display_level_columns, exact_avg,
                                hour_label, minmax_scale, minmax_unscale, period_label, pm25_level,
                                round2_half_away, round2_half_even, station_display_name, step_label,
                                weekday_name)

EDGE = [0.0, None, 5.0, 35.0, 55.0, 150.0, 150.01, -3.0, 250.0, 250.5, 5.0001]


def _vals(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_pm25_level_ladder(spark):
    got = [r[0] for r in _vals(spark, EDGE).select(pm25_level("v")).collect()]
    assert got == ["safe", "hazardous", "safe", "moderate", "unhealthy", "very_unhealthy", "hazardous", "safe",
                   "hazardous", "hazardous", "moderate"]


def test_aqi_category_bins(spark):
    got = [r[0] for r in _vals(spark, EDGE + [float("inf")]).select(aqi_category("v")).collect()]
    assert got == [None, None, "Safe", "Moderate", "Unhealthy", "Very Unhealthy", "Hazardous", None,
                   "Hazardous", "Hazardous", "Moderate", "Hazardous"]


def test_display_scale(spark):
    got = [r[0] for r in _vals(spark, EDGE).select(display_level("v")).collect()]
    assert got == ["Safe", "Hazardous", "Safe", "Moderate", "Unhealthy (sensitive)", "Unhealthy", "Very Unhealthy",
                   "Safe", "Very Unhealthy", "Hazardous", "Moderate"]
    row = _vals(spark, [100.0]).select(*display_level_columns("v")).first()
    assert row.level == "Unhealthy" and row.color == "#e67e22" and row.advice == "Limit time outdoors."


def test_round_half_even_matches_numpy(spark):
    rng = np.random.RandomState(7)
    xs = [float(x) for x in np.round(rng.uniform(0, 500, 3000), 3)] + [0.125, 0.135, 2.675, 33.425, 1.005, -0.125]
    got = [r[0] for r in _vals(spark, xs).select(round2_half_even("v")).collect()]
    assert got == [float(np.round(x, 2)) for x in xs]


def test_round_half_away(spark):
    got = [r[0] for r in _vals(spark, [0.125, 0.135, -0.125, 1.0, None, 2.344]).select(round2_half_away("v")).collect()]
    assert got[:4] == [0.13, 0.14, -0.13, 1.0] and got[4] is None and got[5] == 2.34


def test_exact_avg_independent_of_order(spark):
    vals = [0.1, 0.2, 0.3, 33.42, 33.43, 1e-6, 17.17] * 50
    df1 = spark.createDataFrame([(v,) for v in vals], "v double").repartition(7)
    df2 = spark.createDataFrame([(v,) for v in reversed(vals)], "v double").coalesce(1)
    a = df1.agg(exact_avg("v")).first()[0]
    b = df2.agg(exact_avg("v")).first()[0]
    assert a == b
    assert spark.createDataFrame([(None,)], "v double").agg(exact_avg("v")).first()[0] is None


def test_labels(spark):
    df = spark.createDataFrame([(2024, 3, "site_101", 0, 7, 5)], "y int, m int, s string, dow int, h int, st int")
    r = df.select(period_label("y", "m").alias("p"), station_display_name("s").alias("n"),
                  weekday_name("dow").alias("d"), hour_label("h").alias("hl"), step_label("st").alias("sl")).first()
    assert (r.p, r.n, r.d, r.hl, r.sl) == ("2024-03", "Station 101", "Mon", "07:00", "+5h")
    days = [r[0] for r in spark.range(7).select(weekday_name(F.col("id"))).collect()]
    assert days == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def test_clip_and_scale(spark):
    df = _vals(spark, [-2.0, None, 3.0])
    assert [r[0] for r in df.select(clip_lower("v")).collect()] == [0.0, None, 3.0]
    lo, hi = F.lit(1.0), F.lit(5.0)
    r = _vals(spark, [3.0]).select(minmax_scale("v", lo, hi).alias("s")).first()
    assert r.s == 0.5
    assert _vals(spark, [0.5]).select(minmax_unscale("v", lo, hi)).first()[0] == 3.0
    assert _vals(spark, [3.0]).select(minmax_scale("v", lo, lo)).first()[0] is None


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "t timestamp_ntz")  # a Monday
    assert df.select(F.weekday("t")).first()[0] == 0
    assert not math.isnan(0.0)


def test_parse_timestamp_and_thousands(spark):
    from aerolake.functions import parse_timestamp, thousands
    df = spark.createDataFrame([("2024-01-01T01:00:00Z", 5831431)], "s string, n long")
    r = df.select(parse_timestamp("s").alias("t"), thousands("n").alias("n")).first()
    assert r.t == dt.datetime(2024, 1, 1, 1, 0) and r.n == "5,831,431"


def test_scale_conf():
    from aerolake.session import scale_conf
    big = scale_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000
    small = scale_conf(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_run_concurrently(spark):
    import pytest
    from aerolake.session import run_concurrently
    out = run_concurrently(spark, lambda: spark.range(10).count(), lambda: spark.range(5).count())
    assert out == [10, 5]
    seen = []

    def bad():
        raise ValueError("boom")

    with pytest.raises(ValueError):
        run_concurrently(spark, bad, lambda: seen.append(spark.range(3).count()))
    assert seen == [3]  # the other step still ran to completion
