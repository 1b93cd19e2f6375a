"""Property tests: the Column expressions agree with plain-Python statements of the same rules on random
inputs (boundaries, NULL and ties included)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.functions import aqi_category, display_level, pm25_level, round2_half_away, round2_half_even

BOUNDARIES = [0.0, 5.0, 35.0, 55.0, 150.0, 250.0, -0.01, 0.01, 5.01, 150.01, 250.01]
values = st.one_of(st.none(), st.sampled_from(BOUNDARIES),
                   st.floats(min_value=-50, max_value=400, allow_nan=False, allow_infinity=False))


def py_level(v):
    if v is None:
        return "hazardous"
    for bound, name in ((5, "safe"), (35, "moderate"), (55, "unhealthy"), (150, "very_unhealthy")):
        if v <= bound:
            return name
    return "hazardous"


def py_aqi(v):
    if v is None:
        return None
    for lo, hi, name in ((0, 5, "Safe"), (5, 35, "Moderate"), (35, 55, "Unhealthy"), (55, 150, "Very Unhealthy"),
                         (150, float("inf"), "Hazardous")):
        if lo < v <= hi:
            return name
    return None


def py_display(v):
    if v is None:
        return "Hazardous"
    for bound, name in ((5, "Safe"), (35, "Moderate"), (55, "Unhealthy (sensitive)"), (150, "Unhealthy"),
                        (250, "Very Unhealthy")):
        if v <= bound:
            return name
    return "Hazardous"


@settings(max_examples=15, deadline=None)
@given(st.lists(values, min_size=1, max_size=60))
def test_level_scales(spark, vs):
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    got = df.select(pm25_level("v").alias("a"), aqi_category("v").alias("b"), display_level("v").alias("c")).collect()
    assert [r.a for r in got] == [py_level(v) for v in vs]
    assert [r.b for r in got] == [py_aqi(v) for v in vs]
    assert [r.c for r in got] == [py_display(v) for v in vs]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=-10**7, max_value=10**7), min_size=1, max_size=80))
def test_rounding_on_ties_and_thousandths(spark, ks):
    xs = [k / 1000.0 for k in ks] + [k / 1000.0 + 0.0005 for k in ks]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select(round2_half_even("x").alias("e"), round2_half_away("x").alias("a")).collect()
    assert [r.e for r in got] == [float(np.round(x, 2)) for x in xs]
    away = [float(np.sign(x) * np.floor(abs(x) * 100 + 0.5) / 100) for x in xs]
    assert [r.a for r in got] == [a if a != 0 else 0.0 for a in away]
