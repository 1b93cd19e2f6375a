"""Distributed exact quantiles against Spark's single-task exact percentile and numpy."""

import numpy as np
from pyspark.sql import functions as F

from aerolake.operators.quantiles import exact_quantiles


def test_matches_percentile(spark):
    rng = np.random.RandomState(3)
    vals = [float(v) for v in np.round(rng.gamma(2.0, 30.0, 4000), 2)] + [7.0] * 3000 + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = exact_quantiles(df, "v", probs, buckets=16)
    ref = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert got == ref
    clean = np.array([v for v in vals if v is not None])
    assert np.allclose(got, np.quantile(clean, probs), rtol=0, atol=1e-9)


def test_small_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert exact_quantiles(df, "v", [0.5]) == [2.0]
    assert exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]
    one = spark.createDataFrame([(4.0,)], "v double")
    assert exact_quantiles(one, "v", [0.25, 0.75]) == [4.0, 4.0]
