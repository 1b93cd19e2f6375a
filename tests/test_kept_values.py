"""Averages without a cut, names that survive the clean dataset, nanosecond files, plans of the marts."""

import glob
import math
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolake.functions import exact_avg
from aerolake.operators.clean import deduplicated_readings
from aerolake.operators.transform import batch_stats, level_counts
from aerolake.plans.benchmark import exact_avg_sql, q1_direct_on_path
from aerolake.plans.registry import queries
from aerolake.schema import CLEAN_COLUMNS
from aerolake.sources.fixture import load_fixture_raw
from aerolake.sources.parquet import load_raw
from aerolake.sources.sinks import read_clean, write_clean

SF = "/root/testdata/sf0.001"
GROUPS = {"small": ([3e-7, 4e-7], 3.5e-7), "large": ([2e12, 4.0], 1000000000002.0), "none": ([None], None),
          "huge": ([1e300, 3e300], 2e300), "tiny": ([1e-30, 3e-30], 2e-30), "tie": ([33.42, 33.43], 33.425)}


def test_averages_are_not_cut(spark):
    rows = [(k, v) for k, (values, _) in GROUPS.items() for v in values] + [("nan", 1.0), ("nan", math.nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    for out in (df.groupBy("k").agg(exact_avg("v").alias("m")),
                spark.sql(f"SELECT k, {exact_avg_sql('v')} AS m FROM {{t}} GROUP BY k", t=df)):
        got = {r.k: r.m for r in out.collect()}
        assert math.isnan(got.pop("nan"))
        assert got == {k: pytest.approx(m, rel=1e-15) if m is not None else None for k, (_, m) in GROUPS.items()}


def _clean(spark):
    return deduplicated_readings(load_fixture_raw(spark, SF)).select(*CLEAN_COLUMNS)


def test_clean_dataset_keeps_names(spark, tmp_path):
    names = F.element_at(F.array(*[F.lit(x) for x in ("", "25", "pm25", "a/b=c", " x ")], F.lit(None)),
                         (F.pmod(F.hash("datetime"), F.lit(6)) + 1).cast("int"))
    clean = _clean(spark).withColumn("pollutant", names)
    back = read_clean(spark, write_clean(clean, str(tmp_path / "clean")))
    assert back.columns == clean.columns and back.schema["pollutant"].dataType.simpleString() == "string"
    key = lambda df: sorted(map(str, df.select(*CLEAN_COLUMNS).collect()))
    assert key(back) == key(clean)


def test_clean_dataset_prunes_and_bounds_files(spark, tmp_path):
    clean = _clean(spark)
    path = write_clean(clean.repartition(40), str(tmp_path / "clean"))
    n_names = clean.select("pollutant").distinct().count()
    assert len(glob.glob(os.path.join(path, "*", "*.parquet"))) <= 2 * n_names
    plan = level_counts(read_clean(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_nanosecond_file_and_nan_on_the_path(spark, tmp_path):
    path = str(tmp_path / "ns.parquet")
    when = pd.to_datetime(["2024-01-01 00:00:00", "2024-01-01 01:00:00"]).astype("datetime64[ns]")
    pd.DataFrame({"datetime": when, "pollutant": ["pm25", "pm25"], "value": [math.nan, 10.0], "year": [2024, 2024],
                  "month": [1, 1]}).to_parquet(path, coerce_timestamps=None, version="2.6")
    assert [str(r[0]) for r in load_raw(spark, path).select("datetime").orderBy("datetime").collect()] == list(map(str, when))
    assert [tuple(r) for r in q1_direct_on_path(spark, path).collect()] == [(2024, 1, 10.0)]


@pytest.mark.parametrize("name", ["batch_stats", "level_counts", "monthly_avg", "pm25_aqi", "daily_peaks", "station_hourly",
                                  "pollutant_avg", "dow_pattern", "monthly_pm25_clean", "batch_size_extremes"])
def test_marts_plan_one_dedup_and_no_medians(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "__med_" not in plan and " Join " not in plan
    per_raw = batch_stats(load_fixture_raw(spark, SF))._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert plan.count("Relation [") == per_raw
