"""V2: the whole pipeline on a raw Parquet file derived from the sf0.001 events."""

import os

from aerolake.plans.catalog import list_tables
from aerolake.plans.pipeline import run_pipeline
from aerolake.sources.fixture import load_fixture_raw

from raw_rows import SF_SMALL


def test_run_pipeline(spark, tmp_out):
    src = os.path.join(tmp_out, "raw.parquet")
    load_fixture_raw(spark, SF_SMALL).write.parquet(src)
    res = run_pipeline(spark, src, os.path.join(tmp_out, "out"), raw_db="p_raw", served_db="p_served")
    sizes = res["sizes"]
    assert sizes["partitions"] == 24
    assert sizes["q1_avg_pm25_per_month"] == 24 and sizes["q2_top3_pm10"] == 3
    assert sizes["q3_count_per_pollutant"] == 5
    assert sizes["batch_stats"] == 120 and sizes["level_counts"] == 48
    assert sizes["etl.pm25_aqi"] == 208 and sizes["etl.daily_peaks"] == 983
    assert sizes["served.measurements_clean"] == 990
    assert set(list_tables(spark, "p_raw")) == {"measurements", "pollutants", "stations"}
    assert spark.table("p_raw.measurements").select("measurement_id").distinct().count() == 1012
    text = open(os.path.join(tmp_out, "out", "ingestion_summary.txt"), encoding="utf-8").read()
    assert "Total records      : 1,012" in text and "Stations           : 10" in text
    assert res["timings"]["total"] > 0


def test_cli_missing_input_exits_1(spark, tmp_out):
    from aerolake.plans.pipeline import main
    assert main([os.path.join(tmp_out, "missing.parquet"), os.path.join(tmp_out, "o")]) == 1
