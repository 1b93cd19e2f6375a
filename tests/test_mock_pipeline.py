"""The reference's six unit tests on its 5-row mock, with the exact expected values derived in FIXTURES.md."""

import os

from pyspark.sql import functions as F

from aerolake.operators.clean import clean_data, imputation_audit
from aerolake.operators.transform import (batch_stats, daily_peaks, level_counts, monthly_avg, pm25_aqi,
                                          run_etl, sorted_level_counts)
from aerolake.plans.catalog import create_raw_schema, list_tables, setup_served_database, table_exists
from aerolake.sources.partitioned import partition_dataset
from aerolake.sources.report import generate_summary


def test_generate_summary(mock, tmp_out):
    path = os.path.join(tmp_out, "summary.txt")
    text = generate_summary(mock, path)
    assert os.path.exists(path)
    assert "Total records      : 5" in text
    assert "Stations           : 2" in text
    assert "Pollutant species  : 2" in text
    assert "Columns            : 22" in text
    assert "Years              : [2024]" in text
    assert open(path, encoding="utf-8").read() == text


def test_partition_dataset(spark, mock, tmp_out):
    root = os.path.join(tmp_out, "partitions")
    n = partition_dataset(mock, root)
    assert n == 1
    part = os.path.join(root, "year=2024", "month=01")
    assert os.path.isdir(part)
    body = spark.read.parquet(part)
    assert "year" not in body.columns and "month" not in body.columns
    assert body.count() == 5
    back = spark.read.parquet(root)
    assert dict(back.dtypes)["month"] == "int"
    assert back.where("year = 2024 AND month = 1").count() == 5


def test_clean_data(mock):
    cleaned = clean_data(mock)
    for c in ("vws_m_s", "timestamp", "station"):
        assert c not in cleaned.columns
    assert len(cleaned.columns) == 19
    rows = cleaned.collect()
    assert len(rows) == 3
    assert all(r.value >= 0 for r in rows)
    assert cleaned.where(F.col("rh_percent").isNull()).count() == 0
    by = {(r.station_id, r.pollutant): r for r in rows}
    r2, r3 = by[("site_102", "pm25")], by[("site_102", "pm10")]
    assert (r2.at_c, r2.rh_percent, r2.sr_w_mt2) == (14.5, 85.0, 40.0)
    assert (r3.at_c, r3.rh_percent, r3.sr_w_mt2) == (14.5, 85.0, 40.0)
    r0 = by[("site_101", "pm25")]
    assert (r0.at_c, r0.rh_percent, r0.value) == (10.5, 80.0, 45.0)


def test_imputation_audit(mock):
    audit = {r.column_name: (r.missing_before, r.missing_after, r.filled) for r in imputation_audit(mock).collect()}
    assert audit["at_c"] == (1, 0, 1)
    assert audit["rh_percent"] == (1, 0, 1)
    assert audit["sr_w_mt2"] == (1, 0, 1)
    assert audit["total"] == (3, 0, 3)


def test_batch_transformation(mock):
    out = batch_stats(clean_data(mock))
    assert "avg_value" in out.columns
    rows = {r.pollutant: r for r in out.collect()}
    assert len(rows) == 2
    p10, p25 = rows["pm10"], rows["pm25"]
    assert (p10.avg_value, p10.max_value, p10.min_value, p10.reading_count, p10.std_value) == (85.0, 85.0, 85.0, 1, None)
    assert (p25.avg_value, p25.max_value, p25.min_value, p25.reading_count, p25.std_value) == (28.5, 45.0, 12.0, 2, 23.33)
    assert (p25.year, p25.month) == (2024, 1)


def test_map_reduce_classification(mock):
    out = sorted_level_counts(clean_data(mock))
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == 2
    assert rows == [("site_101", "unhealthy", 1), ("site_102", "moderate", 1)]
    assert level_counts(clean_data(mock)).where("station = 'site_101'").first().pollution_level == "unhealthy"


def test_etl_outputs(mock, tmp_out):
    clean = clean_data(mock)
    assert sorted(tuple(r) for r in monthly_avg(clean).collect()) == [(2024, 1, "pm10", 85.0), (2024, 1, "pm25", 28.5)]
    aqi = {r.value: r.aqi_category for r in pm25_aqi(clean).collect()}
    assert aqi == {45.0: "Unhealthy", 12.0: "Moderate"}
    assert pm25_aqi(clean).columns == ["datetime", "station_id", "value", "aqi_category"]
    peaks = sorted(tuple(r) for r in daily_peaks(clean).collect())
    assert peaks == [(2024, 1, 1, "site_101", "pm25", 45.0), (2024, 1, 1, "site_102", "pm10", 85.0),
                     (2024, 1, 1, "site_102", "pm25", 12.0)]
    outs = run_etl(clean, tmp_out)
    for name in ("monthly_avg", "pm25_aqi", "daily_peaks"):
        assert os.path.isdir(os.path.join(tmp_out, f"{name}.parquet"))
    assert set(outs) == {"monthly_avg", "pm25_aqi", "daily_peaks"}


def test_schema_and_served(spark, mock, tmp_out):
    create_raw_schema(spark, "t_raw")
    tables = list_tables(spark, "t_raw")
    for t in ("measurements", "stations", "pollutants"):
        assert t in tables
    assert dict(spark.table("t_raw.measurements").dtypes)["measurement_id"] == "bigint"
    assert dict(spark.table("t_raw.pollutants").dtypes)["pollutant_id"] == "int"

    clean = clean_data(mock)
    run_etl(clean, tmp_out)
    setup_served_database(spark, "t_served", clean, os.path.join(tmp_out, "monthly_avg.parquet"),
                          os.path.join(tmp_out, "daily_peaks.parquet"))
    served = list_tables(spark, "t_served")
    for t in ("measurements_clean", "stations", "pollutants", "monthly_aggregates", "daily_peaks"):
        assert t in served
    assert table_exists(spark, "t_served", "daily_peaks")
    fact = spark.table("t_served.measurements_clean")
    assert sorted(r.measurement_id for r in fact.collect()) == [1, 2, 3]
    assert "vws_m_s" not in fact.columns
    assert dict(spark.table("t_served.pollutants").dtypes)["pollutant_id"] == "bigint"


def test_served_without_preaggregates(spark, mock, tmp_out):
    setup_served_database(spark, "t_served2", clean_data(mock), os.path.join(tmp_out, "missing.parquet"), None)
    served = list_tables(spark, "t_served2")
    assert "monthly_aggregates" not in served and "daily_peaks" not in served
    assert "measurements_clean" in served


def test_ingestion_profile_matches_separate_aggregates(spark):
    from aerolake.operators.profile import rows_per_month, rows_per_pollutant, summary_counts
    from aerolake.sources.fixture import load_fixture_raw
    from aerolake.sources.report import ingestion_profile
    raw = load_fixture_raw(spark, "/root/testdata/sf0.001")
    prof = ingestion_profile(raw)
    s = summary_counts(raw).first().asDict()
    for k in ("total_records", "n_columns", "date_min", "date_max", "years", "stations", "pollutant_species"):
        assert prof["summary"][k] == s[k], k
    assert prof["per_month"] == [(r.year, r.month, r.n_records) for r in rows_per_month(raw).collect()]
    assert prof["per_pollutant"] == [(r.pollutant, r.n_records) for r in rows_per_pollutant(raw).collect()]


def test_summary_layout():
    from aerolake.sources.report import format_summary
    text = format_summary({"total_records": 1234567, "n_columns": 22, "date_min": "a", "date_max": "b",
                           "years": "[2024, 2025]", "stations": 10, "pollutant_species": 2},
                          [(2024, 1, 226196), (2024, 12, 256766), (2025, 1, 253498)],
                          [("pm10", 642383), ("eth_benzene", 124814), ("xylene", 92703)])
    lines = text.splitlines()
    assert "Total records      : 1,234,567" in lines
    i = lines.index("Records per year-month:")
    assert lines[i + 1:i + 5] == ["year  month", "2024  1        226196", "      12       256766",
                                  "2025  1        253498"]
    j = lines.index("Records per pollutant:")
    assert lines[j + 1:j + 5] == ["pollutant", "pm10           642383", "eth_benzene    124814",
                                  "xylene          92703"]
