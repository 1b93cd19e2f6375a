"""Invariants on the events-derived fixture (sf0.001): cleaning idempotence, level counts cover every PM2.5
row, dense ids, partition round trip, imputation only fills NULLs."""

import os

from pyspark.sql import functions as F

from aerolake.operators.clean import clean_data
from aerolake.operators.star import build_serving_star
from aerolake.operators.transform import level_counts
from aerolake.sources.fixture import load_fixture_raw
from aerolake.sources.partitioned import partition_dataset

from raw_rows import SF_SMALL


def test_fixture_shape(spark):
    raw = load_fixture_raw(spark, SF_SMALL)
    assert len(raw.columns) == 22
    assert raw.count() == 1012 and raw.distinct().count() == 1000


def test_clean_is_idempotent_on_rows(spark):
    c1 = clean_data(load_fixture_raw(spark, SF_SMALL))
    n1 = c1.count()
    assert n1 == 990
    assert clean_data(c1).count() == n1


def test_imputation_only_fills_nulls(spark):
    raw = load_fixture_raw(spark, SF_SMALL)
    base = raw.drop("vws_m_s", "timestamp", "station").where("value IS NULL OR value >= 0").distinct()
    clean = clean_data(raw)
    key = [c for c in base.columns if c not in
           ("at_c", "rh_percent", "ws_m_s", "wd_deg", "rf_mm", "tot_rf_mm", "sr_w_mt2", "bp_mmhg")]
    j = base.alias("b").join(clean.alias("c"), key)
    changed = j.where(F.col("b.at_c").isNotNull() & (F.col("b.at_c") != F.col("c.at_c"))).count()
    assert changed == 0
    assert clean.where("at_c IS NULL").count() == 11


def test_level_counts_cover_pm25(spark):
    clean = clean_data(load_fixture_raw(spark, SF_SMALL))
    total = level_counts(clean).agg(F.sum("count")).first()[0]
    assert total == clean.where("pollutant = 'pm25'").count() == 208


def test_serving_fact_ids_dense(spark):
    fact = build_serving_star(clean_data(load_fixture_raw(spark, SF_SMALL)))["measurements_clean"]
    s = fact.agg(F.min("measurement_id"), F.max("measurement_id"), F.countDistinct("measurement_id")).first()
    assert tuple(s) == (1, 990, 990)


def test_partition_round_trip(spark, tmp_out):
    raw = load_fixture_raw(spark, SF_SMALL)
    root = os.path.join(tmp_out, "p")
    assert partition_dataset(raw, root) == 24
    back = spark.read.parquet(root)
    assert back.count() == raw.count()
    assert sorted(os.listdir(os.path.join(root, "year=2024")))[0] == "month=01"
