"""Sources and sinks: partition reads (S3a/S3b), SQL on a Parquet path (S7), views (S8), sinks (S4/S5/S12),
feature bundle (S14)."""

import os

from aerolake.operators.clean import clean_data
from aerolake.operators.insights import feature_bundle
from aerolake.plans.benchmark import q1_direct, q1_direct_on_path
from aerolake.plans.catalog import describe, drop_view, register_view
from aerolake.sources import (partition_dataset, read_if_exists, read_partition, read_partitioned, sql_on_parquet,
                              write_feature_bundle, write_outputs, write_parquet)


def test_partition_reads(spark, mock, tmp_out):
    root = os.path.join(tmp_out, "p")
    partition_dataset(mock, root)
    assert read_partition(spark, root, 2024, 1).count() == 5
    assert read_partition(spark, root, 2024, 2).count() == 0
    assert read_partitioned(spark, root).count() == 5
    plan = read_partition(spark, root, 2024, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()


def test_sql_on_parquet_path(spark, mock, tmp_out):
    path = write_parquet(mock, os.path.join(tmp_out, "raw.parquet"))
    direct = sorted(tuple(r) for r in q1_direct_on_path(spark, path).collect())
    framed = sorted(tuple(r) for r in q1_direct(spark, mock).collect())
    assert direct == framed == [(2024, 1, (45.0 - 10.0 + 12.0 + 45.0) / 4)]
    n = sql_on_parquet(spark, "SELECT count(*) AS n FROM {raw}", raw=path).first().n
    assert n == 5


def test_views(spark, mock):
    register_view(mock, "mock_view")
    assert spark.sql("SELECT count(DISTINCT station_id) AS n FROM mock_view").first().n == 2
    assert ("value", "double") in describe(mock)
    assert drop_view(spark, "mock_view")
    assert not spark.catalog.tableExists("mock_view")


def test_sinks_and_bundle(spark, mock, tmp_out):
    clean = clean_data(mock)
    paths = write_outputs({"a": clean.limit(1), "b": clean}, tmp_out)
    assert read_if_exists(spark, paths["b"]).count() == 3
    assert read_if_exists(spark, os.path.join(tmp_out, "absent.parquet")) is None
    out = write_feature_bundle(feature_bundle(clean, hour=0), os.path.join(tmp_out, "bundle"), also_json=True)
    assert spark.read.parquet(out["station_hourly"]).count() == 2  # PM2.5 rows: one per station, hour 0
    assert os.path.isdir(os.path.join(tmp_out, "bundle", "dow_pattern.json"))


def test_hot_month_is_split_into_several_files(spark, tmp_out):
    from pyspark.sql import functions as F
    # 19,000 rows in January (the hot month), 1,000 in February
    rows = spark.range(20000).select(
        F.lit("site_1").alias("station_id"), F.lit("s").alias("state"), F.lit("c").alias("city"),
        F.lit("n").alias("station_name"), F.lit("t").alias("timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("datetime"),
        *[F.lit(None).cast("double").alias(c) for c in ("at_c", "rh_percent", "ws_m_s", "wd_deg", "rf_mm",
                                                        "tot_rf_mm", "sr_w_mt2", "bp_mmhg", "vws_m_s")],
        F.lit("pm25").alias("pollutant"), F.col("id").cast("double").alias("value"), F.lit("n").alias("station"),
        F.lit(2024).alias("year"), F.when(F.col("id") < 19000, F.lit(1)).otherwise(F.lit(2)).alias("month"),
        F.lit(1).alias("day"), F.lit(0).alias("hour")).repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        root = os.path.join(tmp_out, "hot")
        assert partition_dataset(rows, root) == 2
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(os.path.join(root, "year=2024", "month=01")) if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(root).count() == 20000
