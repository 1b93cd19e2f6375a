"""Loads and sinks that must not lose rows or hide errors."""

import pytest
from pyspark.sql import functions as F

from aerolake.operators import star
from aerolake.session import scale_conf
from aerolake.sources.partitioned import partition_dataset
from aerolake.sources.sinks import read_if_exists
from raw_rows import make_raw


def test_scan_order_ids_without_broadcast(spark, tmp_out, monkeypatch):
    """Above the broadcast limit the pollutant join shuffles; every row still gets its own id."""
    monkeypatch.setattr(star, "BROADCAST_MAX_ROWS", 1)
    raw = make_raw(spark, [{"pollutant": f"p{i}", "value": float(i)} for i in range(40)])
    raw = raw.crossJoin(F.broadcast(spark.range(50))).drop("id").repartition(7)
    raw.write.parquet(f"{tmp_out}/raw")
    raw = spark.read.parquet(f"{tmp_out}/raw")
    fact = star.build_fact(raw, star.pollutants_dim(raw, "int"), id_order="input", stable_input=True)
    n, distinct, low, high = fact.agg(F.count("*"), F.countDistinct("measurement_id"), F.min("measurement_id"),
                                      F.max("measurement_id")).first()
    assert (n, distinct, low, high) == (2000, 2000, 1, 2000)


def test_only_a_missing_path_counts_as_absent(spark, tmp_out):
    assert read_if_exists(spark, f"{tmp_out}/nothing") is None
    (__import__("pathlib").Path(tmp_out) / "empty").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        read_if_exists(spark, f"{tmp_out}/empty")


def test_partition_count_comes_from_spark(spark, tmp_out, mock):
    assert partition_dataset(mock, f"{tmp_out}/parts") == 1
    assert partition_dataset(mock.where("false"), f"{tmp_out}/none") == 0


def test_shuffle_partitions_grow_without_cap():
    assert int(scale_conf(100 * 10**12, 8000)["spark.sql.shuffle.partitions"]) > 400_000
