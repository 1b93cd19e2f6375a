"""Scans, sinks and the text report."""

from aerolake.sources.parquet import load_raw, read_partition, read_partitioned, sql_on_parquet, nan_to_null
from aerolake.sources.partitioned import partition_dataset
from aerolake.sources.sinks import (write_parquet, write_outputs, read_if_exists, write_feature_bundle,
                                    write_clean, read_clean)
from aerolake.sources.report import generate_summary, format_summary
from aerolake.sources.fixture import load_fixture_raw, raw_from_events

__all__ = ["load_raw", "read_partition", "read_partitioned", "sql_on_parquet", "nan_to_null",
           "partition_dataset", "write_parquet", "write_clean", "read_clean", "write_outputs", "read_if_exists", "write_feature_bundle",
           "generate_summary", "format_summary", "load_fixture_raw", "raw_from_events"]
