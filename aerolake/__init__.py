"""aerolake — Spark-native analytics for long-format environmental sensor readings.

One row per (timestamp, station, pollutant) with weather readings repeated on each row. The library
profiles and hive-partitions raw Parquet, cleans and imputes it, models it as a star schema, builds
marts and answers the benchmark / serving / dashboard queries — all as Spark DataFrame or SQL jobs.

Subpackages:

* ``sources``   — Parquet scan, hive-partitioned write/read, sinks, text report, test fixture
* ``functions`` — column expressions (rounding, level ladders, labels, scaling)
* ``operators`` — cleaning, transforms, profiling, star schema, dashboard insights
* ``plans``     — catalog tables, benchmark/serving SQL, the end-to-end pipeline, the query registry
* ``streaming`` — month-at-a-time incremental batch statistics over the partitioned layout
"""

from aerolake.session import checkpoint_root, get_session, run_concurrently, scale_conf, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path", "scale_conf", "run_concurrently"]
