"""V2: the end-to-end batch pipeline, four ordered steps.

1. ingest: scan raw Parquet, write the summary report, hive-partition the rows;
2. raw star: DDL, load with validated keys, run Q1-Q4;
3. clean + transform: clean once, write it, read it back (lineage cut: every later job scans Parquet
   instead of re-running the dedup shuffle), batch statistics, level counts, the three ETL marts;
4. serving tables from the written clean data and marts.

Returns per-step wall-clock seconds and result sizes. Any failure propagates after being logged.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import SparkSession

from aerolake.operators.clean import clean_data
from aerolake.operators.transform import batch_stats, level_counts, run_etl
from aerolake.plans.benchmark import run_benchmark_queries
from aerolake.plans.catalog import create_raw_schema, load_raw_data, setup_served_database, table_counts
from aerolake.sources.parquet import load_raw
from aerolake.sources.partitioned import partition_dataset
from aerolake.sources.report import generate_summary
from aerolake.sources.sinks import read_clean, write_clean

log = logging.getLogger("aerolake.pipeline")


def run_pipeline(spark: SparkSession, input_path: str, output_dir: str, raw_db: str = "air_quality",
                 served_db: str = "air_quality_served", summary_path: str | None = None) -> dict:
    out = output_dir.rstrip("/")
    timings, sizes = {}, {}
    t_all = time.time()
    try:
        t = time.time()
        raw = load_raw(spark, input_path)
        generate_summary(raw, summary_path or f"{out}/ingestion_summary.txt")
        sizes["partitions"] = partition_dataset(raw, f"{out}/partitioned_data")
        timings["ingest"] = time.time() - t

        t = time.time()
        create_raw_schema(spark, raw_db)
        load_raw_data(spark, raw_db, input_path)
        timings["raw_load"] = time.time() - t
        for name, df in run_benchmark_queries(spark, raw_db).items():
            t = time.time()
            sizes[name] = len(df.collect())
            timings[name] = time.time() - t

        t = time.time()
        clean_path = f"{out}/clean.parquet"
        # Median-table bound from the stored stations dimension: at most stations x 12 station-months.
        bound = spark.table(f"`{raw_db}`.`stations`").count() * 12
        write_clean(clean_data(raw, median_rows_bound=bound), clean_path)
        clean = read_clean(spark, clean_path)
        sizes["batch_stats"] = batch_stats(clean).count()
        sizes["level_counts"] = level_counts(clean).count()
        etl = run_etl(clean, f"{out}/transformed")
        timings["clean_transform"] = time.time() - t

        t = time.time()
        setup_served_database(spark, served_db, clean, f"{out}/transformed/monthly_avg.parquet",
                              f"{out}/transformed/daily_peaks.parquet", stable_input=True)
        sizes.update({f"served.{k}": v for k, v in table_counts(spark, served_db).items()})
        timings["serve"] = time.time() - t
        sizes.update({f"etl.{k}": spark.read.parquet(f"{out}/transformed/{k}.parquet").count() for k in etl})
    except Exception:
        log.exception("Pipeline execution failed")
        raise
    timings["total"] = time.time() - t_all
    return {"timings": timings, "sizes": sizes}


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m aerolake.plans.pipeline <raw parquet> <output dir> [raw_db] [served_db]``.
    Exit code 0 on success, 1 when the input is missing or a step fails (the error is logged)."""
    import argparse
    import json

    from aerolake.session import get_session

    ap = argparse.ArgumentParser(prog="aerolake.plans.pipeline")
    ap.add_argument("input_path")
    ap.add_argument("output_dir")
    ap.add_argument("raw_db", nargs="?", default="air_quality")
    ap.add_argument("served_db", nargs="?", default="air_quality_served")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(name)s: %(message)s")
    spark = get_session()
    try:
        result = run_pipeline(spark, args.input_path, args.output_dir, args.raw_db, args.served_db)
    except FileNotFoundError as err:
        log.error("Source file not found: %s", err)
        return 1
    except Exception:  # already logged with traceback by run_pipeline
        return 1
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
