"""Query registry: one Spark callable per operator key, each taking (spark, sf_dir).

Every query starts from the sf directory's ``events`` table mapped to raw sensor rows (see
``sources.fixture``) and runs the library operators on the whole table. ``oracle.build()`` holds the
matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import clean as C
from aerolake.operators import insights as I
from aerolake.operators import profile as P
from aerolake.operators import star as S
from aerolake.operators import transform as T
from aerolake.plans import benchmark as B
from aerolake.plans.oracle import LOOKBACK, MAX_GAP, ONE_PARTITION, STATION_RANK_HOUR
from aerolake.session import checkpoint_root, scratch_path
from aerolake.sources.fixture import load_fixture_raw
from aerolake.sources.partitioned import partition_dataset


def _prep(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return load_fixture_raw(spark, sf_dir)


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_data(raw_rows(spark, sf_dir))


def reading_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows without filled weather, for marts that read no weather column."""
    return C.deduplicated_readings(raw_rows(spark, sf_dir))


def _raw_star(spark, sf):
    raw = raw_rows(spark, sf)
    return S.build_raw_star(raw)


def _serving(spark, sf):
    return S.build_serving_star(clean_rows(spark, sf))


def _q_monthly_pm25_star(spark, sf):
    st = _raw_star(spark, sf)
    return B.q1_avg_pm25_per_month(spark, st["measurements"], st["pollutants"])


def _q_top3_pm10(spark, sf):
    st = _raw_star(spark, sf)
    return B.q2_top3_pm10(spark, st["measurements"], st["pollutants"], st["stations"])


def _q_count_per_pollutant(spark, sf):
    st = _raw_star(spark, sf)
    return B.q3_count_per_pollutant(spark, st["measurements"], st["pollutants"])


def _q_daily_peak_no2(spark, sf):
    st = _raw_star(spark, sf)
    return B.q4_daily_peak_no2(spark, st["measurements"], st["pollutants"], st["stations"])


def _q_served_monthly(spark, sf):
    st = _serving(spark, sf)
    return B.served_monthly_pm25(spark, st["measurements_clean"], st["pollutants"])


def _q_served_top3(spark, sf):
    st = _serving(spark, sf)
    return B.served_top3_pm25(spark, st["measurements_clean"], st["pollutants"], st["stations"])


def _q_partition_roundtrip(spark, sf):
    raw = raw_rows(spark, sf)
    root = scratch_path(spark, "partitioned")
    partition_dataset(raw, root)
    back = spark.read.parquet(root)
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def _q_quality(spark, sf):
    raw = raw_rows(spark, sf)
    return P.quality_before_after(raw, C.clean_data(raw))


def _q_lookback(spark, sf):
    """Sequences of consecutive hours over the gap-free grid, where every hour has a reading of at most a day ago."""
    grid = I.gap_filled(I.hourly_series(reading_rows(spark, sf)), MAX_GAP)
    seqs = I.lookback_sequences(grid, LOOKBACK, require_contiguous=True).where(F.forall("seq", lambda x: x.isNotNull()))
    return seqs.select("station_id", "hour_ts", F.posexplode("seq").alias("step", "value_scaled")) \
               .select("station_id", "hour_ts", F.col("step").cast("int").alias("step"), "value_scaled")


def _q_lookback_obs(spark, sf):
    seqs = I.lookback_sequences(I.hourly_series(reading_rows(spark, sf)), LOOKBACK, require_contiguous=False)
    return seqs.select("station_id", "hour_ts", F.posexplode("seq").alias("step", "value_scaled")) \
               .select("station_id", "hour_ts", F.col("step").cast("int").alias("step"), "value_scaled")


def _profile(spark, sf):
    return I.station_hourly(reading_rows(spark, sf))


def _q_station_slice(spark, sf):
    prof = _profile(spark, sf)
    return I.station_slice(prof, prof.select(F.min("station_id")).scalar())


def _q_medians(spark, sf):
    base = C.remove_duplicates(C.remove_negative(C.drop_redundant(raw_rows(spark, sf))))
    med = C.group_medians(base)
    return med.select("station_id", "month", *[F.col(f"__med_{c}").alias(c) for c in C.WEATHER_COLUMNS])


def _q_medians_narrowed(spark, sf):
    """A27 with the split per group; the limit is low, so that groups of the given tables are really narrowed."""
    med = C.narrowed_medians(C.deduplicated_readings(raw_rows(spark, sf)), C.WEATHER_COLUMNS, ranked_at_most=100)
    return med.select("station_id", "month", *[F.col(f"__med_{c}").alias(c) for c in C.WEATHER_COLUMNS])


def _q_streaming_batch_stats(spark, sf):
    """A10 computed incrementally: partition the clean rows by month, stream the month files one per
    micro-batch through the stateful aggregation, read the final snapshot."""
    from aerolake.streaming import run_incremental
    root = scratch_path(spark, "stream-src")
    partition_dataset(reading_rows(spark, sf), root)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    run_incremental(spark, root, T.batch_stats, out, ckpt, files_per_trigger=4)
    return spark.read.parquet(out)


# Keys that run the load path: files are written to the shared scratch folder and read back by the library's own readers.
def _raw_file(spark, sf):
    """The raw rows as a Parquet file whose missing values are NaN, as pandas writes them."""
    raw, path = raw_rows(spark, sf), scratch_path(spark, "raw")
    doubles = [f.name for f in raw.schema.fields if f.dataType.typeName() == "double"]
    raw.withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c in doubles}).write.parquet(path)
    return path


def _database(spark, kind):
    from aerolake.plans.catalog import create_database
    path = scratch_path(spark, kind)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, path)
    return name


def _loaded_raw_db(spark, sf):
    from aerolake.plans.catalog import create_raw_schema, load_raw_data
    db = _database(spark, "loaded-raw")
    create_raw_schema(spark, db)
    load_raw_data(spark, db, _raw_file(spark, sf), id_order="columns")
    return db


def _q_loaded_raw_star(spark, sf):
    table = spark.table(f"{_loaded_raw_db(spark, sf)}.measurements")
    return table.select("measurement_id", *[c for c in table.columns if c != "measurement_id"])


def _q_loaded_table_counts(spark, sf):
    from aerolake.plans.catalog import list_tables
    db, out = _loaded_raw_db(spark, sf), None
    for t in list_tables(spark, db):
        n = spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


def _served_db(spark, sf):
    from aerolake.plans.catalog import setup_served_database
    from aerolake.sources.sinks import read_clean, write_clean, write_outputs
    clean = read_clean(spark, write_clean(clean_rows(spark, sf), scratch_path(spark, "clean")))
    paths = write_outputs({"monthly_avg": T.monthly_avg(clean)}, scratch_path(spark, "etl"))
    db = _database(spark, "loaded-served")
    setup_served_database(spark, db, clean, paths["monthly_avg"], f"{paths['monthly_avg']}.absent", id_order="columns",
                          stable_input=True)
    return db


def _q_report(spark, sf):
    """The report's numbers as it prints them, one row per line of its three parts."""
    from aerolake.sources.report import ingestion_profile
    prof = ingestion_profile(raw_rows(spark, sf))
    rows = [("summary", k, str(v)) for k, v in prof["summary"].items()]
    rows += [("per_month", f"{y}-{m:02d}", str(n)) for y, m, n in prof["per_month"]]
    rows += [("per_pollutant", p, str(n)) for p, n in prof["per_pollutant"]]
    return spark.createDataFrame(rows, "part string, item string, shown string")


def _q_sql_on_path(spark, sf):
    from aerolake.sources.parquet import sql_on_parquet
    return sql_on_parquet(spark, "SELECT pollutant, count(*) AS n, count(value) AS n_values, max(value) AS highest, "
                                 "count(vws_m_s) AS n_wind FROM {t} WHERE month < 7 GROUP BY pollutant", t=_raw_file(spark, sf))


def _q_one_partition(spark, sf):
    from aerolake.sources.parquet import read_partition
    root = scratch_path(spark, "partitioned")
    partition_dataset(raw_rows(spark, sf), root)
    return read_partition(spark, root, *ONE_PARTITION).groupBy("year", "month", "pollutant").agg(F.count(F.lit(1)).alias("n"))


def _q_monthly_reload(spark, sf):
    """The batch mart after the months of one year arrive in one load, all other months in a second, and that second once
    more."""
    from aerolake.sources.partitioned import replace_months
    from aerolake.streaming import refresh_months
    rows = spark.read.parquet(_written(spark, reading_rows(spark, sf)))
    root, mart = scratch_path(spark, "months"), scratch_path(spark, "mart")
    first = F.col("year") == ONE_PARTITION[0]
    for load in (rows.where(first), rows.where(~first), rows.where(~first)):
        refresh_months(spark, root, T.batch_stats, mart, replace_months(load, root))
    return spark.read.parquet(mart)


def _q_streamed_months(spark, sf):
    """The batch mart kept by a stream over the month files: one year's months, then the others, then some months again."""
    from aerolake.sources.partitioned import replace_months
    from aerolake.streaming import run_monthly
    rows = spark.read.parquet(_written(spark, reading_rows(spark, sf)))
    root, mart, ckpt = (scratch_path(spark, n) for n in ("months", "mart", "months-ckpt"))
    first = F.col("year") == ONE_PARTITION[0]
    for load in (rows.where(first), rows.where(~first), rows.where(F.col("month") == ONE_PARTITION[1])):
        replace_months(load, root)
        run_monthly(spark, root, T.batch_stats, mart, ckpt)
    return spark.read.parquet(mart)


def _written(spark, df):
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    return path


def _q_written_clean(spark, sf):
    from aerolake.sources.sinks import read_clean, write_clean
    return read_clean(spark, write_clean(clean_rows(spark, sf), scratch_path(spark, "clean")))


def _q_bundle_mae(spark, sf):
    from aerolake.sources.sinks import write_feature_bundle
    paths = write_feature_bundle(I.feature_bundle(reading_rows(spark, sf), STATION_RANK_HOUR), scratch_path(spark, "bundle"))
    return spark.read.parquet(paths["mae"])


def _q_ordered_levels(spark, sf):
    """The sorted report table with the place of each row in its order (stations times levels, a small report)."""
    rows = T.sorted_level_counts(reading_rows(spark, sf)).collect()
    return spark.createDataFrame([(k + 1, *r) for k, r in enumerate(rows)],
                                 "place int, station string, pollution_level string, count long")


def _q_parsed_timestamps(spark, sf):
    from aerolake.functions import parse_timestamp
    raw = raw_rows(spark, sf).select("datetime", parse_timestamp("timestamp").alias("parsed"))
    return raw.groupBy(F.to_date("parsed").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("parsed") == F.col("datetime")).alias("n_equal"))


def _series(spark, sf):
    return I.hourly_series(reading_rows(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # benchmark queries (C4: A14-A17) and S7
        "monthly_pm25_direct": lambda s, d: B.q1_direct(s, raw_rows(s, d)),
        "monthly_pm25_star": _q_monthly_pm25_star,
        "top3_pm10": _q_top3_pm10,
        "count_per_pollutant": _q_count_per_pollutant,
        "daily_peak_no2": _q_daily_peak_no2,
        # cleaning (C1) and its audit
        "clean": clean_rows,
        "clean_imputation_audit": lambda s, d: C.imputation_audit(raw_rows(s, d)),
        # marts (A10-A13, C2)
        "batch_stats": lambda s, d: T.batch_stats(reading_rows(s, d)),
        "level_counts": lambda s, d: T.level_counts(reading_rows(s, d)),
        "streaming_batch_stats": _q_streaming_batch_stats,
        "monthly_avg": lambda s, d: T.monthly_avg(reading_rows(s, d)),
        "pm25_aqi": lambda s, d: T.pm25_aqi(reading_rows(s, d)),
        "daily_peaks": lambda s, d: T.daily_peaks(reading_rows(s, d)),
        # star schema (D1, D2, W1, W2, J1) and serving
        "dim_stations": lambda s, d: S.stations_dim(raw_rows(s, d)),
        "dim_pollutants": lambda s, d: S.pollutants_dim(raw_rows(s, d)),
        "fact_raw": lambda s, d: _raw_star(s, d)["measurements"],
        "fact_clean": lambda s, d: _serving(s, d)["measurements_clean"],
        "served_monthly_pm25": _q_served_monthly,
        "served_top3_pm25": _q_served_top3,
        "served_preagg_slice": lambda s, d: B.served_preagg_slice(s, T.monthly_avg(reading_rows(s, d))),
        "monthly_pm25_clean": lambda s, d: B.monthly_pm25_clean(s, reading_rows(s, d)),
        # profiling
        "summary_counts": lambda s, d: P.summary_counts(raw_rows(s, d)),
        "rows_per_year": lambda s, d: P.rows_per_year(raw_rows(s, d)),
        "rows_per_month": lambda s, d: P.rows_per_month(raw_rows(s, d)),
        "rows_per_pollutant": lambda s, d: P.rows_per_pollutant(raw_rows(s, d)),
        "missing_profile": lambda s, d: P.missing_profile(raw_rows(s, d)),
        "completeness": lambda s, d: P.completeness(raw_rows(s, d)),
        "quality_before_after": _q_quality,
        "value_describe": lambda s, d: P.value_describe(raw_rows(s, d)),
        "negative_audit": lambda s, d: P.negative_audit(raw_rows(s, d)),
        "duplicate_audit": lambda s, d: P.duplicate_audit(raw_rows(s, d)),
        "duplicate_rows": lambda s, d: P.duplicate_rows(raw_rows(s, d)),
        "dirty_sample": lambda s, d: P.dirty_sample(raw_rows(s, d)),
        "distinct_values": lambda s, d: P.distinct_values(raw_rows(s, d)),
        "month_extremes_who": lambda s, d: P.month_extremes_who(raw_rows(s, d)),
        "batch_size_extremes": lambda s, d: P.batch_size_extremes(reading_rows(s, d)),
        "distinct_counts": lambda s, d: P.distinct_counts(raw_rows(s, d)),
        "ordered_level_counts": _q_ordered_levels,
        # the load path (S1, S3a, S4-S13, O5-O7) and D3 by fingerprints
        "loaded_raw_star": _q_loaded_raw_star,
        "loaded_table_counts": _q_loaded_table_counts,
        "loaded_serving_star": lambda s, d: s.table(f"{_served_db(s, d)}.measurements_clean"),
        "loaded_monthly_aggregates": lambda s, d: s.table(f"{_served_db(s, d)}.monthly_aggregates"),
        "ingestion_report": _q_report,
        "sql_on_path": _q_sql_on_path,
        "one_partition": _q_one_partition,
        "written_clean": _q_written_clean,
        "monthly_reload": _q_monthly_reload,
        "streamed_months": _q_streamed_months,
        "feature_bundle_mae": _q_bundle_mae,
        "parsed_timestamps": _q_parsed_timestamps,
        "clean_by_fingerprint": lambda s, d: C.clean_data(raw_rows(s, d), by_fingerprint=True),
        # sources (S2, S3)
        "partition_roundtrip": _q_partition_roundtrip,
        # dashboard marts and forecasting
        "station_hourly": _profile,
        "pollutant_avg": lambda s, d: I.pollutant_avg(reading_rows(s, d)),
        "dow_pattern": lambda s, d: I.dow_pattern(reading_rows(s, d)),
        "station_rank": lambda s, d: I.station_rank(_profile(s, d), hour=STATION_RANK_HOUR),
        "station_means": lambda s, d: I.station_means(_profile(s, d)),
        "station_slice": _q_station_slice,
        "station_month_medians": _q_medians,
        "station_month_medians_narrowed": _q_medians_narrowed,
        "station_best_worst_hour": lambda s, d: I.station_best_worst_hour(_profile(s, d)),
        "display_levels": lambda s, d: I.display_levels(_profile(s, d)),
        "scaler_params": lambda s, d: I.scaler_params(_series(s, d)),
        "lookback_sequences": _q_lookback,
        "lookback_observations": _q_lookback_obs,
        "seasonal_forecast": lambda s, d: I.seasonal_forecast(_series(s, d)),
        "forecast_mae": lambda s, d: I.forecast_mae(I.seasonal_forecast(_series(s, d))),
        "forecast_best_worst_step": lambda s, d: I.forecast_best_worst_step(_series(s, d)),
    }
    return q


def oracle_sql() -> dict[str, str]:
    from aerolake.plans.oracle import build
    return build()
