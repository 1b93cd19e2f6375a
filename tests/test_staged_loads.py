"""Staged loads, fingerprint de-duplication, the gap-free grid, one-scan distincts, SQL on a path."""

import datetime as dt
import glob
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from raw_rows import SF_SMALL, make_raw

from aerolake.operators import clean as C
from aerolake.operators import insights as I
from aerolake.operators import profile as P
from aerolake.operators.star import KeyViolation
from aerolake.plans import catalog
from aerolake.session import scratch_path
from aerolake.sources.fixture import load_fixture_raw
from aerolake.operators.transform import batch_stats
from aerolake.sources.parquet import sql_on_parquet
from aerolake.sources.partitioned import replace_months
from aerolake.streaming import refresh_months


def _file(spark, rows):
    path = scratch_path(spark, "rows")
    make_raw(spark, rows).write.parquet(path)
    return path


def _database(spark, tmp_out, name):
    catalog.create_database(spark, name, f"{tmp_out}/{name}")
    catalog.create_raw_schema(spark, name)
    return name


GOOD = [{"station_id": f"s{k % 3}", "pollutant": p, "value": float(k)} for k in range(12) for p in ("pm25", "no2")]


def test_violation_leaves_the_old_star(spark, tmp_out):
    db = _database(spark, tmp_out, "staged_db")
    catalog.load_raw_data(spark, db, _file(spark, GOOD))
    before = catalog.table_counts(spark, db)
    assert before == {"measurements": 24, "pollutants": 2, "stations": 3}
    bad = [*GOOD[:4], {"station_id": "s0", "city": "Elsewhere"}]
    with pytest.raises(KeyViolation):
        catalog.load_raw_data(spark, db, _file(spark, bad))
    assert catalog.table_counts(spark, db) == before  # and no staged table is left
    with pytest.raises(FileNotFoundError):
        catalog.load_raw_data(spark, db, f"{tmp_out}/absent")
    assert catalog.table_counts(spark, db) == before


def test_reload_replaces_and_purge_removes_old_files(spark, tmp_out):
    db = _database(spark, tmp_out, "reload_db")
    catalog.load_raw_data(spark, db, _file(spark, GOOD))
    reader = spark.table(f"{db}.measurements")  # made before the reload: finds the whole new version
    assert reader.count() == 24
    catalog.load_raw_data(spark, db, _file(spark, GOOD[:6]))
    assert reader.count() == 6
    assert catalog.table_counts(spark, db) == {"measurements": 6, "pollutants": 2, "stations": 3}
    assert len(catalog.purge_replaced(spark, db)) == 3 and not catalog.purge_replaced(spark, db)
    assert catalog.table_counts(spark, db)["measurements"] == 6
    again = spark.sql(f"SELECT count(*) FROM {db}.measurements m JOIN {db}.pollutants p USING (pollutant_id) "
                      "WHERE pollutant_name = 'no2'").first()[0]
    assert again == 3


def test_failed_rename_puts_the_old_tables_back(spark, tmp_out):
    db = _database(spark, tmp_out, "rename_db")
    catalog.load_raw_data(spark, db, _file(spark, GOOD))
    spark.sql(f"CREATE TABLE {db}.stations__staged (station_id STRING) USING parquet LOCATION '{tmp_out}/new-stations'")
    with pytest.raises(Exception):
        catalog.publish(spark, db, ["stations", "pollutants"])  # the second has no staged table
    assert {t for t in catalog.list_tables(spark, db) if "__" not in t} == {"measurements", "pollutants", "stations"}
    assert spark.table(f"{db}.stations").count() == 3 and spark.table(f"{db}.pollutants").count() == 2


def test_serving_reload_drops_absent_preaggregates(spark, tmp_out, mock):
    clean = C.clean_data(mock)
    mock.groupBy("year", "month").count().write.parquet(f"{tmp_out}/monthly.parquet")
    args = dict(location=f"{tmp_out}/serve_db")
    catalog.setup_served_database(spark, "serve_db", clean, f"{tmp_out}/monthly.parquet", **args)
    assert "monthly_aggregates" in catalog.list_tables(spark, "serve_db")
    catalog.setup_served_database(spark, "serve_db", clean, f"{tmp_out}/none.parquet", **args)
    assert catalog.list_tables(spark, "serve_db") == ["measurements_clean", "pollutants", "stations"]


def _as_set(df):
    return sorted(map(str, df.collect()))


def test_fingerprint_dedup_equals_plain(spark, tmp_out):
    rows = [(1, math.nan, 0.0), (1, math.nan, -0.0), (2, None, 1.0), (2, None, 1.0), (3, 1.0, 1.0), (4, 2.0, 1.0)]
    df = spark.createDataFrame(rows + [(9, 9.0, 9.0)] * 3000, "k int, a double, b double").repartition(5)
    df.write.parquet(f"{tmp_out}/rows")
    df = spark.read.parquet(f"{tmp_out}/rows")
    plain = _as_set(C.remove_duplicates(df).withColumn("b", F.col("b") + 0.0))
    for held in (2_000_000, 3, 2):  # 2: more fingerprints than allowed, the plain form
        got = C.remove_duplicates_by_fingerprint(df, held)
        assert _as_set(got.withColumn("b", F.col("b") + 0.0)) == plain
    assert _as_set(C.remove_duplicates_by_fingerprint(df.where("k in (3, 4)"))) == _as_set(df.where("k in (3, 4)"))
    assert C.remove_duplicates_by_fingerprint(df.where("false")).count() == 0


def test_fingerprint_dedup_shuffles_copies_only(spark):
    raw = load_fixture_raw(spark, SF_SMALL)
    out = C.remove_duplicates_by_fingerprint(raw)
    shown = out._jdf.queryExecution().executedPlan().toString()
    alone, rest = shown.split("LeftAnti", 1)
    assert "Exchange hashpartitioning" not in alone and "LeftSemi" in rest  # rows without a copy meet no exchange
    assert out.count() == raw.distinct().count()


def test_gap_free_grid(spark):
    hour = lambda h: dt.datetime(2024, 2, 28, 22) + dt.timedelta(hours=h)
    rows = [("a", hour(0), 1.0), ("a", hour(1), None), ("a", hour(4), 5.0), ("b", hour(30), 7.0)]
    series = spark.createDataFrame(rows, "station_id string, hour_ts timestamp_ntz, pm25 double")
    got = [(r.station_id, r.hour_ts, r.pm25, r.is_gap) for r in I.gap_filled(series, 2).orderBy("station_id", "hour_ts").collect()]
    assert got == [("a", hour(0), 1.0, False), ("a", hour(1), 1.0, True), ("a", hour(2), 1.0, True), ("a", hour(3), None, True),
                   ("a", hour(4), 5.0, False), ("b", hour(30), 7.0, False)]
    assert I.gap_filled(series.where("false"), 2).count() == 0
    assert I.lookback_sequences(I.gap_filled(series, 2), 3).count() == 3


def test_distincts_read_once_and_do_not_expand_rows(spark):
    raw = load_fixture_raw(spark, SF_SMALL)
    for frame in (P.distinct_counts(raw), P.summary_counts(raw)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == raw._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
        if "Expand" in plan:  # below every expansion the rows have been grouped
            assert "Aggregate" in plan.split("Expand", 1)[1]
    total = raw.count()
    got = P.distinct_counts(raw, ["month", "pollutant"]).groupBy("column_name").agg(F.sum("n_rows").alias("n")).collect()
    assert {r.column_name: r.n for r in got} == {"month": total, "pollutant": raw.where("pollutant is not null").count()}


def test_sql_on_a_path_has_the_null_model_and_prunes(spark, tmp_out):
    when = pd.to_datetime(["2024-01-01 00:00:00", "2024-01-01 01:00:00"]).astype("datetime64[ns]")
    pd.DataFrame({"datetime": when, "pollutant": ["pm25", "no2"], "value": [math.nan, 10.0], "unused": [1, 2]}) \
        .to_parquet(f"{tmp_out}/ns.parquet", coerce_timestamps=None, version="2.6")
    out = sql_on_parquet(spark, "SELECT pollutant, count(value) AS n, max(hour(datetime)) AS h FROM {t} "
                                "WHERE pollutant <> 'x' GROUP BY pollutant ORDER BY pollutant", t=f"{tmp_out}/ns.parquet")
    assert [tuple(r) for r in out.collect()] == [("no2", 1, 1), ("pm25", 0, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan.split("ReadSchema")[1] and "PushedFilters: [IsNotNull(pollutant)" in plan
    assert glob.glob(f"{tmp_out}/ns.parquet")


def test_a_month_loaded_twice_equals_once(spark, tmp_out):
    rows = [{"month": m, "value": float(v), "pollutant": p} for m in (1, 2) for v in range(3) for p in ("pm25", "no2")]
    path = _file(spark, [*rows, {"month": None}])
    raw = spark.read.parquet(path)
    root, mart = f"{tmp_out}/months", f"{tmp_out}/mart"
    refresh_months(spark, root, batch_stats, mart, replace_months(raw, root))
    files = set(glob.glob(f"{root}/*/month=01/*.parquet") + glob.glob(f"{mart}/*/month=1/*.parquet"))
    february = raw.where("month = 2")
    for _ in range(2):
        proof = replace_months(february, root)
        assert [tuple(r) for r in proof.collect()] == [(2024, 2, 6)]
        refresh_months(spark, root, batch_stats, mart, proof)
    assert files == set(glob.glob(f"{root}/*/month=01/*.parquet") + glob.glob(f"{mart}/*/month=1/*.parquet"))
    assert spark.read.parquet(root).count() == 12
    assert _as_set(spark.read.parquet(mart)) == _as_set(batch_stats(raw))
    # A corrected month replaces the old one, groups that are gone included.
    replace = replace_months(february.where("pollutant = 'no2'"), root)
    refresh_months(spark, root, batch_stats, mart, replace)
    assert {(r.month, r.pollutant) for r in spark.read.parquet(mart).collect()} == {(1, "pm25"), (1, "no2"), (2, "no2")}
