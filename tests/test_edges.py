"""Edge rows of FIXTURES.md §X: NULL keys and values, all-null groups, one-row groups, NaN, ties, key
violations and empty subsets."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolake.operators.clean import clean_data
from aerolake.operators.profile import duplicate_audit, missing_profile, rows_per_month, rows_per_pollutant
from aerolake.operators.star import KeyViolation, build_raw_star, pollutants_dim, stations_dim, validate_keys
from aerolake.operators.transform import batch_stats, daily_peaks, level_counts, monthly_avg, pm25_aqi
from aerolake.plans import benchmark as B
from aerolake.sources.parquet import load_raw

from raw_rows import make_raw


def test_all_null_station_month_stays_null(spark):
    df = make_raw(spark, [dict(station_id="site_9", at_c=None, value=1.0, hour=0),
                          dict(station_id="site_9", at_c=None, value=2.0, hour=1),
                          dict(station_id="site_8", at_c=3.0, value=2.0, hour=1)])
    rows = {(r.station_id, r.value): r.at_c for r in clean_data(df).collect()}
    assert rows[("site_9", 1.0)] is None and rows[("site_9", 2.0)] is None and rows[("site_8", 2.0)] == 3.0


def test_null_station_keeps_its_values(spark):
    df = make_raw(spark, [dict(station_id=None, at_c=7.0, rh_percent=None, value=1.0),
                          dict(station_id=None, at_c=None, rh_percent=None, value=2.0, hour=3)])
    out = sorted(clean_data(df).collect(), key=lambda r: r.value)
    assert out[0].at_c == 7.0 and out[1].at_c is None


def test_median_is_exact_and_interpolated(spark):
    df = make_raw(spark, [dict(at_c=v, value=float(i), hour=i) for i, v in enumerate([1.0, 2.0, 10.0, 20.0])]
                  + [dict(at_c=None, value=99.0, hour=9)])
    filled = [r.at_c for r in clean_data(df).where("value = 99").collect()]
    assert filled == [6.0]


def test_negative_filter_keeps_null_values(spark):
    df = make_raw(spark, [dict(value=None), dict(value=-1.0, hour=2), dict(value=0.0, hour=3)])
    vals = sorted((r.value is None, r.value) for r in clean_data(df).collect())
    assert vals == [(False, 0.0), (True, None)]


def test_null_keys_are_not_groups(spark):
    df = make_raw(spark, [dict(year=None, value=1.0), dict(pollutant=None, value=2.0, hour=2),
                          dict(value=3.0, hour=3)])
    assert rows_per_month(df).count() == 1
    assert [r.pollutant for r in rows_per_pollutant(df).collect()] == ["pm25"]
    assert all(r.year is not None for r in batch_stats(df).collect())
    assert monthly_avg(df).where(F.col("pollutant").isNull()).count() == 0
    assert daily_peaks(df).where(F.col("year").isNull()).count() == 0


def test_null_pollutant_dropped_from_fact(spark):
    df = make_raw(spark, [dict(pollutant=None, value=2.0), dict(value=3.0, hour=2)])
    star = build_raw_star(df)
    pol = star["pollutants"].orderBy("pollutant_id").collect()
    assert [(r.pollutant_id, r.pollutant_name) for r in pol] == [(1, "pm25"), (2, None)]
    assert star["measurements"].count() == 1


def test_one_row_group_has_null_std(spark):
    out = batch_stats(make_raw(spark, [dict(value=4.0)])).first()
    assert out.std_value is None and out.reading_count == 1


def test_nan_becomes_null_at_load(spark, tmp_out):
    pdf = pd.DataFrame({"station_id": ["a", "a"], "value": [float("nan"), 2.0], "month": [1, 1]})
    path = os.path.join(tmp_out, "nan.parquet")
    pdf.to_parquet(path)
    df = load_raw(spark, path)
    assert df.where(F.col("value").isNull()).count() == 1
    assert df.agg(F.max("value")).first()[0] == 2.0


def test_missing_path_raises(spark, tmp_out):
    with pytest.raises(FileNotFoundError):
        load_raw(spark, os.path.join(tmp_out, "nope.parquet"))


def test_unreadable_file_raises_ioerror(spark, tmp_out):
    path = os.path.join(tmp_out, "bad.parquet")
    with open(path, "w") as fh:
        fh.write("not parquet")
    with pytest.raises(IOError):
        load_raw(spark, path)


def test_station_with_two_cities_violates_key(spark):
    df = make_raw(spark, [dict(city="Delhi"), dict(city="Noida", hour=4)])
    with pytest.raises(KeyViolation):
        validate_keys(stations_dim(df), ["station_id"], "stations")
    with pytest.raises(KeyViolation):
        build_raw_star(df)
    validate_keys(pollutants_dim(df), ["pollutant_id"], "pollutants")


def test_top3_ties_break_on_station(spark):
    rows = [dict(station_id=f"site_{i}", pollutant="pm10", value=50.0, hour=i) for i in (5, 3, 4, 1)]
    star = build_raw_star(make_raw(spark, rows))
    out = [r.station_id for r in B.q2_top3_pm10(spark, star["measurements"], star["pollutants"],
                                                 star["stations"]).collect()]
    assert out == ["site_1", "site_3", "site_4"]


def test_empty_pm25_subset(spark):
    df = make_raw(spark, [dict(pollutant="no2")])
    assert level_counts(df).count() == 0
    assert pm25_aqi(df).columns == ["datetime", "station_id", "value", "aqi_category"]
    assert level_counts(df).columns == ["station", "pollution_level", "count"]


def test_zero_and_missing_levels(spark):
    df = make_raw(spark, [dict(value=0.0), dict(value=None, hour=2)])
    lv = {r.pollution_level for r in level_counts(df).collect()}
    assert lv == {"safe", "hazardous"}
    assert {r.aqi_category for r in pm25_aqi(df).collect()} == {None}


def test_profiles_on_mock(mock):
    mp = {r.column_name: (r.missing_count, r.missing_pct) for r in missing_profile(mock).collect()}
    assert mp["vws_m_s"] == (5, 100.0) and mp["at_c"] == (1, 20.0)
    assert "station_id" not in mp
    d = duplicate_audit(mock).first()
    assert (d.total_rows, d.distinct_rows, d.duplicate_rows) == (5, 4, 1)


def test_approx_median_option(spark):
    from aerolake.operators.clean import group_medians
    df = make_raw(spark, [dict(at_c=v, value=float(i), hour=i) for i, v in enumerate([1.0, 2.0, 3.0])])
    hist = group_medians(df).first()["__med_at_c"]
    exact = group_medians(df, method="exact").first()["__med_at_c"]
    approx = group_medians(df, method="approx").first()["__med_at_c"]
    assert hist == exact == approx == 2.0
    assert clean_data(df, median_rows_bound=12).count() == 3


def test_raw_load_rejects_duplicate_station(spark, tmp_out):
    from aerolake.plans.catalog import create_raw_schema, load_raw_data
    path = os.path.join(tmp_out, "dup.parquet")
    make_raw(spark, [dict(city="Delhi"), dict(city="Noida", hour=4)]).write.parquet(path)
    create_raw_schema(spark, "dup_db")
    with pytest.raises(KeyViolation):
        load_raw_data(spark, "dup_db", path)
    assert spark.table("dup_db.stations").count() == 0


def test_histogram_medians_match_builtin(spark):
    from aerolake.operators.clean import group_medians
    rows = [dict(station_id=f"site_{i % 3}", month=1 + i % 2, at_c=float(i % 7) if i % 5 else None,
                 rh_percent=float(i % 4) + 0.25, value=float(i), hour=i % 24) for i in range(300)]
    df = make_raw(spark, rows)
    a = {(r.station_id, r.month): (r["__med_at_c"], r["__med_rh_percent"]) for r in group_medians(df).collect()}
    b = {(r.station_id, r.month): (r["__med_at_c"], r["__med_rh_percent"])
         for r in group_medians(df, method="exact").collect()}
    assert a == b and len(a) == 6


def test_serving_warns_on_duplicate_station(spark, caplog):
    import logging
    from aerolake.plans.catalog import setup_served_database
    df = clean_data(make_raw(spark, [dict(city="Delhi"), dict(city="Noida", hour=4)]))
    with caplog.at_level(logging.WARNING, logger="aerolake.catalog"):
        setup_served_database(spark, "warn_db", df)
    assert any("fan out" in r.getMessage() for r in caplog.records)
    assert spark.table("warn_db.stations").count() == 2


def test_nanosecond_timestamps(spark, tmp_out):
    import pyarrow as pa
    import pyarrow.parquet as pq
    ts = pa.array([1_704_067_200_000_000_000, 1_704_070_800_123_456_000], type=pa.timestamp("ns"))
    table = pa.table({"datetime": ts, "station_id": ["a", "b"], "value": [1.0, float("nan")]})
    path = os.path.join(tmp_out, "ns.parquet")
    pq.write_table(table, path, version="2.6")
    df = load_raw(spark, path, nanos_as_long=True)
    rows = sorted(df.collect(), key=lambda r: r.station_id)
    assert str(rows[0].datetime) == "2024-01-01 00:00:00"
    assert str(rows[1].datetime) == "2024-01-01 01:00:00.123456"
    assert rows[1].value is None


def test_bucketed_medians_hot_continuous_group(spark):
    """One hot station-month with continuous readings next to small groups: exact on every group."""
    import numpy as np
    from aerolake.operators.clean import group_medians
    rng = np.random.RandomState(11)
    rows = [dict(station_id="site_hot", month=1, at_c=float(v), value=1.0, hour=i % 24)
            for i, v in enumerate(rng.normal(20, 5, 2001))]
    rows += [dict(station_id=f"site_{i % 4}", month=2, at_c=float(i % 9) * 1.5 if i % 3 else None,
                  value=2.0, hour=i % 24) for i in range(200)]
    df = make_raw(spark, rows)
    got = {(r.station_id, r.month): r["__med_at_c"] for r in group_medians(df, method="bucketed").collect()}
    ref = {(r.station_id, r.month): r["__med_at_c"] for r in group_medians(df, method="exact").collect()}
    assert got == ref and len(got) == 5


def test_large_groups_are_narrowed_before_ranking(spark):
    """A group of many distinct readings among small ones and one without a key: same medians as the built-in, with ties
    and repeated rows, and only a few of its values are ranked."""
    import numpy as np
    from aerolake.operators.clean import RANGES, SALTS, _histogram, middle_ranges, narrowed_medians
    rng = np.random.RandomState(5)
    rows = [dict(station_id="site_hot", month=1, at_c=float(v), rh_percent=float(i % 3), value=1.0, hour=i % 24)
            for i, v in enumerate(rng.normal(20, 5, 6000))]
    rows += [dict(station_id=None, month=1, at_c=float(v), value=1.0, hour=1) for v in rng.exponential(3, 601)]
    rows += [dict(station_id="site_tie", month=2, at_c=v, value=1.0, hour=2) for v in [7.0] * 400 + [8.0] * 400]
    rows += [dict(station_id=f"site_{i % 4}", month=2, at_c=float(i % 9) * 1.5 if i % 3 else None, value=2.0,
                  hour=i % 24) for i in range(200)]
    df = make_raw(spark, rows)
    keys, columns = ["station_id", "month"], ["at_c", "rh_percent"]
    reference = df.groupBy(*keys).agg(*[F.median(c).alias(f"__med_{c}") for c in columns])
    expected = {r[:2]: r[2:] for r in reference.collect()}
    for limit in (1, 50, 100_000):
        got = narrowed_medians(df, columns, keys, ranked_at_most=limit).collect()
        assert {tuple(r[:2]): tuple(r[2:]) for r in got} == expected and len(got) == len(expected) == 7, limit

    hist = _histogram(df, ["at_c"], keys).where("station_id = 'site_hot'") \
        .withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    ranked = middle_ranges(hist, [*keys, "col"]).groupBy("range").count().collect()
    assert 1 <= len(ranked) <= 2 and max(r["count"] for r in ranked) <= 1.2 * 6000 / RANGES + 2
