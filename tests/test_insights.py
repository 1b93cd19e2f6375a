"""Dashboard marts and forecasting helpers on hand-made series."""

import datetime as dt

from aerolake.operators import insights as I

T0 = dt.datetime(2024, 3, 1, 0, 0)


def _series(spark, rows):
    return spark.createDataFrame([(s, T0 + dt.timedelta(hours=h), v) for s, h, v in rows],
                                 "station_id string, hour_ts timestamp_ntz, pm25 double")


def _profile(spark, rows):
    return spark.createDataFrame(rows, "station_id string, hour int, pm25 double")


def test_station_rank_snapshot_and_fallback(spark):
    prof = _profile(spark, [("site_1", 8, 30.0), ("site_2", 8, 10.0), ("site_3", 8, 50.0), ("site_1", 9, 1.0)])
    snap = [(r.rank, r.station_id, r.badge, r.basis) for r in I.station_rank(prof, hour=8).orderBy("rank").collect()]
    assert snap == [(1, "site_2", "SAFEST", "hour_snapshot"), (2, "site_1", "", "hour_snapshot"),
                    (3, "site_3", "AVOID", "hour_snapshot")]
    fb = I.station_rank(prof, hour=23).orderBy("rank").collect()
    assert [(r.station_id, r.pm25, r.basis) for r in fb] == [("site_2", 10.0, "station_mean"),
                                                            ("site_1", 15.5, "station_mean"),
                                                            ("site_3", 50.0, "station_mean")]
    assert fb[0].display_name == "Station 2"


def test_best_worst_hour_ties(spark):
    prof = _profile(spark, [("s", 3, 5.0), ("s", 1, 5.0), ("s", 7, 9.0), ("s", 2, 9.0)])
    r = I.station_best_worst_hour(prof).first()
    assert (r.best_hour, r.worst_hour, r.best_label, r.worst_label) == (1, 2, "01:00", "02:00")


def test_lookback_contiguity(spark):
    s = _series(spark, [("a", 0, 0.0), ("a", 1, 10.0), ("a", 2, 5.0), ("a", 4, 10.0), ("a", 5, 0.0), ("a", 6, 5.0)])
    out = I.lookback_sequences(s, 3).orderBy("hour_ts").collect()
    assert [(r.hour_ts.hour, r.seq) for r in out] == [(2, [0.0, 1.0, 0.5]), (6, [1.0, 0.0, 0.5])]
    loose = I.lookback_sequences(s, 3, require_contiguous=False).count()
    assert loose == 4


def test_seasonal_forecast_and_mae(spark):
    s = _series(spark, [("a", 0, 4.0), ("a", 24, 6.0), ("a", 25, 1.0), ("b", 0, -2.0), ("b", 24, 3.0)])
    bt = {(r.station_id, r.hour_ts.day): (r.actual, r.predicted) for r in I.seasonal_forecast(s).collect()}
    assert bt == {("a", 2): (6.0, 4.0), ("b", 2): (3.0, 0.0)}
    mae = {r.station_id: (r.mae, r.n_hours) for r in I.forecast_mae(I.seasonal_forecast(s)).collect()}
    assert mae == {"a": (2.0, 1), "b": (3.0, 1)}


def test_forecast_best_worst_step(spark):
    # last hour 30 -> steps 0..23 take hours 7..30; hour 6 is outside the window
    s = _series(spark, [("a", 6, 0.0), ("a", 7, 5.0), ("a", 10, 2.0), ("a", 12, 2.0), ("a", 30, 8.0)])
    r = I.forecast_best_worst_step(s).first()
    assert (r.best_step, r.best_pm25, r.worst_step, r.worst_pm25, r.n_steps) == (3, 2.0, 23, 8.0, 4)
    assert (r.best_label, r.worst_label) == ("+3h", "+23h")
    nxt = {r.step: r.target_ts for r in I.forecast_next(s).collect()}
    assert nxt[0] == T0 + dt.timedelta(hours=31)


def test_scaler_params(spark):
    s = _series(spark, [("a", 0, 4.0), ("b", 1, -1.0), ("a", 2, 9.5)])
    r = I.scaler_params(s).first()
    assert (r.scaler_min, r.scaler_max) == (-1.0, 9.5)


def test_station_slice_and_bundle(spark, mock):
    from aerolake.operators.clean import clean_data
    prof = _profile(spark, [("s1", 3, 5.0), ("s2", 1, 2.0), ("s1", 1, 4.0)])
    assert [(r.hour, r.pm25) for r in I.station_slice(prof, "s1").collect()] == [(1, 4.0), (3, 5.0)]
    bundle = I.feature_bundle(clean_data(mock), hour=0)
    assert set(bundle) == {"station_hourly", "station_profile", "all_pollutants", "dow_pattern",
                           "best_worst_hour", "scaler", "mae", "forecast_steps"}
    dow = bundle["dow_pattern"].first()
    assert (dow.dow, dow.day) == (0, "Mon")
    ranks = [(r.station_id, r.badge) for r in bundle["station_profile"].orderBy("rank").collect()]
    assert ranks == [("site_102", "SAFEST"), ("site_101", "AVOID")]


def test_lookback_keeps_missing_positions(spark):
    s = _series(spark, [("a", 0, 0.0), ("a", 1, None), ("a", 2, 10.0)])
    out = I.lookback_sequences(s, 3).first()
    assert out.seq == [0.0, None, 1.0]


def test_station_rank_now_and_column(spark):
    from pyspark.sql import functions as F
    prof = _profile(spark, [(f"s{i}", h, float(i + h)) for i in range(3) for h in range(24)])
    now = I.station_rank(prof, hour="now").collect()
    assert [r.basis for r in now] == ["hour_snapshot"] * 3
    col = I.station_rank(prof, hour=F.lit(5)).orderBy("rank").collect()
    assert [r.pm25 for r in col] == [5.0, 6.0, 7.0]
