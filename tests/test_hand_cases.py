"""Hand-made cases on literal rows (FIXTURES.md part C)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidecast.operators import bookings as bk
from tidecast.operators import calendar as cal
from tidecast.operators import impute as imp
from tidecast.operators import submission as sub
from tidecast.operators.history import with_fallback
from tidecast.operators.lags import lag_booking, lag_features
from tidecast.operators.origins import OriginSet
from tidecast.operators.target_encoding import target_encode_oof
from tidecast.operators.trailing import trailing_stats

D = dt.date
# One origin: begin = cutoff = 2020-03-01.
ONE = OriginSet("one", D(2020, 3, 11), split=10, skip=10, count=1, gap=0)
CUT = D(2020, 3, 1)


def hist_df(spark, rows):
    df = spark.createDataFrame(rows, "store_id long, visit_date date, y double")
    return df.withColumns({"dow": F.weekday("visit_date").cast("long"), "weight": F.lit(1.0),
                           "holiday_flg": F.lit(0).cast("long")})


def targets_df(spark, rows):
    df = spark.createDataFrame(rows, "store_id long, visit_date date")
    return df.withColumns({"origin_id": F.lit(1).cast("long"), "cutoff": F.lit(CUT),
                           "dow": F.weekday("visit_date").cast("long")})


def test_fallback_to_store_then_null(spark):
    # Store 1 has history only on Mondays; store 2 has none.
    h = hist_df(spark, [(1, D(2020, 2, 24), 1.0), (1, D(2020, 2, 17), 3.0)])
    t = targets_df(spark, [(1, D(2020, 3, 2)), (1, D(2020, 3, 8)), (2, D(2020, 3, 2))])
    out = {(r.store_id, r.visit_date): r for r in
           with_fallback(t, h, ONE, [("store_id", "dow"), ("store_id",)]).collect()}
    assert out[(1, D(2020, 3, 2))].wmean == pytest.approx(2.0)      # Monday: own group
    assert out[(1, D(2020, 3, 8))].wmean == pytest.approx(2.0)      # Sunday: store mean
    assert out[(1, D(2020, 3, 8))].ycnt == 2
    assert out[(2, D(2020, 3, 2))].wmean is None                    # no history: null


def test_cutoff_excluded_and_window_start_included(spark):
    # 5-day window: [cutoff - 5, cutoff). A visit on the cutoff is excluded,
    # one exactly 5 days before is included, 6 days before is excluded.
    h = hist_df(spark, [(1, CUT, 100.0), (1, CUT - dt.timedelta(days=5), 2.0),
                        (1, CUT - dt.timedelta(days=6), 50.0)])
    r = trailing_stats(h, ONE, [5, 10]).collect()[0]
    assert r.mean_5d == pytest.approx(2.0)
    assert r.std_5d is None                                         # single row: null std
    assert r.scale_std_5d is None
    assert r.mean_10d == pytest.approx(26.0)


def test_zero_range_ratios(spark):
    h = hist_df(spark, [(1, CUT - dt.timedelta(days=1), 2.0), (1, CUT - dt.timedelta(days=2), 2.0)])
    r = trailing_stats(h, ONE, [5]).collect()[0]
    assert r.scale_maxmin_5d is None                                # 0 / 0
    assert r.scale_std_5d is None or math.isinf(r.scale_std_5d)
    assert r.std_5d == 0.0 and math.isinf(r.scale_std_5d) and r.scale_std_5d > 0


def test_lag_hole_is_null_not_previous_row(spark):
    t = targets_df(spark, [(1, D(2020, 3, 5))])
    h = hist_df(spark, [(1, D(2020, 2, 26), 7.0)])                  # d-8 present, d-7 missing
    r = lag_features(t, h, {"lag_1w": 7, "lag_8d": 8}).collect()[0]
    assert r.lag_1w is None and r.lag_8d == 7.0


def test_lag_at_or_after_cutoff_is_null(spark):
    t = targets_df(spark, [(1, D(2020, 3, 5))])
    h = hist_df(spark, [(1, D(2020, 3, 4), 1.0), (1, D(2020, 2, 29), 2.0)])
    r = lag_features(t, h, {"lag_1d": 1, "lag_5d": 5}).collect()[0]
    assert r.lag_1d is None and r.lag_5d == 2.0


def test_booking_known_late_excluded(spark):
    b = spark.createDataFrame(
        [(1, D(2020, 3, 5), CUT, 4), (1, D(2020, 3, 5), D(2020, 2, 27), 3)],
        "store_id long, visit_date date, reserve_date date, reserve_visitors long")
    t = targets_df(spark, [(1, D(2020, 3, 12))])
    r = lag_booking(t, b, {"lag_res_1w": 7}).collect()[0]
    assert r.lag_res_1w == 3


def test_lead_hours_in_day_range(spark):
    rows = [(1, dt.datetime(2020, 3, 5, 10), dt.datetime(2020, 3, 5, 18), 2),   # booked after the visit
            (1, dt.datetime(2020, 3, 5, 10), dt.datetime(2020, 3, 1, 12), 2)]
    b = spark.createDataFrame(rows, "store_id long, visit_datetime timestamp_ntz, "
                                    "reserve_datetime timestamp_ntz, reserve_visitors long")
    out = bk.parse_bookings(b).collect()
    assert sorted(r.lead_hours for r in out) == [-8.0, 94.0]
    assert sorted(r.lead_hours_mod24 for r in out) == [16.0, 22.0]
    assert all(0 <= r.lead_hours_mod24 < 24 for r in out)


def test_leave_fold_out_single_fold_category_is_null(spark):
    t = spark.createDataFrame([(1, 1, "a", 0, 1.0), (1, 2, "a", 0, 3.0), (1, 3, "b", 0, 5.0), (1, 4, "b", 1, 7.0)],
                              "origin_id long, store_id long, genre string, fold long, y double")
    out = {r.store_id: r.genre_mean for r in target_encode_oof(t, {"genre_mean": ("genre",)}).collect()}
    assert out[1] is None and out[2] is None                        # all of 'a' in fold 0
    assert out[3] == 7.0 and out[4] == 5.0


def test_sentinel_median_includes_sentinels(spark):
    df = spark.createDataFrame([(1, -1.0), (2, -1.0), (3, 3.0)], "k long, x double")
    as_written = sorted(r.x for r in imp.impute_sentinel(df, ["x"]).collect())
    assert as_written == [-1.0, -1.0, 3.0]
    excluded = sorted(r.x for r in imp.impute_sentinel(df, ["x"], exclude_sentinel=True).collect())
    assert excluded == [3.0, 3.0, 3.0]


def test_weekend_holiday_revised(spark):
    c = spark.createDataFrame([(D(2020, 3, 1), 1), (D(2020, 3, 2), 1)], "visit_date date, holiday_flg long")
    out = {r.visit_date: r.holiday_rev for r in cal.with_holiday_rev(cal.pad_calendar(c)).collect()}
    assert out[D(2020, 3, 1)] == 0                                   # Sunday
    assert out[D(2020, 3, 2)] == 1                                   # Monday


def test_calendar_padding_and_neighbours(spark):
    c = spark.createDataFrame([(D(2020, 3, 1), 0), (D(2020, 3, 2), 1)], "visit_date date, holiday_flg long")
    p = {r.visit_date: r for r in cal.enrich_calendar(c).collect()}
    assert len(p) == 6
    assert p[D(2020, 2, 28)].holiday_flg == 1 and p[D(2020, 3, 4)].holiday_flg == 0
    assert p[D(2020, 3, 1)].holiday_next1d == 1 and p[D(2020, 3, 3)].holiday_prev1d == 1
    assert p[D(2020, 2, 28)].holiday_prev1d == 0                     # edge -> 0
    assert [p[d].weight for d in sorted(p)] == pytest.approx([i / 6 for i in range(1, 7)])


def test_date_factor_default_one(spark):
    s = spark.createDataFrame([("x", D(2020, 3, 1), 10.0), ("y", D(2020, 3, 2), 10.0)],
                              "id string, visit_date date, visitors double")
    f = sub.factor_table(spark, D(2020, 3, 1), {0: 1.5})
    out = {r.id: r.visitors_adj for r in sub.adjust_by_date(s, f).collect()}
    assert out == {"x": 15.0, "y": 10.0}


def test_id_parse(spark):
    ids = spark.createDataFrame([("air_00a9_2017-04-23",)], "id string")
    r = sub.parse_ids(ids).collect()[0]
    assert r.store_key == "air_00a9" and r.visit_date == D(2017, 4, 23)
