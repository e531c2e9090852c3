"""Query catalogue: one function per key, ``(spark, sf_dir) -> DataFrame``.

Each composes the operators on the fixture views and ends with
``finalize`` (bigint integers, doubles rounded to 6 places) so that the
result compares with its SQL twin in ``tidecast.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.scalars import fold_of
from tidecast.operators import bookings as bk
from tidecast.operators import calendar as calops
from tidecast.operators import encoders as enc
from tidecast.operators import ensemble as ens
from tidecast.operators import impute as imp
from tidecast.operators import metrics as met
from tidecast.operators import models as mdl
from tidecast.operators import submission as sub
from tidecast.operators.covariates import bridge_join, enrich_facts, weather_join
from tidecast.operators.features import add_interactions, cols_like, segment_filter as rows_of_segment, select_features, set_manifest
from tidecast.operators.history import expanding, expanding_stats, with_fallback
from tidecast.operators.lags import ALL_DAY_LAGS, DAY_LAGS, WEEK_LAGS, lag_booking, lag_features, lag_names
from tidecast.operators.origins import TEST, TRAIN1, TRAIN2, TRAIN_ALL, assign_origin
from tidecast.operators.target_encoding import (BASE_KEYSETS, MORE_KEYSETS, target_encode_hist,
                                                target_encode_oof)
from tidecast.operators.trailing import (ALL_DIFFS, ALL_DOW_WEEKS, ALL_TRAIL_DAYS, DOW_FULL_WEEKS, DOW_WEEKS, TRAIL_DAYS,
                                         TRAIL_WEEKS_DAYS, trailing_diffs, trailing_dow, trailing_dow_diffs, trailing_stats)
from tidecast.plans.frames import Frames, finalize
from tidecast.plans.naive import MODELS, naive_history, naive_long, naive_wide
from tidecast.session import cut_lineage, stored
from tidecast.sources.tables import HORIZON_DAYS, INI

KEYS3 = ["origin_id", "store_id", "visit_date"]
STAT_COLS = ["wmean", "ymax", "ymin", "ymed", "ycnt"]

# Blend weights of the naive models (model_id -> weight) and
# the weight of the second blend in the third layer.
BLEND_WEIGHTS = {1: 0.5, 2: 0.3, 3: 0.2}
EQUAL_WEIGHTS = {1: 1 / 3, 2: 1 / 3, 3: 1 / 3}
THIRD_LAYER_ALPHA = 0.7

# Judgmental factors by day of the horizon (0 = first day),
# the twelve dates of the reference's single-model submission.
DATE_FACTORS = {2: 1.10, 4: 1.10, 7: 1.35, 8: 1.20, 9: 1.10, 10: 1.10, 11: 1.10,
                12: 1.05, 13: 1.00, 14: 0.95, 15: 0.90, 16: 0.90}

# The sixteen dates of the reference's ensemble submission.
ENSEMBLE_FACTORS = {2: 1.10, 3: 1.00, 4: 1.10, 5: 1.00, 6: 1.00, 7: 1.30, 8: 1.40, 9: 1.10, 10: 1.10, 11: 1.05,
                    12: 1.05, 13: 1.00, 14: 1.10, 15: 0.95, 16: 0.95, 17: 1.00}

BACKTEST_SPLIT = 33
# Fixed value: fits with seeds of their own in each fold of the stack.
STACK_BAGS = 5


def _fr(spark: SparkSession, sf_dir: str) -> Frames:
    return Frames(spark, sf_dir)


# ---- step 1: scans, calendar, scalars ------------------------------------
def scan_visits(spark, d):
    return finalize(_fr(spark, d).fx.visits.select("store_id", "visit_date", "visitors"))


def calendar_padded(spark, d):
    cal = calops.pad_calendar(_fr(spark, d).fx.calendar)
    return finalize(cal.select("visit_date", "holiday_flg", "dow", "month"))


def calendar_neighbours(spark, d):
    cal = calops.with_neighbours(calops.pad_calendar(_fr(spark, d).fx.calendar))
    return finalize(cal.select("visit_date", "holiday_flg", "holiday_next1d", "holiday_prev1d"))


def calendar_holiday_rev(spark, d):
    cal = calops.with_holiday_rev(calops.pad_calendar(_fr(spark, d).fx.calendar))
    return finalize(cal.select("visit_date", "holiday_flg", "holiday_rev"))


def calendar_weight(spark, d):
    cal = calops.with_weight(calops.pad_calendar(_fr(spark, d).fx.calendar), power=1)
    return finalize(cal.select("visit_date", "weight"))


def log_target(spark, d):
    v = _fr(spark, d).fx.visits
    y = F.log1p(F.col("visitors").cast("double"))
    return finalize(v.select("store_id", "visit_date", y.alias("y"), F.expm1(y).alias("back")))


def id_parse(spark, d):
    return finalize(sub.parse_ids(_fr(spark, d).fx.horizon_ids))


def booking_parse(spark, d):
    b = _fr(spark, d).bookings
    return finalize(b.select("store_id", "visit_date", "reserve_date", "visit_hour", "dow",
                             "lead_hours", "lead_hours_mod24"))


# ---- step 2: minimum slice -------------------------------------------------
def facts_enriched(spark, d):
    fr = _fr(spark, d)
    f = enrich_facts(fr.fx.history(), fr.cal, fr.stores)
    return finalize(f.select("store_id", "visit_date", "y", "dow", "holiday_flg", "genre", "area_l1"))


def origin_targets(spark, d):
    t = assign_origin(_fr(spark, d).fx.visits, TRAIN_ALL, by_day_flag=True)
    return finalize(t.select("origin_id", "store_id", "visit_date", "horizon_day", "flag"))


def origin_history(spark, d):
    fr = _fr(spark, d)
    h = fr.fx.visits.withColumn("_dn", F.datediff("visit_date", F.lit(dt.date(1970, 1, 1))))
    e = expanding(h, TRAIN_ALL, ["store_id"], {
        "n_days": ("count", F.col("visit_date")), "_first": ("min", F.col("_dn")), "_last": ("max", F.col("_dn"))})
    epoch = F.lit(dt.date(1970, 1, 1))
    return finalize(e.select("origin_id", "store_id", F.col("n_days").cast("long").alias("n_days"),
                             F.date_add(epoch, F.col("_first").cast("int")).alias("first_date"),
                             F.date_add(epoch, F.col("_last").cast("int")).alias("last_date")))


def segment_filter(spark, d):
    t = _fr(spark, d).test_targets(decorate=False)
    return finalize(t.groupBy("flag").agg(F.count(F.lit(1)).alias("n_rows"), F.min("horizon_day").alias("min_day"),
                                          F.max("horizon_day").alias("max_day")))


def _hist_stats(spark, d, levels, extra=()):
    fr = _fr(spark, d)
    t = fr.test_targets()
    out = with_fallback(t.select(*KEYS3, "dow", "holiday_flg", "holiday_next1d", "holiday_prev1d", "holiday_rev"), fr.hist, TEST, levels,
                        partitions=fr.tasks)
    return finalize(out.select("store_id", "visit_date", *extra, *STAT_COLS))


def hist_stats_dow(spark, d):
    return _hist_stats(spark, d, [("store_id", "dow"), ("store_id",), ("store_id",)])


def hist_stats_dowhol(spark, d):
    return _hist_stats(spark, d, [("store_id", "dow", "holiday_flg"), ("store_id", "dow"), ("store_id",)])


def hist_stats_dowhol_nb(spark, d):
    return _hist_stats(spark, d, [("store_id", "dow", "holiday_next1d"), ("store_id", "dow"), ("store_id",)],
                       extra=("holiday_next1d",))


def hist_stats_dowhol_prev(spark, d):
    return _hist_stats(spark, d, [("store_id", "dow", "holiday_prev1d"), ("store_id", "dow"), ("store_id",)],
                       extra=("holiday_prev1d",))


def hist_stats_dowhol_rev(spark, d):
    return _hist_stats(spark, d, [("store_id", "dow", "holiday_rev"), ("store_id", "dow"), ("store_id",)],
                       extra=("holiday_rev",))


# ---- step 3: encoders, store dimension, bridge, weather ---------------------
def store_dim(spark, d):
    s = _fr(spark, d).stores
    return finalize(s.select("store_id", "area_l1", "area_l2", "area_l3", "d_lat", "d_long"))


def label_encode(spark, d):
    s = _fr(spark, d).stores
    for c in ("genre", "area_l1", "area_l2", "area_l3"):
        s = enc.label_encode(s, c)
    return finalize(s.select("store_id", "genre_lbl", "area_l1_lbl", "area_l2_lbl", "area_l3_lbl"))


def one_hot(spark, d):
    cal = calops.pad_calendar(_fr(spark, d).fx.calendar).select("visit_date", "dow", "month")
    return finalize(enc.one_hot(cal, ["dow", "month"], drop_first=True))


def one_hot_full(spark, d):
    cal = calops.pad_calendar(_fr(spark, d).fx.calendar).select("visit_date", "dow")
    return finalize(enc.one_hot(cal, ["dow"], drop_first=False).drop("dow"))


def one_hot_open(spark, d):
    """Places of an open category (every order's customer) in its sparse
    vectors: the first level is dropped, its rows have no place."""
    orders = _fr(spark, d).fx.table("orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    vectors = enc.one_hot_vectors(orders, ["customer"])
    parts = F.from_json(F.to_json(F.struct("customer_vec")), "customer_vec struct<size:bigint, indices:array<bigint>>")["customer_vec"]
    return finalize(vectors.select("o_orderkey", parts["size"].alias("size"), F.get(parts["indices"], F.lit(0)).alias("place")))


def geo_clusters(spark, d):
    s = _fr(spark, d).fx.stores
    return finalize(enc.geo_clusters(s, k=12, seed=0).select("store_id", "cluster"))


def fold_assign(spark, d):
    v = _fr(spark, d).fx.visits
    return finalize(enc.with_fold(v, 5, ["store_id", "visit_date"]).select("store_id", "visit_date", "fold"))


def bridge_join_q(spark, d):
    fx = _fr(spark, d).fx
    return finalize(bridge_join(fx.stores, fx.id_relation, fx.partner_stores)
                    .select("store_id", "partner_id", "partner_genre"))


def weather_join_q(spark, d):
    fr = _fr(spark, d)
    v = fr.fx.visits.join(fr.stores.select("store_id", "area_l1"), "store_id", "left")
    return finalize(weather_join(v, fr.fx.weather).select("store_id", "visit_date", "rainfall", "wind_max"))


# ---- step 4: history, lags, trailing, bookings ----------------------------
def hist_stats_multi(spark, d):
    fr = _fr(spark, d)
    return finalize(expanding_stats(fr.hist, TRAIN_ALL, ["store_id", "dow"]))


def _o9_lags(spark, d, offsets):
    fr = _fr(spark, d)
    t = fr.train_targets(TRAIN_ALL, decorate=False)
    return finalize(lag_features(t, fr.hist, offsets, oset=TRAIN_ALL).select(*KEYS3, *offsets))


def lag_daily(spark, d):
    return _o9_lags(spark, d, lag_names(days=DAY_LAGS))


def lag_weekly(spark, d):
    return _o9_lags(spark, d, lag_names(weeks=WEEK_LAGS))


def lag_booking_q(spark, d):
    fr = _fr(spark, d)
    t = fr.train_targets(TRAIN_ALL, decorate=False)
    names = lag_names(weeks=WEEK_LAGS, prefix="lag_res")
    return finalize(lag_booking(t, fr.bookings, names, oset=TRAIN_ALL).select(*KEYS3, *names))


def lag_days_all(spark, d):
    return _o9_lags(spark, d, lag_names(days=ALL_DAY_LAGS))


def lag_booking_days(spark, d):
    fr = _fr(spark, d)
    names = lag_names(days=ALL_DAY_LAGS, prefix="lag_res")
    t = fr.train_targets(TRAIN_ALL, decorate=False)
    return finalize(lag_booking(t, fr.bookings, names, oset=TRAIN_ALL).select(*KEYS3, *names))


def trailing_all(spark, d):
    """All thirteen lengths with the ten differences of their means."""
    return finalize(trailing_diffs(trailing_stats(_fr(spark, d).hist, TRAIN_ALL, ALL_TRAIL_DAYS), ALL_DIFFS))


def trailing_dow_all(spark, d):
    """All nine week lengths with the ten differences of their means."""
    t = trailing_dow(_fr(spark, d).hist, TRAIN_ALL, ALL_DOW_WEEKS, aggs=("mean", "max", "min", "std"))
    return finalize(trailing_dow_diffs(t))


def booking_dow_origins(spark, d):
    """Weekday means of bookings for every training origin, from the cube."""
    return finalize(bk.booking_dow_cells(bk.booking_cube(_fr(spark, d).bookings, TRAIN_ALL), TRAIN_ALL))


def trailing_stats_q(spark, d):
    return finalize(trailing_stats(_fr(spark, d).hist, TRAIN_ALL, TRAIL_DAYS))


def trailing_stats_weeks(spark, d):
    return finalize(trailing_stats(_fr(spark, d).hist, TRAIN_ALL, TRAIL_WEEKS_DAYS))


def trailing_diffs_q(spark, d):
    t = trailing_stats(_fr(spark, d).hist, TRAIN_ALL, (28, 56, 84), scales=False, aggs=("mean",))
    return finalize(trailing_diffs(t).select("origin_id", "store_id", "diff_28_56", "diff_28_84", "diff_56_84"))


def trailing_dow_mean(spark, d):
    t = trailing_dow(_fr(spark, d).hist, TRAIN_ALL, DOW_WEEKS)
    return finalize(t.select("origin_id", "store_id", "dow", *[f"mean_dow_{w}w" for w in DOW_WEEKS]))


def trailing_dow_full(spark, d):
    aggs = ("mean", "max", "min", "std")
    t = trailing_dow(_fr(spark, d).hist, TRAIN_ALL, DOW_FULL_WEEKS, aggs=aggs)
    return finalize(t.select("origin_id", "store_id", "dow",
                             *[f"{a}_dow_{w}w" for w in DOW_FULL_WEEKS for a in aggs]))


def booking_stats_q(spark, d):
    b = bk.known_before(_fr(spark, d).bookings, INI)
    return finalize(bk.booking_stats(b).select("store_id", "visit_date", "res_ttl", "res_cnt", "res_mean",
                                               "res_hr_std"))


def booking_stats_ext(spark, d):
    b = bk.known_before(_fr(spark, d).bookings, INI)
    return finalize(bk.booking_stats(b, extended=True).select("store_id", "visit_date", "res_std", "lead_sum",
                                                              "lead_mean"))


def booking_dow_q(spark, d):
    b = bk.known_before(_fr(spark, d).bookings, INI)
    return finalize(bk.booking_dow(b).select("store_id", "dow", "party_mean_dow", "cnt_mean_dow"))


# ---- step 5: target encoding ----------------------------------------------
def _te_hist(spark, d, keysets):
    fr = _fr(spark, d)
    t = fr.test_targets().select("store_id", "visit_date", "dow", "genre", "area_l1", "area_l2", "area_l3")
    h = fr.hist.where(F.col("visit_date") < F.lit(INI))
    return finalize(target_encode_hist(t, h, keysets).select("store_id", "visit_date", *keysets))


def target_encode_hist_q(spark, d):
    return _te_hist(spark, d, BASE_KEYSETS)


def target_encode_more(spark, d):
    return _te_hist(spark, d, MORE_KEYSETS)


def target_encode_cluster(spark, d):
    """A13x with k-means clusters of the stores as categories."""
    fr = _fr(spark, d)
    of = cut_lineage(enc.geo_clusters(fr.fx.stores, k=12, seed=0).select("store_id", F.col("cluster")))
    t = fr.test_targets(decorate=False).select("store_id", "visit_date", "dow").join(of, "store_id")
    h = fr.hist.where(F.col("visit_date") < F.lit(INI)).join(of, "store_id")
    keysets = {"cluster_mean": ("cluster",), "cluster_dow_mean": ("cluster", "dow")}
    return finalize(target_encode_hist(t, h, keysets).select("store_id", "visit_date", "cluster", *keysets))


def target_encode_oof_q(spark, d):
    fr = _fr(spark, d)
    t = fr.train_targets(TRAIN_ALL).withColumn("fold", fold_of(5, "store_id", "visit_date"))
    t = t.select(*KEYS3, "fold", "y", "dow", "genre", "area_l3")
    return finalize(target_encode_oof(t, BASE_KEYSETS).select(*KEYS3, "fold", *BASE_KEYSETS))


# ---- step 7: imputation, selection, interactions --------------------------
def _lags_filled(fr, targets, oset):
    names = lag_names(days=DAY_LAGS)
    lags = lag_features(targets, fr.hist, names, oset=oset)
    return imp.fill_and_count(lags, list(names)), list(names)


def fill_and_count_q(spark, d):
    fr = _fr(spark, d)
    filled, names = _lags_filled(fr, fr.train_targets(TRAIN_ALL, decorate=False), TRAIN_ALL)
    return finalize(filled.select(*KEYS3, "na_cnt", *names))


def union_train_test_q(spark, d):
    fr = _fr(spark, d)
    tr = fr.train_targets(TRAIN_ALL, decorate=False).select(*KEYS3, "visitors")
    te = fr.test_targets(decorate=False).select(*KEYS3)
    u = imp.union_train_test(tr, te)
    return finalize(u.groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("visitors").alias("n_label")))


def _lags_train_test(fr):
    tr, names = _lags_filled(fr, fr.train_targets(TRAIN_ALL, decorate=False), TRAIN_ALL)
    te, _ = _lags_filled(fr, fr.test_targets(decorate=False), TEST)
    u = (tr.withColumn("is_test", F.lit(0).cast("long"))
         .unionByName(te.withColumn("is_test", F.lit(1).cast("long"))))
    return u, names


def impute_sentinel_q(spark, d):
    fr = _fr(spark, d)
    u, names = _lags_train_test(fr)
    return finalize(imp.impute_sentinel(u, names).select("is_test", *KEYS3, *names))


SCALE_COLS = [f"scale_{k}_{d}d" for d in TRAIL_DAYS for k in ("maxmin", "std")]


def _scales_filled(spark, d):
    t = trailing_stats(_fr(spark, d).hist, TRAIN_ALL, TRAIL_DAYS)
    return t.select("origin_id", "store_id", *SCALE_COLS).fillna(-1.0, subset=SCALE_COLS)


def impute_inf_zero(spark, d):
    return finalize(imp.replace_inf_zero(_scales_filled(spark, d), SCALE_COLS))


def impute_inf_median(spark, d):
    return finalize(imp.replace_inf_median(_scales_filled(spark, d), SCALE_COLS))


def interactions(spark, d):
    fr = _fr(spark, d)
    t = fr.test_targets().select("store_id", "visit_date", "dow", "genre", "area_l1", "area_l2", "area_l3")
    h = fr.hist.where(F.col("visit_date") < F.lit(INI))
    te = target_encode_hist(t, h, BASE_KEYSETS)
    w = weather_join(te, fr.fx.weather)
    out = add_interactions(w, {"genre_plus_area": ("add", "genre_mean", "area_mean"),
                               "wind_x_rain": ("mul", "wind_max", "rainfall")})
    return finalize(out.select("store_id", "visit_date", "genre_plus_area", "wind_x_rain"))


def feature_select(spark, d):
    fr = _fr(spark, d)
    t = fr.train_targets(TRAIN_ALL, decorate=False)
    lags = lag_features(t, fr.hist, lag_names(days=DAY_LAGS), oset=TRAIN_ALL)
    cal = enc.one_hot(calops.pad_calendar(fr.fx.calendar).select("visit_date", "dow"), ["dow"])
    wide = lags.join(F.broadcast(cal), "visit_date", "left")
    long_horizon = [*KEYS3, *cols_like(wide, "dow_"), "lag_10d", "lag_20d", "lag_30d"]
    short_horizon = long_horizon + ["lag_1d", "lag_3d", "lag_5d"]
    return finalize(select_features(wide, short_horizon))


# ---- step 8: scores, backtests, ensemble, submission ----------------------
def backtest_split(spark, d):
    p = mdl.backtest_parts(_fr(spark, d).fx.visits, INI, BACKTEST_SPLIT)
    return finalize(p.groupBy("n", "part").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.min("visit_date").alias("min_date"),
                                               F.max("visit_date").alias("max_date")))


def _test_preds(fr):
    return naive_long(naive_wide(fr, TEST, fr.test_targets(decorate=False)))


def ens_gather(spark, d):
    from tidecast.session import shared_path
    from tidecast.sources.sinks import gather_predictions, write_predictions
    path = shared_path(spark, "predictions")
    write_predictions(_test_preds(_fr(spark, d)), path)
    wide = ens.pivot_predictions(gather_predictions(spark, path), MODELS)
    return finalize(wide.select("store_id", "visit_date", *[f"pred_{m}" for m in MODELS]))


def ens_corr(spark, d):
    fr = _fr(spark, d)
    wide = ens.pivot_predictions(_test_preds(fr), MODELS)
    return finalize(ens.corr_matrix(wide, [f"pred_{m}" for m in MODELS]))


def ens_blend(spark, d):
    fr = _fr(spark, d)
    b = ens.blend(_test_preds(fr), ens.weights_table(spark, BLEND_WEIGHTS))
    return finalize(b.select("store_id", "visit_date", "pred_blend"))


def _blend3(spark, fr):
    """Third layer: both blends from one aggregate over the predictions."""
    p = ens.blends(_test_preds(fr), {"pred_eq": EQUAL_WEIGHTS, "pred_blend": BLEND_WEIGHTS})
    return p.select("store_id", "visit_date", (F.col("pred_eq") * THIRD_LAYER_ALPHA
                                               + F.col("pred_blend") * (1.0 - THIRD_LAYER_ALPHA)).alias("pred_3rd"))


def ens_blend3(spark, d):
    return finalize(_blend3(spark, _fr(spark, d)))


def score_rmsle(spark, d):
    fr = _fr(spark, d)
    truth = fr.fx.history().withColumnRenamed("y", "truth")
    p = _test_preds(fr).join(truth, ["store_id", "visit_date"], "inner")
    return finalize(met.rmsle(p, "truth", "pred", by=["model_id"]).select("model_id", "n", "n_unscored", "rmsle"))


def score_horizon(spark, d):
    fr = _fr(spark, d)
    t = fr.train_targets(TRAIN_ALL, by_day_flag=True, decorate=False)
    p = naive_long(naive_wide(fr, TRAIN_ALL, t))
    return finalize(met.horizon_score(p, "y", "pred", by=["model_id"]).select("model_id", "s1", "s2", "total", "n_unscored"))


def backtest_scores(spark, d):
    fr = _fr(spark, d)
    s = mdl.backtest_naive_scores(fr.hist, INI, BACKTEST_SPLIT)
    return finalize(met.mean_score(s).select("n", "rmsle", "mean_rmsle", "n_unscored"))


def _submission(spark, fr):
    p = _test_preds(fr)
    # Short- and long-horizon predictions appended; the flag stays a key,
    # so both parts come from one aggregate.
    both = ens.blends(p, {"pred_blend": BLEND_WEIGHTS}, keys=("store_id", "visit_date", "flag"))
    return sub.build_submission(fr.fx.horizon_ids, both, pred="pred_blend")


def submission_build(spark, d):
    return finalize(_submission(spark, _fr(spark, d)).select("id", "visitors"))


def _adjusted(spark, fr):
    s = _submission(spark, fr)
    return sub.adjust_by_date(s, sub.factor_table(spark, INI, DATE_FACTORS))


def submission_adjust(spark, d):
    a = _adjusted(spark, _fr(spark, d))
    return finalize(a.select("id", F.col("visitors").alias("visitors_raw"), "visitors_adj"))


def submission_ensemble(spark, d):
    """Third-layer blend as a submission, with the ensemble's own factors."""
    fr = _fr(spark, d)
    s = sub.build_submission(fr.fx.horizon_ids, _blend3(spark, fr), pred="pred_3rd")
    a = sub.adjust_by_date(s, sub.factor_table(spark, INI, ENSEMBLE_FACTORS))
    return finalize(a.select("id", F.col("visitors").alias("visitors_raw"), "visitors_adj"))


def yoy_compare_q(spark, d):
    fr = _fr(spark, d)
    end = INI + dt.timedelta(days=HORIZON_DAYS - 1)
    return finalize(sub.yoy_compare(fr.fx.visits, _adjusted(spark, fr), INI, end)
                    .select("visit_date", "actual_last_year", "pred", "pred_adj"))


# ---- step 6: whole datasets ------------------------------------------------
def dataset_test(spark, d):
    from tidecast.plans.dataset import build_dataset
    return finalize(build_dataset(_fr(spark, d), TEST, test=True))


def dataset_rolling(spark, d):
    from tidecast.plans.dataset import build_dataset
    return finalize(build_dataset(_fr(spark, d), TRAIN_ALL))


def dataset_train1(spark, d):
    from tidecast.plans.dataset import build_dataset
    return finalize(build_dataset(_fr(spark, d), TRAIN1))


def dataset_train2(spark, d):
    from tidecast.plans.dataset import build_dataset
    return finalize(build_dataset(_fr(spark, d), TRAIN2))


def features_incremental(spark, d):
    """The feature sink filled in two runs: the older origin, then what is missing."""
    from tidecast.plans.dataset import build_dataset, refresh_features
    from tidecast.session import shared_path
    from tidecast.sources.sinks import read_features, write_features
    fr, path, two = _fr(spark, d), shared_path(spark, "features"), TRAIN_ALL.part(1, 2)
    write_features(build_dataset(fr, two.part(2, 2)).withColumn("origin_id", F.lit(2).cast("long")), path)
    refresh_features(fr, two, path)
    return finalize(read_features(spark, path, two.name).select(*KEYS3, "visitors", "lag_7w", "mean_50d", "dow_all_wmean"))


def model_inputs_q(spark, d):
    _, train, test, feats = _ml_frames(spark, d)
    cols = ["is_test", "store_id", "visit_date", "y", *feats]
    return finalize(train.select(*cols).unionByName(test.select(*cols)))


# ---- step 9: MLlib cross-fitting, bagging, stacking, importance -----------
def model_inputs(train: DataFrame, test: DataFrame, feats, sentinel_cols, inf_cols):
    """Model-input preparation of the first-stage scripts: union train and
    test (U4), sentinel -1 -> column median over both (P12), +-inf -> 0
    (P13), split again by the tag."""
    # The medians, every fit and prediction read these rows: written once to
    # the shared checkpoint folder (survives executor loss), by columns. Train
    # and test rows apart, as one task for both would hold the sorters of both.
    cols = list(dict.fromkeys([*feats, *sentinel_cols, *inf_cols]))
    # Sorted, as what a fit draws depends on the order of its rows.
    train = train.select("store_id", "visit_date", "visitors", "y", *cols).sortWithinPartitions("store_id", "visit_date")
    train = stored(train, "train_rows")
    test = stored(test.select("store_id", "visit_date", F.lit(0).cast("long").alias("visitors"), *cols), "test_rows")
    u = imp.union_train_test(train, test).select("is_test", "store_id", "visit_date", "y", *cols)
    u = imp.replace_inf_zero(imp.impute_sentinel(u, sentinel_cols), inf_cols).select("is_test", "store_id", "visit_date", "y", *feats)
    return u.where(F.col("is_test") == 0), u.where(F.col("is_test") == 1)


def _ml_frames(spark, d):
    from tidecast.plans.dataset import build_dataset, feature_columns, imputed_columns
    fr = _fr(spark, d)
    train = build_dataset(fr, TRAIN_ALL)
    test = build_dataset(fr, TEST, test=True)
    feats = feature_columns()
    inf_cols = [c for c in feats if c.startswith("scale_")]
    train, test = model_inputs(train, test, feats, imputed_columns(), inf_cols)
    return fr, train.withColumn("fold", fold_of(5, "store_id", "visit_date")), test, feats


def crossfit_gbt(spark, d):
    _, train, test, feats = _ml_frames(spark, d)
    oof, tst, _ = mdl.crossfit(train, test, feats, label="y", k=5)
    a = oof.select(F.lit("train_all").alias("set"), "store_id", "visit_date", "fold", "pred")
    b = tst.select(F.lit("test").alias("set"), "store_id", "visit_date", F.lit(-1).cast("long").alias("fold"), "pred")
    return finalize(a.unionByName(b))


def _first_stage(spark, d):
    """Short and long set apart: each fits its own models on its own manifest
    and predicts the test rows of its flag."""
    from tidecast.plans.dataset import build_dataset, feature_columns, imputed_columns
    fr = _fr(spark, d)
    test = build_dataset(fr, TEST, test=True)

    def inputs(flag, oset):
        feats = set_manifest(feature_columns(), flag == 1, DAY_LAGS)
        train, rows = model_inputs(build_dataset(fr, oset), rows_of_segment(test, flag), feats, [c for c in imputed_columns() if c in feats],
                                   [c for c in feats if c.startswith("scale_")])
        return train.withColumn("fold", fold_of(5, "store_id", "visit_date")), rows, feats

    def predictions(flag, train, rows, feats):
        _, preds, _ = mdl.crossfit(train, rows, feats, label="y", k=5)
        return preds.select(F.lit(flag).cast("long").alias("flag"), "store_id", "visit_date", "pred")

    # The sets don't read each other: a step of one that leaves cores idle
    # leaves them to the other. On many rows the fits of one fill the cluster.
    sets = mdl.side_by_side(spark, [lambda f=f, o=o: (f, *inputs(f, o)) for f, o in ((1, TRAIN1), (2, TRAIN2))])
    n_rows = sum(train.count() for _, train, _, _ in sets)
    both = mdl.fits_at_once(n_rows, len(sets[0][3])) == mdl.AT_ONCE
    out = mdl.side_by_side(spark, [lambda s=s: predictions(*s) for s in sets], 2 if both else 1)
    return out[0].unionByName(out[1])


def first_stage(spark, d):
    return finalize(_first_stage(spark, d))


def backtest_gbt(spark, d):
    """M7: time backtest of the boosted model, five splits side by side."""
    _, train, _, feats = _ml_frames(spark, d)
    return finalize(mdl.backtest_model_scores(train, feats, INI, BACKTEST_SPLIT).select("n", "n_train", "n_valid", "rmsle"))


def backtest_gbt_rows(spark, d):
    """Rows of each split of ``backtest_gbt``: the targets of the training origins."""
    p = mdl.backtest_parts(_fr(spark, d).train_targets(TRAIN_ALL, decorate=False), INI, BACKTEST_SPLIT)
    return finalize(p.groupBy("n").agg(F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "valid").alias("n_valid")))


def bagged_fit(spark, d):
    _, train, test, feats = _ml_frames(spark, d)
    return finalize(mdl.bagged_fit(train, test, feats, label="y"))


def feature_importance(spark, d):
    _, train, _, feats = _ml_frames(spark, d)
    return mdl.importance(mdl.fit(train, feats, label="y"), feats, spark)


def _stacked(spark, d):
    """Second layer: out-of-fold and test predictions of the stacker, joined
    back onto their rows, and the third layer (stack and weighted blend)."""
    fr = _fr(spark, d)
    hist = naive_history(fr, TEST)  # holds all that the training origins see
    tr = naive_wide(fr, TRAIN_ALL, fr.train_targets(TRAIN_ALL, by_day_flag=True, decorate=False), hist)
    te = naive_wide(fr, TEST, fr.test_targets(decorate=False), hist)
    cols = [f"pred_{m}" for m in MODELS]
    blended = sum(F.col(f"pred_{m}") * w for m, w in BLEND_WEIGHTS.items())
    tr = tr.withColumn("pred_blend", blended).fillna(-1.0, subset=cols)
    te = te.withColumn("pred_blend", blended).fillna(-1.0, subset=cols)
    # Each fold's fit and its predictions read these rows.
    tr = cut_lineage(tr.withColumn("fold", fold_of(4, "store_id", "visit_date")))
    te = cut_lineage(te)
    # Predictions go back by store, date and flag.
    keys = ["store_id", "visit_date", "flag"]
    oof, tst, _ = mdl.crossfit(tr, te, cols, label="y", k=4, keys=keys, bags=STACK_BAGS)
    third = F.col("pred_stack") * THIRD_LAYER_ALPHA + F.col("pred_blend") * (1.0 - THIRD_LAYER_ALPHA)
    return [rows.join(p.select(*keys, F.col("pred").alias("pred_stack")), keys).withColumn("pred_3rd", third)
            for rows, p in ((tr, oof), (te, tst))]


def ens_stack(spark, d):
    tr, te = _stacked(spark, d)
    cols = ["store_id", "visit_date", "flag", "pred_stack", "pred_3rd"]
    a = tr.select(F.lit("train_all").alias("set"), *cols)
    return finalize(a.unionByName(te.select(F.lit("test").alias("set"), *cols)))


def stack_rows(spark, d):
    """Rows of the stack by set, flag and fold, and how many have a finite prediction."""
    tr, te = _stacked(spark, d)
    ok = lambda c: F.count_if(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")))
    by = lambda rows, name, fold: (rows.withColumn("fold", fold).groupBy("flag", "fold")
                                   .agg(F.count(F.lit(1)).alias("n_rows"), ok("pred_stack").alias("n_finite")).withColumn("set", F.lit(name)))
    both = by(tr, "train_all", F.col("fold")).unionByName(by(te, "test", F.lit(-1).cast("long")))
    return finalize(both.select("set", "flag", "fold", "n_rows", "n_finite"))


def score_stack(spark, d):
    tr, _ = _stacked(spark, d)
    layers = F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("pred"))
                                 for c in ("pred_blend", "pred_stack", "pred_3rd")])).alias("p")
    long = tr.select("flag", "y", layers).select("flag", "y", "p.layer", "p.pred")
    return finalize(met.horizon_score(long, "y", "pred", by=["layer"]).select("layer", "s1", "s2", "total", "n_unscored"))
