"""Key -> Spark query and key -> SQL twin."""

from __future__ import annotations

from tidecast.plans import catalog as c

QUERIES = {
    "scan_visits": c.scan_visits,
    "calendar_padded": c.calendar_padded,
    "calendar_neighbours": c.calendar_neighbours,
    "calendar_holiday_rev": c.calendar_holiday_rev,
    "calendar_weight": c.calendar_weight,
    "log_target": c.log_target,
    "id_parse": c.id_parse,
    "booking_parse": c.booking_parse,
    "facts_enriched": c.facts_enriched,
    "origin_targets": c.origin_targets,
    "origin_history": c.origin_history,
    "segment_filter": c.segment_filter,
    "hist_stats_dow": c.hist_stats_dow,
    "hist_stats_dowhol": c.hist_stats_dowhol,
    "hist_stats_dowhol_nb": c.hist_stats_dowhol_nb,
    "hist_stats_dowhol_prev": c.hist_stats_dowhol_prev,
    "hist_stats_dowhol_rev": c.hist_stats_dowhol_rev,
    "store_dim": c.store_dim,
    "label_encode": c.label_encode,
    "one_hot": c.one_hot,
    "one_hot_full": c.one_hot_full,
    "one_hot_open": c.one_hot_open,
    "geo_clusters": c.geo_clusters,
    "fold_assign": c.fold_assign,
    "bridge_join": c.bridge_join_q,
    "weather_join": c.weather_join_q,
    "hist_stats_multi": c.hist_stats_multi,
    "lag_daily": c.lag_daily,
    "lag_weekly": c.lag_weekly,
    "lag_booking": c.lag_booking_q,
    "lag_days_all": c.lag_days_all,
    "lag_booking_days": c.lag_booking_days,
    "trailing_all": c.trailing_all,
    "trailing_dow_all": c.trailing_dow_all,
    "booking_dow_origins": c.booking_dow_origins,
    "trailing_stats": c.trailing_stats_q,
    "trailing_stats_weeks": c.trailing_stats_weeks,
    "trailing_diffs": c.trailing_diffs_q,
    "trailing_dow_mean": c.trailing_dow_mean,
    "trailing_dow_full": c.trailing_dow_full,
    "booking_stats": c.booking_stats_q,
    "booking_stats_ext": c.booking_stats_ext,
    "booking_dow": c.booking_dow_q,
    "target_encode_hist": c.target_encode_hist_q,
    "target_encode_more": c.target_encode_more,
    "target_encode_cluster": c.target_encode_cluster,
    "target_encode_oof": c.target_encode_oof_q,
    "fill_and_count": c.fill_and_count_q,
    "union_train_test": c.union_train_test_q,
    "impute_sentinel": c.impute_sentinel_q,
    "impute_inf_zero": c.impute_inf_zero,
    "impute_inf_median": c.impute_inf_median,
    "interactions": c.interactions,
    "feature_select": c.feature_select,
    "backtest_split": c.backtest_split,
    "ens_gather": c.ens_gather,
    "ens_corr": c.ens_corr,
    "ens_blend": c.ens_blend,
    "ens_blend3": c.ens_blend3,
    "score_rmsle": c.score_rmsle,
    "score_horizon": c.score_horizon,
    "backtest_scores": c.backtest_scores,
    "submission_build": c.submission_build,
    "submission_adjust": c.submission_adjust,
    "submission_ensemble": c.submission_ensemble,
    "yoy_compare": c.yoy_compare_q,
    "dataset_test": c.dataset_test,
    "dataset_rolling": c.dataset_rolling,
    "dataset_train1": c.dataset_train1,
    "dataset_train2": c.dataset_train2,
    "features_incremental": c.features_incremental,
    "model_inputs": c.model_inputs_q,
    "backtest_gbt_rows": c.backtest_gbt_rows,
    "backtest_gbt": c.backtest_gbt,
    "first_stage": c.first_stage,
    "crossfit_gbt": c.crossfit_gbt,
    "bagged_fit": c.bagged_fit,
    "ens_stack": c.ens_stack,
    "stack_rows": c.stack_rows,
    "score_stack": c.score_stack,
    "feature_importance": c.feature_importance,
}


def oracle() -> dict[str, str]:
    from tidecast.plans.oracle import _q
    q = _q()
    return {k: v for k, v in q.items() if k in QUERIES}
