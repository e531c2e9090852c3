"""Scores over whole inputs: rows without a value or prediction are counted."""

import math

from tidecast.operators.metrics import horizon_score, mean_score, rmsle

ROWS = [("a", 1, 1.0, 2.0), ("a", 1, 1.0, None), ("a", 2, 3.0, 3.5), ("a", 2, None, 1.0), ("b", 1, 2.0, None), ("b", 2, None, None)]


def _rows(spark):
    return spark.createDataFrame(ROWS, "m string, flag bigint, y double, pred double")


def test_rmsle_counts_the_unscored(spark):
    got = {r.m: r for r in rmsle(_rows(spark), by=["m"]).collect()}
    assert (got["a"].n, got["a"].n_unscored) == (2, 2)
    assert math.isclose(got["a"].rmsle, math.sqrt((1 + 0.25) / 2))
    assert (got["b"].n, got["b"].n_unscored, got["b"].rmsle) == (0, 2, None)
    whole = rmsle(_rows(spark)).collect()[0]
    assert (whole.n, whole.n_unscored) == (2, 4)


def test_horizon_score_counts_the_unscored(spark):
    got = {r.m: r for r in horizon_score(_rows(spark), by=["m"]).collect()}
    assert math.isclose(got["a"].total, (1.0 * 6 + 0.5 * 33) / 39) and got["a"].n_unscored == 2
    assert (got["b"].s1, got["b"].s2, got["b"].total, got["b"].n_unscored) == (None, None, None, 2)


def test_mean_score_skips_groups_without_score(spark):
    got = mean_score(rmsle(_rows(spark), by=["m"])).collect()
    assert all(math.isclose(r.mean_rmsle, math.sqrt(0.625)) for r in got)
    assert rmsle(_rows(spark).limit(0), by=["m"]).count() == 0
