"""Properties: leakage, multi-origin = single-origin, partition
independence, exact distributed median."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators.history import expanding_stats, level_stats
from tidecast.operators.impute import column_medians
from tidecast.operators.lags import lag_features, lag_names
from tidecast.operators.origins import TRAIN_ALL, OriginSet, assign_origin
from tidecast.operators.trailing import trailing_stats
from tidecast.plans.frames import Frames

STAT_ORDER = ["origin_id", "store_id"]


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    def key(v):
        if v is None:
            return (1, "")
        return (0, round(v, 9) if isinstance(v, float) else v)
    return sorted(tuple(key(v) for v in r) for r in df.select(*cols).collect())


def test_leakage_facts_after_cutoff_do_not_change_features(spark, sf_small):
    fr = Frames(spark, sf_small)
    hist = fr.hist.select("store_id", "visit_date", "y", "dow", "weight")
    o = 3
    cutoff = TRAIN_ALL.ini - dt.timedelta(days=39 * o)
    noisy = hist.withColumn("y", F.when(F.col("visit_date") >= F.lit(cutoff), F.col("y") * 10 + 1)
                            .otherwise(F.col("y")))
    pick = lambda df: df.where(F.col("origin_id") == o)
    a = pick(trailing_stats(hist, TRAIN_ALL, [5, 30]))
    b = pick(trailing_stats(noisy, TRAIN_ALL, [5, 30]))
    assert _rows(a) == _rows(b)
    la = pick(level_stats(hist, TRAIN_ALL, ["store_id", "dow"]))
    lb = pick(level_stats(noisy, TRAIN_ALL, ["store_id", "dow"]))
    assert _rows(la) == _rows(lb)
    t = assign_origin(fr.fx.visits, TRAIN_ALL).where(F.col("origin_id") == o)
    names = lag_names(days=(1, 5), weeks=(1, 4))
    assert _rows(lag_features(t, hist, names)) == _rows(lag_features(t, noisy, names))


def test_multi_origin_equals_single_origin(spark, sf_small):
    fr = Frames(spark, sf_small)
    hist = fr.hist
    o = 4
    single = OriginSet("one", TRAIN_ALL.ini - dt.timedelta(days=39 * (o - 1)), 39, 39, 1, 0)
    multi = trailing_stats(hist, TRAIN_ALL, [10, 50]).where(F.col("origin_id") == o).drop("origin_id")
    one = trailing_stats(hist, single, [10, 50]).drop("origin_id")
    assert _rows(multi) == _rows(one)
    em = expanding_stats(hist, TRAIN_ALL, ["store_id", "dow"]).where(F.col("origin_id") == o).drop("origin_id")
    lm = level_stats(hist, single, ["store_id", "dow"]).select("store_id", "dow", "wmean", "ymax", "ymin", "ycnt")
    assert _rows(em) == _rows(lm)


def test_partition_independence(spark, sf_small):
    from tidecast.plans import catalog
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = _rows(catalog.target_encode_oof_q(spark, sf_small))
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = _rows(catalog.target_encode_oof_q(spark, sf_small))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert a == b


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
def test_exact_median_matches_numpy(spark, n):
    rnd = random.Random(n)
    xs = [float(rnd.randint(-5, 50)) if n > 5 else rnd.random() for _ in range(n)]
    ys = [rnd.gauss(0, 1) for _ in range(n)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    got = {r.name: r.median for r in column_medians(df, ["x", "y"], partitions=5).collect()}
    assert got["x"] == pytest.approx(float(np.median(xs)))
    assert got["y"] == pytest.approx(float(np.median(ys)))


def test_tile_assignment_matches_range_join(spark, sf_small):
    fr = Frames(spark, sf_small)
    v = fr.fx.visits
    tiled = assign_origin(v, TRAIN_ALL).select("origin_id", "store_id", "visit_date")
    o = TRAIN_ALL.origins(spark)
    ranged = v.join(o, (v.visit_date >= o.begin) & (v.visit_date <= o.end)).select(
        "origin_id", "store_id", "visit_date")
    assert _rows(tiled) == _rows(ranged)
