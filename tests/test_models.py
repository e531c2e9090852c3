"""MLlib keys: row counts, one prediction per key, finite values, and a
better score than a constant predictor (checked on a small synthetic
target derived from the test tables)."""

import math

from pyspark.sql import functions as F

from tidecast.functions.scalars import fold_of
from tidecast.operators import models as mdl
from tidecast.operators.encoders import geo_clusters
from tidecast.operators.metrics import rmsle
from tidecast.plans.frames import Frames
from tidecast.operators.origins import TRAIN_ALL


def _frame(spark, sf):
    fr = Frames(spark, sf)
    t = fr.train_targets(TRAIN_ALL, decorate=False)
    from tidecast.operators.lags import lag_features
    lags = lag_features(t, fr.hist, {"l7": 7, "l14": 14, "l28": 28}).fillna(-1.0)
    df = t.select("origin_id", "store_id", "visit_date", "dow").join(lags, ["origin_id", "store_id", "visit_date"])
    # The table values are random, so lags carry no signal; the label is a
    # function of the features (from the same rows) so that fitting can be
    # judged against a constant predictor.
    df = df.withColumn("y", F.col("l7") * 0.5 + F.col("dow") * 0.3)
    return df.withColumn("fold", fold_of(3, "store_id", "visit_date"))


def test_crossfit_predicts_every_row_once(spark, sf_small):
    df = _frame(spark, sf_small).cache()
    test = df.where(F.col("origin_id") == 1)
    oof, tst, model = mdl.crossfit(df, test, ["dow", "l7", "l14", "l28"], k=3, params=dict(maxIter=5, maxDepth=3))
    n = df.count()
    assert oof.count() == n
    assert oof.select("store_id", "visit_date").distinct().count() == n
    assert tst.count() == test.count()
    assert all(math.isfinite(r.pred) for r in oof.collect())
    joined = oof.join(df.select("store_id", "visit_date", "y"), ["store_id", "visit_date"])
    model_score = rmsle(joined, "y", "pred").collect()[0].rmsle
    mean_y = df.agg(F.avg("y")).collect()[0][0]
    const_score = rmsle(joined.withColumn("c", F.lit(mean_y)), "y", "c").collect()[0].rmsle
    assert model_score < const_score
    imp = mdl.importance(model, ["dow", "l7", "l14", "l28"], spark).collect()
    assert len(imp) == 4 and imp[0].score >= imp[-1].score


def test_geo_clusters_label_every_store(spark, sf_small):
    st = Frames(spark, sf_small).fx.stores
    out = geo_clusters(st, k=3, seed=0)
    assert out.count() == st.count()
    assert out.where(F.col("cluster").isNull()).count() == 0
    assert out.select("cluster").distinct().count() <= 3


def test_bagged_fit_one_row_per_key(spark, sf_small):
    df = _frame(spark, sf_small).cache()
    test = df.where(F.col("origin_id") == 1)
    out = mdl.bagged_fit(df, test, ["dow", "l7"], seeds=(0, 1), params=dict(maxIter=3, maxDepth=2))
    assert out.count() == test.count()
