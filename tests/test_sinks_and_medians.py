"""Sinks by round trip, prediction gathering, medians without exchange reuse,
pruned scans."""

import datetime as dt

from pyspark.sql import functions as F

from tidecast.operators.impute import column_medians
from tidecast.operators.origins import TEST, TRAIN1, TRAIN2, TRAIN_ALL
from tidecast.plans import catalog
from tidecast.sources import sinks


def test_predictions_round_trip_and_models_1_and_10(spark, tmp_path):
    rows = [(m, s, float(10 * m + s)) for m in (1, 10, 2) for s in range(4)]
    df = spark.createDataFrame(rows, "model_id bigint, store_id bigint, pred double")
    sinks.write_predictions(df, str(tmp_path / "all"))
    got = sinks.gather_predictions(spark, str(tmp_path / "all"))
    assert sorted((r.model_id, r.store_id, r.pred) for r in got.collect()) == sorted(rows)
    paths = {}
    for m in (10, 1):  # one path is a prefix of the other
        paths[f"m{m}"] = str(tmp_path / f"m{m}")
        df.where(F.col("model_id") == m).drop("model_id").write.parquet(paths[f"m{m}"])
    got = sinks.gather_predictions(spark, paths).collect()
    assert all(r.pred == 10 * int(r.model_id[1:]) + r.store_id for r in got) and len(got) == 8


def test_feature_submission_importance_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 3.0)], "set string, store_id bigint, x double")
    sinks.write_features(df, str(tmp_path / "f"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "f")).select("set", "store_id", "x").collect())) == [("a", 1, 2.0), ("b", 2, 3.0)]
    sub = spark.createDataFrame([("s_2017", 1.5, 9)], "id string, visitors double, other bigint")
    sinks.write_submission(sub, str(tmp_path / "s"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "s")).collect()] == [("s_2017", "1.5")]
    imp = spark.createDataFrame([("x", 0.5)], "feature string, score double")
    sinks.write_importance(imp, str(tmp_path / "i"))
    assert spark.read.option("header", True).csv(str(tmp_path / "i")).columns == ["feature", "score"]


def test_medians_without_exchange_reuse(spark):
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(600_001).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3).cast("double").alias("y"))
        assert {r["name"]: r["median"] for r in column_medians(df, ["x", "y"], partitions=16).collect()} == {"x": 300_000.0, "y": 900_000.0}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_ranges_hold_every_window(spark):
    for oset in (TRAIN_ALL, TRAIN1, TRAIN2, TEST):
        first, last = oset.target_range()
        day = dt.timedelta(days=1)
        days = [(first - day * 3) + day * i for i in range((last - first).days + 7)]
        df = spark.createDataFrame([(d,) for d in days], "visit_date date")
        inside = [r.visit_date for r in df.where(oset.tile_of(F.col("visit_date")).isNotNull()).collect()]
        assert min(inside) == first and max(inside) == last
        low, high = oset.history_range(20)
        days = [(low - day * 3) + day * i for i in range((high - low).days + 7)]
        df = spark.createDataFrame([(d,) for d in days], "visit_date date")
        seen = [r.visit_date for r in df.where(F.size(oset.covering(F.col("visit_date"), 20)) > 0).collect()]
        assert min(seen) == low and max(seen) == high


def test_target_windows_prune_the_scan(spark, sf_small):
    plan = catalog.origin_targets(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" in plan.split("PushedFilters", 1)[1].split("]", 1)[0] and "GreaterThan" in plan
