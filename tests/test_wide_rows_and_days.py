"""Wide rows: rounding without a decimal text, lookups that leave the cells map
out of the rows, days of a store against brute force, fits side by side."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidecast.functions.scalars import rounded, rounded_in_bulk
from tidecast.operators import models as mdl
from tidecast.operators.history import gathered, level_cells, pick_levels
from tidecast.operators.origins import OriginSet
from tidecast.plans.dataset import day_features, store_days
from tidecast.plans.frames import finalize

OSET = OriginSet("s", dt.date(2001, 8, 1), split=6, skip=6, count=5)


def test_rounding_in_bulk_gives_the_same_doubles(spark):
    rng, inf = random.Random(1), float("inf")
    values = [None, 0.0, -0.0, 1e-7, -1e-7, 5e-7, -5e-7, 4.9999995e-7, 1.0000005, 2.5e-6, -2.5e-6, inf, -inf, float("nan"), 1e300, 1e15 + 0.3, 1e12 + 0.1]
    values += [rng.uniform(-10, 10) for _ in range(3000)] + [round(rng.uniform(-10, 10), 7) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(rounded("x").cast("string").alias("a"), rounded_in_bulk("x").cast("string").alias("b"))
    assert df.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_wide_results_are_rounded_in_bulk_and_others_as_before(spark):
    plan = lambda n: finalize(spark.range(1).select(*[(F.col("id") / 3).alias(f"c{i}") for i in range(n)]))._jdf.queryExecution().analyzed().toString().lower()
    assert "rint" in plan(101) and "rint" not in plan(100)


def test_lookups_drop_the_cells_at_once(spark):
    h = spark.createDataFrame([(1, dt.date(2001, 7, 1), 2.0, 1.0)], "store_id long, visit_date date, y double, weight double")
    t = spark.createDataFrame([(1, 1), (5, 1), (1, 2)], "origin_id long, store_id long")
    rows = t.join(gathered(level_cells(h, OSET, [("store_id",)])), "store_id", "left")
    out = pick_levels(rows, {"a_": [("store_id",)]}, [("store_id",)], more={"_x": F.col("origin_id")})
    assert "cells" not in out.columns
    assert sorted((r.store_id, r.origin_id, r.a_ymed, r.a_ycnt, r._x) for r in out.collect() if r.store_id == 1) == [(1, 1, 2.0, 1, 1), (1, 5, 2.0, 1, 5)]


def test_days_of_a_store_have_a_place_each(spark):
    rng = random.Random(4)
    first = OSET.target_range()[0] - dt.timedelta(days=140)
    # Store None comes too, and one of the stores twice, as after a join with a repeated key.
    visits = [(s, first + dt.timedelta(days=d), rng.random()) for s in (1, 2, None) for d in range(0, 170) if rng.random() < 0.3]
    visits += [v for v in visits if v[0] == 2]
    booked = [(s, first + dt.timedelta(days=d), k, rng.randint(1, 9)) for s in (1, None) for d in range(0, 165, 3) for k in (1, 3, 5)]
    hist = spark.createDataFrame(visits, "store_id long, visit_date date, y double")
    cube = spark.createDataFrame([(s, d, k, n, 1, 3, 9, 1) for s, d, k, n in booked], "store_id long, visit_date date, k long, s long, n long, h long, hh long, nh long")
    days = store_days(hist, cube, OSET, first, 3)
    assert "Window" not in days._jdf.queryExecution().optimizedPlan().toString()
    targets = [(o, s, OSET.ini - dt.timedelta(days=6 * o - k), OSET.ini - dt.timedelta(days=6 * o)) for o in range(1, 6) for s in (1, 2, 3, None) for k in range(6)]
    base = spark.createDataFrame(targets, "origin_id long, store_id long, visit_date date, cutoff date")
    got = day_features(base, hist, cube, OSET, 3).collect()
    assert len(got) == len(targets)
    y = {(s, d): v for s, d, v in visits}
    for r in got:
        for name, back in (("lag_1d", 1), ("lag_5d", 5), ("lag_20w", 140)):
            day = r.visit_date - dt.timedelta(days=back)
            assert r[name] == (y.get((r.store_id, day)) if day < r.cutoff else None)
        sums = lambda back: [n for s, d, k, n in booked if (s, d) == (r.store_id, r.visit_date - dt.timedelta(days=back)) and k >= r.origin_id]  # noqa: E731, B023
        assert r.lag_res_2w == (sum(sums(14)) or None) and r.lag_res_20w == (sum(sums(140)) or None)
        assert (r.res_ttl, r.res_cnt) == ((sum(sums(0)), len(sums(0))) if sums(0) else (None, None))


def test_bags_and_backtests_run_fewer_fits_side_by_side_on_many_rows(spark, monkeypatch):
    day = dt.date(2001, 8, 1)
    rows = spark.createDataFrame([(i, day - dt.timedelta(days=i % 60 + 1), float(i % 7), float(i % 7) * 0.5) for i in range(300)], "store_id long, visit_date date, a double, y double")
    monkeypatch.setattr(mdl, "AT_ONCE_BYTES", 2000)
    seen, real = [], mdl.side_by_side
    monkeypatch.setattr(mdl, "side_by_side", lambda spark, jobs, at_once=mdl.AT_ONCE: seen.append(at_once) or real(spark, jobs, at_once))
    assert mdl.backtest_model_scores(rows, ["a"], day, 10, params=dict(maxIter=1, maxDepth=1)).where("rmsle is not null").count() == 5
    out = mdl.bagged_fit(rows, rows.limit(20).unionByName(rows.limit(1)), ["a"], params=dict(maxIter=1))
    assert out.count() == 20 and out.where("pred is null").count() == 0
    assert seen == [2, 2]


def test_the_sets_of_the_first_stage_run_side_by_side_unless_rows_are_many(spark, monkeypatch):
    import threading

    from tidecast.plans import catalog, dataset
    day = dt.date(2001, 8, 1)
    rows = spark.createDataFrame([(1, day, 1, 1.0), (2, day, 2, 2.0)], "store_id long, visit_date date, flag long, y double")
    monkeypatch.setattr(dataset, "build_dataset", lambda fr, oset, test=False: rows)
    monkeypatch.setattr(catalog, "model_inputs", lambda train, test, *cols: (train, test))
    at, most, lock, meet = [0], [0], threading.Lock(), threading.Event()

    def crossfit(train, test, feats, label, k):
        with lock:
            at[0] += 1
            most[0] = max(most[0], at[0])
        if at[0] == 2:
            meet.set()
        meet.wait(2)
        with lock:
            at[0] -= 1
        return None, test.select("store_id", "visit_date", F.lit(0.5).alias("pred")), None

    monkeypatch.setattr(mdl, "crossfit", crossfit)
    want = [(1, 1, day, 0.5), (2, 2, day, 0.5)]
    assert sorted(map(tuple, catalog.first_stage(spark, "none").collect())) == want and most == [2]
    most[0] = 0
    meet.clear()
    monkeypatch.setattr(mdl, "AT_ONCE_BYTES", 1000)
    assert sorted(map(tuple, catalog.first_stage(spark, "none").collect())) == want and most == [1]
