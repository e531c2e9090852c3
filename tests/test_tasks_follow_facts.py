"""Aggregates and joins of facts have tasks that follow the number of facts,
with the same rows."""

import datetime as dt
from functools import reduce

from tidecast.plans import partitioning
from tidecast.sources.tables import Fixtures


def _tables(spark, path):
    day = lambda k: dt.datetime(2001, 1, 1) + dt.timedelta(days=k)
    lines = [(o, o % 7, 1, 1.0 + o % 3, day(o % 40)) for o in range(400)] + [(1, None, 2, 2.0, day(3)), (2, 3, 2, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber long, l_quantity double, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(o, day(o % 30)) for o in range(400)], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")


def test_visits_and_bookings_move_to_tasks_that_follow_the_facts(spark, tmp_path, monkeypatch):
    _tables(spark, str(tmp_path))
    whole = Fixtures(spark, str(tmp_path))
    want = [sorted(map(str, df.collect())) for df in (whole.visits, whole.bookings)]
    monkeypatch.setattr(partitioning, "FACTS_PER_TASK", 20)
    parts = Fixtures(spark, str(tmp_path))
    assert [sorted(map(str, df.collect())) for df in (parts.visits, parts.bookings)] == want
    for df in (parts.visits, parts.bookings):
        assert "hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()
        assert ", 21)" in df._jdf.queryExecution().executedPlan().toString()  # 402 facts, 20 a task
    assert parts.visits.rdd.getNumPartitions() == 21


def test_train_and_test_rows_are_written_apart(spark, monkeypatch):
    from tidecast.plans import catalog
    from tidecast.session import stored
    tags = []
    monkeypatch.setattr(catalog, "stored", lambda df, tag: tags.append(tag) or stored(df, tag))
    day = dt.date(2001, 1, 1)
    train = spark.createDataFrame([(1, day, 3, 1.5, -1.0, float("inf")), (2, day, 4, 2.5, 5.0, 2.0)], "store_id long, visit_date date, visitors long, y double, a double, b double")
    test = spark.createDataFrame([(1, day, 7.0, -1.0), (2, day, 9.0, 4.0), (2, day, 9.0, 4.0)], "store_id long, visit_date date, a double, b double")
    tr, te = catalog.model_inputs(train, test, ["a", "b"], ["a"], ["b"])
    assert len(tags) == 2
    assert sorted(map(tuple, tr.collect())) == [(0, 1, day, 1.5, 7.0, 0.0), (0, 2, day, 2.5, 5.0, 2.0)]
    assert sorted(map(tuple, te.collect())) == [(1, 1, day, None, 7.0, -1.0), (1, 2, day, None, 9.0, 4.0), (1, 2, day, None, 9.0, 4.0)]


def _stores_with_visits(spark, path):
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey long, r_name string").write.parquet(f"{path}/region.parquet")
    spark.createDataFrame([(0, "FRANCE", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{path}/nation.parquet")
    # Supplier 3 comes twice; 9 has no line items, and the line items of None no supplier.
    spark.createDataFrame([(s, 0, float(s)) for s in (1, 2, 3, 3, 9)], "s_suppkey long, s_nationkey long, s_acctbal double").write.parquet(f"{path}/supplier.parquet")
    day = lambda k: dt.datetime(2001, 7, 31) - dt.timedelta(days=k)
    lines = [(s, 1.0 + (s * k) % 5, day(k)) for s in (1, 2, 3) for k in range(0, 1000, s)] + [(None, 2.0, day(4)), (1, 2.0, None)]
    spark.createDataFrame(lines, "l_suppkey long, l_quantity double, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")


def test_naive_rows_are_the_same_on_tasks_that_follow_the_targets(spark, tmp_path, monkeypatch):
    from tidecast.operators.origins import TEST, TRAIN_ALL
    from tidecast.plans.frames import Frames
    from tidecast.plans.naive import naive_history, naive_wide
    _stores_with_visits(spark, str(tmp_path))

    def both():
        fr = Frames(spark, str(tmp_path))
        hist = naive_history(fr, TEST)
        return [naive_wide(fr, TRAIN_ALL, fr.train_targets(TRAIN_ALL, by_day_flag=True, decorate=False), hist),
                naive_wide(fr, TEST, fr.test_targets(decorate=False), hist)]

    rows = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
    want = [rows(df) for df in both()]
    fr = Frames(spark, str(tmp_path))
    assert want[0] == rows(naive_wide(fr, TRAIN_ALL, fr.train_targets(TRAIN_ALL, by_day_flag=True, decorate=False)))
    monkeypatch.setattr(partitioning, "FACTS_PER_TASK", 100)
    assert Frames(spark, str(tmp_path)).tasks == 19  # 1,836 facts, a third of them targets
    found = both()
    assert [rows(df) for df in found] == want
    assert found[0].rdd.getNumPartitions() == -(-len(want[0]) // 100) < 10


def test_predictions_meet_their_rows_on_tasks_that_follow_them(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tidecast.operators import models as mdl
    rows = spark.createDataFrame([(i, i % 2, float(i % 7), float(i % 7) * 0.5) for i in range(200)], "store_id long, fold long, a double, y double")
    test = spark.createDataFrame([(i, float(i % 7)) for i in (0, 1, 2, 2)], "store_id long, a double")
    monkeypatch.setattr(partitioning, "FACTS_PER_TASK", 25)
    seen = []
    monkeypatch.setattr(mdl, "side_by_side", lambda spark, jobs, *most: seen.extend(job() for job in jobs) or seen)
    oof, tst, last = mdl.crossfit(rows, test, ["a"], keys=["store_id"], k=2, bags=3, params=dict(maxIter=2))
    assert oof.rdd.getNumPartitions() == 8
    assert oof.count() == 200 and last is seen[-1] and len(seen) == 6
    # Bags 0 to 2 are the models of fold 0, and so on; a key's test rows give one.
    whole = mdl._assemble(rows, ["a"])
    one = lambda models, df: (reduce(lambda a, b: a.unionByName(b), [m.transform(df).select("store_id", "pred") for m in models])
                              .groupBy("store_id").agg(F.avg("pred").alias("pred")))
    want = one(seen[:3], whole.where("fold = 0")).unionByName(one(seen[3:], whole.where("fold = 1")))
    near = lambda df: {r.store_id: round(r.pred, 9) for r in df.collect()}
    assert near(oof) == near(want)
    assert tst.count() == 3 and near(tst) == near(one(seen, mdl._assemble(test, ["a"])))


def test_fewer_fits_side_by_side_on_many_rows():
    from tidecast.operators import models as mdl
    assert [mdl.fits_at_once(n, 3) for n in (0, 75_000, 4_500_000, 27_000_000, 10**9)] == [8, 8, 8, 2, 2]
