"""Cells of a store: one row a store whatever the origins, medians and states
against plain Python, bracketed medians, tasks that follow the facts."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from tidecast.operators.history import by_store, gathered, level_cells, with_fallback
from tidecast.operators.impute import column_medians
from tidecast.operators.origins import TRAIN_ALL, OriginSet
from tidecast.plans.partitioning import FACTS_PER_TASK, store_partitions

OSET = OriginSet("s", dt.date(2001, 8, 1), split=6, skip=6, count=12)


def _history(spark):
    rng = random.Random(3)
    rows = [(s, OSET.ini - dt.timedelta(days=d), float(rng.randint(0, 9)), float(rng.randint(1, 5))) for s in (1, 2) for d in range(1, 150) if rng.random() < 0.5]
    return rows, spark.createDataFrame(rows, "store_id long, visit_date date, y double, weight double").withColumn("dow", F.weekday("visit_date").cast("long"))


def test_states_give_every_origin_its_statistics(spark):
    rows, h = _history(spark)
    days = [(s, o, dt.date(2001, 7, 2) + dt.timedelta(days=k)) for s in (1, 2) for o in range(1, 13) for k in range(7)]
    t = spark.createDataFrame([(o, s, d, d.weekday()) for s, o, d in days], "origin_id long, store_id long, visit_date date, dow long")
    got = with_fallback(t, h, OSET, [("store_id", "dow"), ("store_id",)], partitions=5).collect()
    assert len(got) == len(days)
    for r in got:
        cutoff = OSET.ini - dt.timedelta(days=6 * r.origin_id)
        seen = [x for x in rows if x[0] == r.store_id and x[1] < cutoff and x[1].weekday() == r.dow]
        ys = [x[2] for x in seen]
        assert (r.ymed, r.ymax, r.ymin, r.ycnt) == (statistics.median(ys), max(ys), min(ys), len(ys))
        assert abs(r.wmean - sum(x[2] * x[3] for x in seen) / sum(x[3] for x in seen)) < 1e-9


def test_cells_are_not_copied_to_origins(spark):
    _, h = _history(spark)
    cells = level_cells(h, OSET, [("store_id",)], partitions=3)
    assert cells.where("s < 1 or s > 12").count() == 0
    one = h.where(F.col("visit_date") < OSET.ini - dt.timedelta(days=100))
    assert level_cells(one, OSET, [("store_id",)]).count() == 2  # a state a store, for all twelve origins
    assert gathered(cells).count() == 2


def test_tasks_follow_the_facts(spark):
    few, many = store_partitions(spark, 10), store_partitions(spark, 400 * FACTS_PER_TASK + 1)
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions")) and many == 401
    assert by_store(spark.range(10).withColumnRenamed("id", "store_id"), 7).rdd.getNumPartitions() == 7


def test_medians_are_exact_with_ties_infinities_and_far_values(spark):
    rng = random.Random(5)
    inf = float("inf")
    cols = {"ties": [float(rng.choice([-1, 0, 2])) for _ in range(3001)], "wide": [rng.expovariate(1) ** 9 for _ in range(3001)],
            "low": [-inf] * 2000 + [1.0] * 1001, "gap": [0.0] * 1500 + [8.0] * 1500 + [None], "none": [None] * 3001}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(7)
    got = {r["name"]: r["median"] for r in column_medians(df, list(cols), partitions=3).collect()}
    assert got == {c: statistics.median(v for v in x if v is not None) for c, x in cols.items() if c != "none"}
    assert TRAIN_ALL.count == 9
