"""Windows, lags, medians, booking cube, sinks and encodings against brute
force; whole-dataset properties; datasets in a small heap."""

import datetime as dt
import os
import random
import statistics
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import bookings as bk
from tidecast.operators.encoders import level_codes, one_hot_vectors
from tidecast.operators.history import level_stats, with_fallback
from tidecast.operators.impute import replace_inf_median
from tidecast.operators.lags import lag_booking, lag_features
from tidecast.operators.models import side_by_side
from tidecast.operators.origins import TEST, TRAIN_ALL, OriginSet
from tidecast.operators.trailing import trailing_dow, trailing_stats
from tidecast.plans.dataset import build_dataset, refresh_features
from tidecast.plans.frames import Frames
from tidecast.sources.sinks import read_features, write_features, written_origins

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
INI = dt.date(2020, 3, 1)
SETS = [OriginSet("a", INI, 6, 6, 7), OriginSet("b", INI, 9, 9, 3, gap=4), OriginSet("c", INI, 30, 30, 1)]


@pytest.fixture(scope="module")
def facts():
    rng = random.Random(4)
    days = [INI - dt.timedelta(days=i) for i in range(-8, 120)]
    return [(s, d, rng.choice([1.0, 2.0, 2.0, 3.5, 7.0]), d.weekday(), rng.choice([0, 0, 1]), rng.random())
            for s in range(5) for d in days if rng.random() < (0.7, 0.1, 1.0, 0.02, 0.4)[s]]


@pytest.fixture(scope="module")
def history(spark, facts):
    return spark.createDataFrame(facts, "store_id long, visit_date date, y double, dow long, flag long, weight double")


def cutoffs(oset):
    return {i: oset.ini - dt.timedelta(days=oset.skip * i + oset.gap) for i in range(1, oset.count + 1)}


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


@pytest.mark.parametrize("oset", SETS, ids=lambda o: o.name)
@pytest.mark.parametrize("keys", [("store_id",), ("store_id", "dow"), ("store_id", "dow", "flag")])
def test_level_stats_equal_brute_force(history, facts, oset, keys):
    at = {"store_id": 0, "dow": 3, "flag": 4}
    want = {}
    for i, cutoff in cutoffs(oset).items():
        groups = defaultdict(list)
        for f in facts:
            if f[1] < cutoff:
                groups[tuple(f[at[k]] for k in keys)].append(f)
        for k, rows in groups.items():
            ys = [r[2] for r in rows]
            want[(i, *k)] = (sum(r[2] * r[5] for r in rows) / sum(r[5] for r in rows), statistics.fmean(ys), max(ys), min(ys), statistics.median(ys), len(ys))
    got = {(r.origin_id, *[r[k] for k in keys]): (r.wmean, r.mean, r.ymax, r.ymin, r.ymed, r.ycnt) for r in level_stats(history, oset, keys).collect()}
    assert got.keys() == want.keys()
    assert all(all(map(close, got[k], want[k])) for k in want)


@pytest.mark.parametrize("oset", SETS, ids=lambda o: o.name)
def test_trailing_windows_equal_brute_force(history, facts, oset):
    lengths = (1, 3, 7, 84)
    for keys, df, names in ((("store_id",), trailing_stats(history, oset, lengths), [f"{d}d" for d in lengths]),
                            (("store_id", "dow"), trailing_dow(history, oset, (1, 2, 12), aggs=("mean", "max", "min", "std")), ["dow_1w", "dow_2w", "dow_12w"])):
        spans = lengths if len(keys) == 1 else (7, 14, 84)
        got = {(r.origin_id, *[r[k] for k in keys]): r for r in df.collect()}
        seen = set()
        for i, cutoff in cutoffs(oset).items():
            groups = defaultdict(list)
            for f in facts:
                if 1 <= (cutoff - f[1]).days <= max(spans):
                    groups[(f[0],) if len(keys) == 1 else (f[0], f[3])].append(((cutoff - f[1]).days, f[2]))
            for k, rows in groups.items():
                seen.add((i, *k))
                for span, name in zip(spans, names):
                    ys = [y for age, y in rows if age <= span]
                    r = got[(i, *k)]
                    want = (statistics.fmean(ys), max(ys), min(ys)) if ys else (None,) * 3
                    assert all(map(close, (r[f"mean_{name}"], r[f"max_{name}"], r[f"min_{name}"]), want))
                    assert close(r[f"std_{name}"], statistics.stdev(ys) if len(ys) > 1 else None)
        assert seen == got.keys()


def test_lags_equal_brute_force(spark, history, facts):
    oset = SETS[1]
    value = {(f[0], f[1]): f[2] for f in facts}
    rows = [(i, s, c + dt.timedelta(days=oset.gap + k), c) for i, c in cutoffs(oset).items() for s in range(6) for k in range(9)]
    targets = spark.createDataFrame(rows, "origin_id long, store_id long, visit_date date, cutoff date")
    offsets = {f"l{d}": d for d in (1, 2, 9, 14, 50)}
    for bounded in (None, oset):
        got = {(r.origin_id, r.store_id, r.visit_date): r for r in lag_features(targets, history, offsets, oset=bounded).collect()}
        assert len(got) == len(rows)
        for i, s, d, c in rows:
            for n, k in offsets.items():
                day = d - dt.timedelta(days=k)
                assert got[i, s, d][n] == (value.get((s, day)) if day < c else None)


@pytest.fixture(scope="module")
def booked():
    rng = random.Random(9)
    out = []
    for _ in range(900):
        visit = INI - dt.timedelta(days=rng.randrange(-25, 60))
        out.append((rng.randrange(3), visit, visit - dt.timedelta(days=rng.choice([-1, 0, 1, 2, 5, 20, 40])), rng.randrange(24), visit.weekday(), rng.randrange(1, 9)))
    return out + [(0, INI, INI - dt.timedelta(days=10), 7, INI.weekday(), 2)] * 300  # a busy store day


@pytest.fixture(scope="module")
def bookings(spark, booked):
    return spark.createDataFrame(booked, "store_id long, visit_date date, reserve_date date, visit_hour long, dow long, reserve_visitors long")


@pytest.mark.parametrize("oset", SETS, ids=lambda o: o.name)
def test_booking_cube_equals_brute_force(spark, bookings, booked, oset):
    cube = bk.booking_cube(bookings, oset)
    got = {(r.origin_id, r.store_id, r.dow): (r.party_mean_dow, r.cnt_mean_dow) for r in bk.booking_dow_cells(cube, oset).collect()}
    want = {}
    for i, c in cutoffs(oset).items():
        days = defaultdict(list)
        for s, d, known, _, dow, n in booked:
            if known < c:
                days[s, dow, d].append(n)
        by_dow = defaultdict(list)
        for (s, dow, _), ns in days.items():
            by_dow[s, dow].append((statistics.fmean(ns), len(ns)))
        for (s, dow), v in by_dow.items():
            want[i, s, dow] = (statistics.fmean(x for x, _ in v), statistics.fmean(x for _, x in v))
    assert got.keys() == want.keys() and all(all(map(close, got[k], want[k])) for k in want)
    rows = [(i, s, c + dt.timedelta(days=oset.gap + k), c) for i, c in cutoffs(oset).items() for s in range(4) for k in range(oset.split)]
    targets = spark.createDataFrame(rows, "origin_id long, store_id long, visit_date date, cutoff date")
    for bounded in (None, oset):
        for r in lag_booking(targets, bookings, {"w1": 7, "d30": 30}, oset=bounded).collect():
            c = cutoffs(oset)[r.origin_id]
            for n, k in (("w1", 7), ("d30", 30)):
                parties = [b[5] for b in booked if b[0] == r.store_id and b[1] == r.visit_date - dt.timedelta(days=k) and b[2] < c]
                assert r[n] == (sum(parties) if parties else None)


def test_fallback_of_null_keys_and_unknown_stores(spark, history):
    t = spark.createDataFrame([(1, 0, None), (1, 99, 3), (1, 2, 3)], "origin_id long, store_id long, dow long")
    got = {(r.store_id, r.dow): r for r in with_fallback(t, history, SETS[2], [("store_id", "dow"), ("store_id",)]).collect()}
    assert got[0, None].wmean is not None and got[99, 3].ycnt is None and got[2, 3].ycnt < got[0, None].ycnt + 200


# -- imputation, encodings ---------------------------------------------------

def test_second_median_follows_the_first_replacement(spark):
    inf = float("inf")
    rng = random.Random(2)
    for n in (1, 2, 9, 60):
        xs = [[rng.choice([-inf, inf, -inf, 1.0, 2.0, 5.0, None, rng.random()]) for _ in range(2)] for _ in range(n)]
        got = [(r.x, r.y) for r in replace_inf_median(spark.createDataFrame([(i, *x) for i, x in enumerate(xs)], "i int, x double, y double"), ["x", "y"]).orderBy("i").collect()]
        for c in range(2):
            col = [x[c] for x in xs]
            m1 = statistics.median(v for v in col if v is not None) if any(v is not None for v in col) else None
            col = [m1 if v == -inf else v for v in col]
            m2 = statistics.median(v for v in col if v is not None) if any(v is not None for v in col) else None
            want = [m2 if v == inf else v for v in col]
            assert all(close(g[c], w) or (g[c] != g[c] and w != w) for g, w in zip(got, want))


def test_vectors_of_a_hundred_thousand_levels(spark):
    df = spark.range(120_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") * 7919 % 100_000).cast("string"), 6, "0")).alias("c"))
    codes = {r.c: r.c_lbl for r in level_codes(df, "c").collect()}
    assert sorted(codes, key=codes.get) == sorted(codes) and sorted(codes.values()) == list(range(100_000))
    for drop in (True, False):
        out = one_hot_vectors(df.where("id % 997 = 0").unionByName(df.limit(0)).union(df.where("id < 3")).union(df.where("c = 'v000000'").limit(1)), ["c"], drop_first=drop).collect()
        levels = sorted({r.c for r in out})
        for r in out:
            place = levels.index(r.c) - drop
            assert r.c_vec.size == len(levels) - drop
            assert list(r.c_vec.indices) == ([place] if place >= 0 else [])
    nulls = one_hot_vectors(spark.createDataFrame([("a",), (None,), ("b",)], "c string"), ["c"], drop_first=False).collect()
    assert {r.c: list(r.c_vec.toArray()) for r in nulls} == {"a": [1, 0], "b": [0, 1], None: [0, 0]}


def test_side_by_side_keeps_order_and_raises(spark):
    assert side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(12)]) == list(range(12))
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 / 0])
    assert side_by_side(spark, []) == []


# -- sink --------------------------------------------------------------------

def test_second_run_writes_one_origin_and_leaves_the_others(spark, sf_small, tmp_path):
    path, fr, two = str(tmp_path / "features"), Frames(spark, sf_small), TRAIN_ALL.part(1, 2)
    assert written_origins(spark, path, two.name) == set()
    write_features(build_dataset(fr, two.part(2, 2)).withColumn("origin_id", F.lit(2).cast("long")), path)

    def files(origin):
        base = f"{path}/set={two.name}/origin_id={origin}"
        return {f: os.stat(f"{base}/{f}").st_mtime_ns for f in os.listdir(base) if f.endswith(".parquet")}

    before = files(2)
    assert refresh_features(fr, two, path) == [1]
    assert files(2) == before and files(1)
    assert refresh_features(fr, two, path) == []
    back = read_features(spark, path, two.name)
    cols = sorted(back.columns)
    whole = build_dataset(fr, two)
    key = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert key(back.select(*cols).collect()) == key(whole.select(*cols).collect())
    plan = read_features(spark, path, two.name, [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "origin_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


# -- whole datasets ----------------------------------------------------------

class Changed(Frames):
    """The same tables with other facts from a day on."""

    def __init__(self, spark, sf_dir, since):
        super().__init__(spark, sf_dir)
        late = F.col("visit_date") >= F.lit(since)
        self.fx.__dict__["visits"] = self.fx.visits.withColumn("visitors", F.when(late, F.col("visitors") * 3 + 1).otherwise(F.col("visitors")))
        b = self.fx.bookings
        self.fx.__dict__["bookings"] = b.where(F.to_date("reserve_datetime") < F.lit(since))


def _same(a, b):
    key = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*sorted(df.columns)).collect())
    return key(a) == key(b)


def test_no_feature_of_the_test_set_sees_facts_from_its_cutoff_on(spark, sf_small):
    since = TEST.ini - dt.timedelta(days=TEST.skip)
    assert _same(build_dataset(Frames(spark, sf_small), TEST, test=True), build_dataset(Changed(spark, sf_small, since), TEST, test=True))


def test_dataset_does_not_depend_on_partitions(spark, sf_small):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = build_dataset(Frames(spark, sf_small), TRAIN_ALL.part(1, 3))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert _same(one, build_dataset(Frames(spark, sf_small), TRAIN_ALL.part(1, 3)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_no_session_setting_is_left_changed(spark, sf_small):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll
    build_dataset(Frames(spark, sf_small), TRAIN_ALL.part(1, 1))
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.getAll) == before


SMALL_HEAP = """
import sys, tempfile
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[8]").config("spark.driver.memory", "1000m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecast-test-ckpt-"))
from tidecast.plans import catalog
for key in ("dataset_test", "dataset_rolling", "dataset_train1"):
    getattr(catalog, key)(spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
print("all built")
"""


def test_datasets_fit_a_small_heap():
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")}
    run = subprocess.run([sys.executable, "-c", SMALL_HEAP.format(root=ROOT)], capture_output=True, text=True, timeout=900, env=env)
    assert "all built" in run.stdout, run.stderr[-2000:]


def test_percentile_free_median_of_many_values(spark):
    rng = np.random.default_rng(0)
    ys = rng.integers(0, 40, 5000) / 8
    rows = [(0, INI - dt.timedelta(days=1 + i % 90), float(y), 1.0) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "store_id long, visit_date date, y double, weight double")
    got = {r.origin_id: r.ymed for r in level_stats(df, SETS[0], ["store_id"]).collect()}
    for i, c in cutoffs(SETS[0]).items():
        assert got[i] == float(np.median([r[2] for r in rows if r[1] < c]))
