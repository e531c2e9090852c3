"""The whole feature dataset for every origin of a set.

Three inputs, reduced to (store, day) grain, are written once: targets,
history and the booking cube. Features of a target's own date (lags of visits
and of bookings, bookings of the day) are window frames over one day axis per
store. Features of an origin (history levels, trailing windows, weekday means)
are emitted as long rows (store, slot, state, values), united and gathered into
one row a store, so the wide frame is joined once with them, however many blocks
and origins there are. All of it is partitioned by store, into tasks that follow
the number of facts, so a task's memory doesn't grow with the tables.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.scalars import fold_of
from tidecast.operators.bookings import booking_cube, booking_dow_cells, stats_of_sums
from tidecast.operators.covariates import weather_join
from tidecast.operators.encoders import one_hot
from tidecast.operators.history import by_store, cell_of, gathered, level_cells, pick_levels
from tidecast.operators.impute import fill_and_count
from tidecast.operators.lags import DAY_LAGS, WEEK_LAGS, lag_names, needed_days, sum_known
from tidecast.operators.origins import TEST, OriginSet
from tidecast.operators.target_encoding import BASE_KEYSETS, target_encode_hist, target_encode_oof
from tidecast.operators.trailing import DOW_WEEKS, TRAIL_DAYS, trailing_dow, trailing_stats
from tidecast.session import stored
from tidecast.sources.sinks import write_features, written_origins
from tidecast.sources.tables import AREA_L3_LEVELS, INI, WEATHER_LEVELS
from tidecast.plans.frames import CAL_COLS, STORE_COLS, STORE_LABELS, Frames
from tidecast.plans.partitioning import BROADCAST_MAX_ROWS, distinct_count, spread

KEYS = ["origin_id", "store_id", "visit_date"]
STATS = ("wmean", "ymax", "ymin", "ymed", "ycnt")
# Prefix of the history statistics -> key columns of their fallback levels.
HIST_FAMILIES = {
    "dow_all": [("store_id", "dow"), ("store_id",)],
    **{f"{name}_all": [("store_id", "dow", flag), ("store_id", "dow"), ("store_id",)]
       for name, flag in (("dowhol", "holiday_flg"), ("dowhol_next", "holiday_next1d"),
                          ("dowhol_prev", "holiday_prev1d"), ("dowhol_rev", "holiday_rev"))},
}
# Columns given as 0/1 dummies -> their levels (the first one is dropped).
DUMMIES = {"dow": range(7), "month": range(1, 13), "area_l3_lbl": range(AREA_L3_LEVELS),
           "weather_lbl": range(len(WEATHER_LEVELS))}
BOOK_COLS = ("res_ttl", "res_cnt", "res_mean", "res_hr_std")
BOOK_DOW_COLS = ("party_mean_dow", "cnt_mean_dow")


def feature_columns() -> list[str]:
    """Generated feature names, in output order (after keys)."""
    cols = list(CAL_COLS) + [c for c in STORE_COLS if c not in ("genre", "area_l1", "area_l2", "area_l3")]
    cols += [f"{c}_lbl" for c in STORE_LABELS] + [f"{p}_{s}" for p in HIST_FAMILIES for s in STATS]
    cols += list(BASE_KEYSETS) + list(BOOK_COLS) + list(BOOK_DOW_COLS)
    cols += list(lag_names(days=DAY_LAGS, weeks=WEEK_LAGS)) + list(lag_names(weeks=WEEK_LAGS, prefix="lag_res"))
    for d in TRAIL_DAYS:
        cols += [f"{a}_{d}d" for a in ("mean", "max", "min", "std")] + [f"scale_maxmin_{d}d", f"scale_std_{d}d"]
    cols += [f"mean_dow_{w}w" for w in DOW_WEEKS] + ["rainfall", "wind_max", "weather_lbl"]
    return cols + dummy_columns()


def dummy_columns() -> list[str]:
    return [f"{c}_{lvl}" for c, levels in DUMMIES.items() for lvl in list(levels)[1:]]


def imputed_columns() -> list[str]:
    """Columns whose -1 becomes the median in the model inputs: history
    statistics without their counts, target encodings, trailing windows."""
    cols = [f"{p}_{s}" for p in HIST_FAMILIES for s in STATS if s != "ycnt"] + list(BASE_KEYSETS)
    return cols + [f"{a}_{d}d" for d in TRAIL_DAYS
                   for a in ("mean", "max", "min", "std", "scale_maxmin", "scale_std")]


def trail_columns() -> list[str]:
    return [f"{a}_{d}d" for d in TRAIL_DAYS for a in ("mean", "max", "min", "std", "scale_maxmin", "scale_std")]


def _cells(block: DataFrame, slot: Column, cols: list[str]) -> DataFrame:
    return block.select("store_id", slot.alias("slot"), F.col("origin_id").alias("s"), F.array(*[F.col(c).cast("double") for c in cols]).alias("vals"))


def origin_cells(hist: DataFrame, cube: DataFrame, oset: OriginSet, levels: list[tuple], partitions: int | None = None) -> DataFrame:
    """(store_id, cells): every feature that belongs to an origin's view of a
    store, or of a store's weekday, from one union and one aggregate."""
    dow = F.col("dow").cast("string")
    levels_of = level_cells(hist, oset, levels, partitions=partitions)  # moves what it reads by itself
    # Blocks on one number of tasks would be united task by task, and such a task
    # is slower than one a block and holds the sorters of all.
    hist, cube = by_store(hist, partitions and partitions + 1), by_store(cube, partitions and partitions + 1)
    blocks = [
        levels_of,
        _cells(trailing_stats(hist, oset, TRAIL_DAYS), F.lit("trail"), trail_columns()),
        _cells(trailing_dow(hist, oset, DOW_WEEKS), F.concat(F.lit("week:"), dow), [f"mean_dow_{w}w" for w in DOW_WEEKS]),
        _cells(booking_dow_cells(cube, oset), F.concat(F.lit("book:"), dow), list(BOOK_DOW_COLS)),
    ]
    return gathered(by_store(reduce(DataFrame.unionByName, blocks).where(F.col("store_id").isNotNull() & F.col("slot").isNotNull()), partitions))


def _unpack(df: DataFrame, levels: list[tuple]) -> DataFrame:
    """Columns from the ``cells`` map."""
    dow = F.col("dow").cast("string")
    of = {"_trail": cell_of(F.lit("trail")), "_week": cell_of(F.concat(F.lit("week:"), dow)), "_book": cell_of(F.concat(F.lit("book:"), dow))}
    df = pick_levels(df, {f"{p}_": lv for p, lv in HIST_FAMILIES.items()}, levels, more=of)
    new = {c: F.get("_trail", F.lit(i)) for i, c in enumerate(trail_columns())}
    new |= {f"mean_dow_{w}w": F.get("_week", F.lit(i)) for i, w in enumerate(DOW_WEEKS)}
    new |= {c: F.get("_book", F.lit(i)) for i, c in enumerate(BOOK_DOW_COLS)}
    return df.withColumns(new).drop(*of)


def store_days(hist: DataFrame, cube: DataFrame, oset: OriginSet, first: dt.date, partitions: int | None = None) -> DataFrame:
    """(_store, _none, days): a row a store with its visits and bookings by day, as
    one array of (y, known) from ``first`` on; a day without any is null.
    ``known`` has an entry for each origin that first knows bookings of that day."""
    longest = (oset.target_range()[0] - first).days
    entry = F.struct("k", "s", "n", "h", "hh", "nh")
    known = (by_store(needed_days(cube, oset, longest), partitions).groupBy("store_id", "visit_date")
             .agg(F.collect_list(entry).alias("known")))
    visits = needed_days(hist, oset, longest).select("store_id", "visit_date", "y")
    facts = visits.unionByName(known, allowMissingColumns=True)
    # Rows of one day are the same but for their nulls.
    day = F.datediff("visit_date", F.lit(first)).alias("i")
    one = (_keyed(facts.select("store_id", day, "y", "known"), partitions).groupBy("_store", "_none", "i")
           .agg(F.first("y", ignorenulls=True).alias("y"), F.first("known", ignorenulls=True).alias("known")))
    by_day = one.groupBy("_store", "_none").agg(F.sort_array(F.collect_list(F.struct("i", F.struct("y", "known").alias("day")))).alias("found"))
    gap = lambda x, i: x["i"] - F.coalesce(F.get("found", i - 1)["i"], F.lit(-1)) - 1
    empty = F.lit(None).cast(by_day.schema["found"].dataType.elementType["day"].dataType)
    return by_day.select("_store", "_none", F.flatten(F.transform("found", lambda x, i: F.concat(F.array_repeat(empty, gap(x, i)), F.array(x["day"])))).alias("days"))


def _keyed(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows moved by store to the tasks where ``by_store`` has them; those
    without a store meet under ``_none``."""
    df = df.withColumns({"_store": F.coalesce("store_id", F.lit(0)), "_none": F.col("store_id").isNull().cast("int")})
    return df.repartition(partitions, "_store") if partitions else df.repartition("_store")


def _of_store(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of their store's row in ``table``. The second
    condition is no join key, so that rows moved by ``_store`` stay."""
    table = table.withColumnsRenamed({"_store": "_store_of", "_none": "_none_of"})
    same = (F.col("_store") == F.col("_store_of")) & (F.col("_none") - F.col("_none_of") == 0)
    return rows.join(table, same, "left").drop("_store_of", "_none_of")


def day_features(base: DataFrame, hist: DataFrame, cube: DataFrame, oset: OriginSet, partitions: int | None = None) -> DataFrame:
    """``base`` with lags of visits and of known bookings, and the known
    bookings of the target date, read off each store's days; the rows keep the
    store key (_store, _none) by which they were moved."""
    lags = lag_names(days=DAY_LAGS, weeks=WEEK_LAGS)
    booked = lag_names(weeks=WEEK_LAGS, prefix="lag_res")
    first = oset.target_range()[0] - dt.timedelta(days=max([*lags.values(), *booked.values()]))
    days = store_days(hist, cube, oset, first, partitions)
    i = F.datediff("visit_date", F.lit(first))
    at = lambda d: F.get("days", i - d)
    out = _of_store(_keyed(base, partitions), days)
    sees = lambda x: x["k"] >= F.col("origin_id")
    new = {n: F.when(F.date_sub("visit_date", d) < F.col("cutoff"), at(d)["y"]) for n, d in lags.items()}
    # One projection, outside of whole-stage code by its lambdas: as part of a
    # stage's function it would make that too long to be compiled.
    new |= {n: sum_known(at(d)["known"], sees) for n, d in booked.items()}
    new |= {f"_{c}": sum_known(at(0)["known"], sees, c) for c in ("s", "n", "h", "hh", "nh")}
    out = out.select(*[c for c in out.columns if c != "days"], *[x.alias(n) for n, x in new.items()])
    out = out.withColumns(stats_of_sums(*[F.col(f"_{c}") for c in ("s", "n", "h", "hh", "nh")]))
    return out.drop(*[f"_{c}" for c in ("s", "n", "h", "hh", "nh")])


def build_dataset(fr: Frames, oset: OriginSet, test: bool = False, fill: bool = True) -> DataFrame:
    """Rows: targets of the set (visits in the windows, or the test grid).
    Columns: keys, set, flag, horizon_day, [visitors], categorical store
    attributes, every feature of ``feature_columns()``, na_cnt."""
    oset = TEST if test else oset
    t = fr.test_targets() if test else fr.train_targets(oset)
    t = t.join(fr.store_labels, "store_id", "left")
    codes = [f"{c}_lbl" for c in STORE_LABELS]
    label = [] if test else ["visitors", "y"]
    # Several blocks read some columns of these; each is written once to the shared checkpoint folder.
    base = stored(t.select(*KEYS, "cutoff", "horizon_day", "flag", *label, *CAL_COLS, *STORE_COLS, *codes), "targets")
    seen = fr.hist.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
    hist = stored(seen.select("store_id", "visit_date", "y", "dow", "holiday_flg", "holiday_next1d",
                              "holiday_prev1d", "holiday_rev", "weight", "genre", "area_l3"), "history")
    cube = stored(booking_cube(spread(fr.bookings, fr.fx.n_facts, "store_id", "visit_date"), oset), "bookings")

    # Target encodings: history means for the test origin, out-of-fold
    # means of the window's own labels for training origins. Keyed by
    # category: broadcast behind a bound from the store dimension. They come
    # first, as joins of narrow rows.
    n_cat = max(distinct_count(fr.stores, keys) for keys in BASE_KEYSETS.values() if "dow" not in keys)
    small = n_cat * 7 * oset.count * 5 <= BROADCAST_MAX_ROWS
    if test:
        out = target_encode_hist(base, hist.where(F.col("visit_date") < F.lit(INI)), BASE_KEYSETS, broadcast=small)
    else:
        fold = fold_of(5, "store_id", "visit_date")
        out = target_encode_oof(base.withColumn("fold", fold), BASE_KEYSETS, broadcast=small).drop("fold")
    out = day_features(out, hist, cube, oset, fr.tasks)

    levels = list(dict.fromkeys(lv for of in HIST_FAMILIES.values() for lv in of))
    # Written once: a task that also made the cells would hold the sorters of both sides of the join.
    cells = stored(origin_cells(hist, cube, oset, levels, fr.tasks), "cells")
    out = _unpack(_of_store(out, _keyed(cells, fr.tasks).drop("store_id")), levels)

    # Weather of the target day: (region, day) table, bounded by regions x days.
    lo, hi = fr.fx.span
    w_bound = distinct_count(fr.stores, ["area_l1"]) * ((hi - lo).days + 1 if lo else 0)
    out = weather_join(out, fr.fx.weather, cols=("rainfall", "wind_max", "weather_daytime"),
                       broadcast=w_bound <= BROADCAST_MAX_ROWS)
    place = F.array_position(F.array(*map(F.lit, WEATHER_LEVELS)), F.col("weather_daytime"))
    out = out.withColumn("weather_lbl", F.when(place > 0, place - 1))
    out = one_hot(out, list(DUMMIES), levels={c: list(v) for c, v in DUMMIES.items()}).fillna(0, dummy_columns())

    feats = feature_columns()
    cols = ["origin_id", "store_id", "visit_date", "horizon_day", "flag", *label,
            "genre", "area_l1", "area_l2", "area_l3", *feats]
    out = out.select(*cols).withColumn("set", F.lit(oset.name))
    if fill:
        out = fill_and_count(out, feats)
    return out


def refresh_features(fr: Frames, oset: OriginSet, path: str) -> list[int]:
    """S5 + J9: compute and write the origins of the set that ``path`` does not
    hold yet, one build per run of missing origins; the others are neither
    computed nor touched. Returns the origins written."""
    have = written_origins(fr.spark, path, oset.name)
    missing = [i for i in range(1, oset.count + 1) if i not in have]
    runs = [[i for _, i in g] for _, g in groupby(enumerate(missing), lambda x: x[1] - x[0])]
    for run in runs:
        df = build_dataset(fr, oset.part(run[0], run[-1]))
        write_features(df.withColumn("origin_id", F.col("origin_id") + (run[0] - 1)), path)
    return missing
