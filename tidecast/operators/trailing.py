"""Trailing windows anchored at each origin's cutoff.

A key's history and one anchor row per cutoff are put on one day axis; every
window length is a range frame ``[-D, -1]`` days before the anchor. History
is never copied per origin, one sort by (key, day) serves all lengths, and a
key's rows are bounded by the number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.scalars import guarded_ratio
from tidecast.operators.origins import OriginSet

TRAIL_DAYS = (5, 10, 20, 30, 50, 100)
TRAIL_WEEKS_DAYS = (7, 14, 28, 56, 84)
DOW_WEEKS = (2, 4, 8)
DOW_FULL_WEEKS = (3, 6, 9)
# The lengths in days and weeks that the models read, and the
# pairs of lengths whose means they subtract.
ALL_TRAIL_DAYS = (3, *range(7, 85, 7))
ALL_DOW_WEEKS = tuple(range(2, 11))
ALL_DOW_DIFFS = ((2, 4), (2, 6), (2, 8), (2, 10), (4, 6), (4, 8), (4, 10), (6, 8), (6, 10), (8, 10))
ALL_DIFFS = ((7, 14), (7, 28), (7, 56), (7, 84), (14, 28), (14, 56), (14, 84), (28, 56), (28, 84), (56, 84))


def scale_to_maxmin(mean, mx, mn):
    """(mean - min) / (max - min) with x/0 -> +-inf, 0/0 -> null."""
    return guarded_ratio(F.col(mean) - F.col(mn), F.col(mx) - F.col(mn))


def scale_to_std(mean, std):
    """Mean / std with the same division rules."""
    return guarded_ratio(F.col(mean), F.col(std))


def with_anchors(history: DataFrame, oset: OriginSet, keys: Sequence[str]) -> DataFrame:
    """(keys, _day, y, origin_id): history rows (origin_id null) and, for each
    key and origin, a row on the cutoff (y null). The anchors are made from
    each key's last row, so history is read once."""
    day = F.unix_date("visit_date").cast("int")
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_day").desc())) == 1
    h = history.select(*keys, day.alias("_day"), "y").withColumn("_last", last)
    row = lambda d, y, o: F.struct(d.cast("int").alias("_day"), y.cast("double").alias("y"), o.cast("long").alias("origin_id"))
    own = F.array(row(F.col("_day"), F.col("y"), F.lit(None)))
    anchors = F.transform(F.sequence(F.lit(1).cast("long"), F.lit(oset.count).cast("long")),
                          lambda o: row(F.unix_date(oset.cutoff_of(o)), F.lit(None), o))
    return h.select(*keys, F.explode(F.when(F.col("_last"), F.concat(own, anchors)).otherwise(own)).alias("_r")).select(*keys, "_r.*")


def trailing_stats(history: DataFrame, oset: OriginSet, days: Sequence[int] = TRAIL_DAYS,
                   keys: Sequence[str] = ("store_id",), scales: bool = True,
                   aggs: Sequence[str] = ("mean", "max", "min", "std"),
                   suffix=lambda d: f"{d}d", prefix: str = "") -> DataFrame:
    """(origin_id, *keys, <agg>_<d>d ..., scale_maxmin_<d>d, scale_std_<d>d)
    for every origin of the set in one pass; keys with no row in the longest
    window are absent."""
    first, last = oset.history_range(max(days))
    h = history.where(F.col("visit_date").between(F.lit(first), F.lit(last)))
    w = Window.partitionBy(*keys).orderBy("_day")
    fns = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    cols = [fns[a]("y").over(w.rangeBetween(-d, -1)).alias(f"{prefix}{a}_{suffix(d)}") for d in days for a in aggs]
    seen = F.count("y").over(w.rangeBetween(-max(days), -1)).alias("_seen")
    out = with_anchors(h, oset, keys).select("origin_id", *keys, *cols, seen)
    out = out.where(F.col("origin_id").isNotNull() & (F.col("_seen") > 0)).drop("_seen")
    if scales:
        new = {}
        for d in days:
            s = suffix(d)
            new[f"scale_maxmin_{s}"] = scale_to_maxmin(f"{prefix}mean_{s}", f"{prefix}max_{s}", f"{prefix}min_{s}")
            new[f"scale_std_{s}"] = scale_to_std(f"{prefix}mean_{s}", f"{prefix}std_{s}")
        out = out.withColumns(new)
    return out


def trailing_dow(history: DataFrame, oset: OriginSet, weeks: Sequence[int] = DOW_WEEKS,
                 aggs: Sequence[str] = ("mean",)) -> DataFrame:
    """A8 / A8x: per (store, weekday) over the last ``w`` weeks."""
    return trailing_stats(history, oset, [7 * w for w in weeks], keys=("store_id", "dow"),
                          scales=False, aggs=aggs, suffix=lambda d: f"{d // 7}w",
                          prefix="").withColumnsRenamed(
        {f"{a}_{w}w": f"{a}_dow_{w}w" for a in aggs for w in weeks})


def trailing_diffs(trail: DataFrame, pairs: Sequence[tuple[int, int]] = ((28, 56), (28, 84), (56, 84))) -> DataFrame:
    """Differences between trailing means."""
    return trail.withColumns({f"diff_{a}_{b}": F.col(f"mean_{a}d") - F.col(f"mean_{b}d") for a, b in pairs})


def trailing_dow_diffs(trail: DataFrame, pairs: Sequence[tuple[int, int]] = ALL_DOW_DIFFS) -> DataFrame:
    """P22 on weekday means."""
    return trail.withColumns({f"diff_dow_{a}_{b}": F.col(f"mean_dow_{a}w") - F.col(f"mean_dow_{b}w") for a, b in pairs})
