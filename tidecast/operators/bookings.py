"""Reservations: parsing (F1-F9) and aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.scalars import hours_between, lead_hours_mod24, weekday0
from tidecast.operators.history import expanding
from tidecast.operators.origins import OriginSet


def parse_bookings(b: DataFrame) -> DataFrame:
    """Visit / reserve dates, visit hour, weekday, lead hours (full)
    and lead hours as the reference computes them (seconds part of the
    difference only, always in [0, 24))."""
    return b.select(
        "store_id",
        F.to_date("visit_datetime").alias("visit_date"),
        F.to_date("reserve_datetime").alias("reserve_date"),
        F.hour("visit_datetime").cast("long").alias("visit_hour"),
        weekday0(F.to_date("visit_datetime")).alias("dow"),
        hours_between("visit_datetime", "reserve_datetime").alias("lead_hours"),
        F.pmod(lead_hours_mod24("visit_datetime", "reserve_datetime"), F.lit(24.0)).alias("lead_hours_mod24"),
        "reserve_visitors",
    )


def known_before(b: DataFrame, cutoff: dt.date) -> DataFrame:
    """P4 on the reserve date: bookings made strictly before the cutoff."""
    return b.where(F.col("reserve_date") < F.lit(cutoff))


def booking_stats(b: DataFrame, keys=("store_id", "visit_date"), extended: bool = False) -> DataFrame:
    """A9 / A9x: party size sum, count, mean, sample std of the visit hour
    per (store, visit date); extended adds party std and lead hours."""
    aggs = [F.sum("reserve_visitors").alias("res_ttl"),
            F.count("reserve_visitors").alias("res_cnt"),
            F.avg("reserve_visitors").alias("res_mean"),
            F.stddev_samp("visit_hour").alias("res_hr_std")]
    if extended:
        aggs += [F.stddev_samp("reserve_visitors").alias("res_std"),
                 F.sum("lead_hours").alias("lead_sum"),
                 F.avg("lead_hours").alias("lead_mean")]
    return b.groupBy(*keys).agg(*aggs)


def booking_dow(b: DataFrame, keys=("store_id",)) -> DataFrame:
    """A10 + A11: per day mean party and count, then their mean over days
    per (store, weekday). A mean of means, as in the reference."""
    daily = b.groupBy(*keys, "visit_date", "dow").agg(
        F.avg("reserve_visitors").alias("_m"), F.count("reserve_visitors").alias("_c"))
    return daily.groupBy(*keys, "dow").agg(F.avg("_m").alias("party_mean_dow"),
                                           F.avg("_c").alias("cnt_mean_dow"))


def booking_cube(b: DataFrame, oset: OriginSet) -> DataFrame:
    """(store_id, visit_date, dow, k, s, n, h, hh): bookings summed per visit
    date and last origin ``k`` that knows them (made before its cutoff): party
    sum, count, sum and square sum of the visit hour. All booking features of
    all origins follow from these sums; an origin knows the sums of its own
    number and above. Partial aggregation combines a busy store day."""
    hour = F.col("visit_hour").cast("long")
    k = oset.last_seen_by(F.col("reserve_date"))
    return (b.where(F.col("reserve_date") <= F.lit(oset.history_range(None)[1])).withColumn("k", k).where(F.col("k") >= 1)
            .groupBy("store_id", "visit_date", "dow", "k")
            .agg(F.sum("reserve_visitors").alias("s"), F.count("reserve_visitors").alias("n"),
                 F.sum(hour).alias("h"), F.sum(hour * hour).alias("hh"), F.count(hour).alias("nh")))


def stats_of_sums(s: Column, n: Column, h: Column, hh: Column, nh: Column) -> dict[str, Column]:
    """A9 from sums: party sum, count and mean, sample std of the visit hour
    (hours are integers, so the sums are exact)."""
    var = (hh - h * h / nh) / (nh - 1)
    return {"res_ttl": s, "res_cnt": n, "res_mean": F.when(n > 0, s / n),
            "res_hr_std": F.when(nh > 1, F.sqrt(F.greatest(var, F.lit(0.0))))}


def booking_dow_cells(cube: DataFrame, oset: OriginSet) -> DataFrame:
    """A10 + A11 for all origins: (origin_id, store_id, dow, party_mean_dow,
    cnt_mean_dow). As older bookings become newer ones' company, a day's mean
    party moves; the moves are summed per weekday and bucket and cumulated
    over origins, so no day is copied to each origin that knows it."""
    w = Window.partitionBy("store_id", "visit_date", "dow").orderBy(F.col("k").desc())
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = cube.select("store_id", "visit_date", "dow", "k", F.col("n"), (F.sum("s").over(so_far) / F.sum("n").over(so_far)).alias("m"))
    before = F.lag("m").over(w)
    moves = days.select("store_id", "dow", "k", "n", (F.col("m") - F.coalesce(before, F.lit(0.0))).alias("dm"),
                        before.isNull().cast("long").alias("day"))
    e = expanding(moves, oset, ["store_id", "dow"], {"_m": ("sum", F.col("dm")), "_c": ("sum", F.col("n")), "_d": ("sum", F.col("day"))},
                  bucket=F.col("k"))
    return e.select("origin_id", "store_id", "dow", (F.col("_m") / F.col("_d")).alias("party_mean_dow"),
                    (F.col("_c") / F.col("_d")).alias("cnt_mean_dow"))
