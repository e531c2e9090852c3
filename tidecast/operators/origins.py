"""Forecast origins as data.

An origin set is a regular tiling of target windows backwards from a
reference date: origin i (1..count) has the window
``[ini - i*skip, ini - i*skip + split - 1]`` and sees history strictly
before ``cutoff = begin - gap``. Because the windows tile, the origin of a
row and the origins whose look-back covers a row are integer arithmetic on
its date: no range join is needed, and fan-out is bounded by
``lookback / skip + 1``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.sources.tables import HORIZON_DAYS, INI


@dataclass(frozen=True)
class OriginSet:
    name: str
    ini: dt.date
    split: int
    skip: int
    count: int
    gap: int = 0
    flag: int | None = None  # constant segment flag; None = by horizon day
    flag_cut: int = 6

    def part(self, first: int, last: int) -> "OriginSet":
        """Origins ``first`` to ``last`` as a set of their own, numbered from 1."""
        return replace(self, ini=self.ini - dt.timedelta(days=self.skip * (first - 1)), count=last - first + 1)

    def origins(self, spark: SparkSession) -> DataFrame:
        """(set, origin_id, begin, end, gap, cutoff): ``count`` rows."""
        ini = F.lit(self.ini)
        begin = F.date_sub(ini, (F.col("id") * self.skip).cast("int"))
        return spark.range(1, self.count + 1).select(
            F.lit(self.name).alias("set"),
            F.col("id").cast("long").alias("origin_id"),
            begin.alias("begin"),
            F.date_add(begin, self.split - 1).alias("end"),
            F.lit(self.gap).cast("long").alias("gap"),
            F.date_sub(begin, self.gap).alias("cutoff"),
        )

    # ---- column expressions on origin_id ----------------------------------
    def begin_of(self, origin: Column) -> Column:
        return F.date_sub(F.lit(self.ini), (origin * self.skip).cast("int"))

    def cutoff_of(self, origin: Column) -> Column:
        return F.date_sub(self.begin_of(origin), self.gap)

    def tile_of(self, date: Column) -> Column:
        """Origin whose target window holds ``date`` (null if none)."""
        d = F.datediff(F.lit(self.ini), date)
        i = F.ceil(d / F.lit(float(self.skip))).cast("long")
        ok = (i >= 1) & (i <= self.count) & (F.datediff(date, self.begin_of(i)) < self.split)
        return F.when(ok, i)

    def last_seen_by(self, date: Column) -> Column:
        """Largest (earliest) origin whose history ``(.., cutoff)`` holds
        ``date``: origins 1 to that one see it; below 1 none does."""
        q = F.datediff(F.lit(self.ini), date) - F.lit(self.gap)
        return F.least(F.lit(self.count), (F.ceil(q / F.lit(float(self.skip))) - 1).cast("int")).cast("long")

    def covering(self, date: Column, lookback: int | None) -> Column:
        """Array of origins whose history window ``[cutoff - lookback,
        cutoff)`` holds ``date`` (``lookback=None``: all history before the
        cutoff)."""
        q = F.datediff(F.lit(self.ini), date) - F.lit(self.gap)
        hi = self.last_seen_by(date)
        if lookback is None:
            lo = F.lit(1)
        else:
            lo = F.greatest(F.lit(1), F.ceil((q - F.lit(lookback)) / F.lit(float(self.skip))).cast("int"))
        return F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))).otherwise(
            F.array().cast("array<long>"))

    def target_range(self) -> tuple[dt.date, dt.date]:
        """First and last date of any target window."""
        first = self.ini - dt.timedelta(days=self.skip * self.count)
        return first, self.ini - dt.timedelta(days=self.skip) + dt.timedelta(days=self.split - 1)

    def history_range(self, lookback: int | None) -> tuple[dt.date | None, dt.date]:
        """First (None: no bound) and last date that any origin may look at."""
        begin = self.ini - dt.timedelta(days=self.skip * self.count + self.gap + (lookback or 0))
        return begin if lookback is not None else None, self.ini - dt.timedelta(days=self.skip + self.gap + 1)

    def horizon_day(self, date: Column, origin: Column) -> Column:
        """P5: day number in the horizon, counting the gap."""
        return (F.datediff(date, self.begin_of(origin)) + self.gap + 1).cast("long")

    def segment_flag(self, horizon_day: Column, by_day: bool = False) -> Column:
        """Constant per training set, or 1 for the first ``flag_cut``
        days and 2 after that."""
        if self.flag is not None and not by_day:
            return F.lit(self.flag).cast("long")
        return F.when(horizon_day <= self.flag_cut, F.lit(1)).otherwise(F.lit(2)).cast("long")


# Origin sets of the reference build, relative to the reference date.
TRAIN_ALL = OriginSet("train_all", INI, split=39, skip=39, count=360 // 39, gap=0, flag=0)
TRAIN1 = OriginSet("train1", INI, split=6, skip=6, count=360 // 6, gap=0, flag=1)
TRAIN2 = OriginSet("train2", INI, split=33, skip=33, count=360 // 33, gap=6, flag=2)
# The test origin as a one-tile set: begin = INI, 39 days, gap 0.
TEST = OriginSet("test", INI + dt.timedelta(days=HORIZON_DAYS), split=HORIZON_DAYS,
                 skip=HORIZON_DAYS, count=1, gap=0, flag=None)


def assign_origin(facts: DataFrame, oset: OriginSet, date_col: str = "visit_date",
                  by_day_flag: bool = False) -> DataFrame:
    """J9 + P3 + P5 + P6: keep rows inside some target window, tagged with
    origin_id, cutoff, horizon_day and flag (computed column, no join)."""
    tile = oset.tile_of(F.col(date_col))
    # Literal bounds reach the scan; the arithmetic on top can't.
    facts = facts.where(F.col(date_col).between(*map(F.lit, oset.target_range())))
    df = facts.withColumn("origin_id", tile).where(F.col("origin_id").isNotNull())
    hday = oset.horizon_day(F.col(date_col), F.col("origin_id"))
    return df.withColumns({
        "cutoff": oset.cutoff_of(F.col("origin_id")),
        "horizon_day": hday,
        "flag": oset.segment_flag(hday, by_day_flag),
    })
