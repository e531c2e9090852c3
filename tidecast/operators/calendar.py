"""Calendar operators: padding (U1), neighbour flags (J5), revised holiday
flag (P9), recency weight (W1), day parts (F4, F5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.scalars import weekday0

# Padding rows as (days from the calendar edge, holiday flag):
# two flagged days before the first date, two plain days after the last.
PAD_BEFORE = ((-2, 1), (-1, 1))
PAD_AFTER = ((1, 0), (2, 0))


def pad_calendar(calendar: DataFrame, before=PAD_BEFORE, after=PAD_AFTER) -> DataFrame:
    """U1 + S3: add literal rows before the first and after the last date,
    then derive weekday (Monday = 0) and month. The pads are an array of
    literal (offset, flag) structs applied to the one-row bounds, so the
    plan holds no subquery and no join."""
    bounds = calendar.agg(F.min("visit_date").alias("lo"), F.max("visit_date").alias("hi"))
    pads = ([F.struct(F.date_add("lo", o).alias("visit_date"), F.lit(f).cast("long").alias("holiday_flg"))
             for o, f in before]
            + [F.struct(F.date_add("hi", o).alias("visit_date"), F.lit(f).cast("long").alias("holiday_flg"))
               for o, f in after])
    pad_rows = bounds.select(F.explode(F.array(*pads)).alias("p")).select("p.*")
    cal = calendar.select("visit_date", F.col("holiday_flg").cast("long")).unionByName(pad_rows)
    return cal.withColumns({"dow": weekday0("visit_date"),
                            "month": F.month("visit_date").cast("long")})


def _day_window():
    # The calendar holds one row per day: its size is bounded by the date
    # span (about 365 rows a year), so one ordered partition is cheap.
    return Window.orderBy("visit_date")


def neighbour_flag(cal: DataFrame, col: str, offset: int, out: str) -> DataFrame:
    """Attribute of the day ``offset`` days away (missing day -> 0). The
    neighbour row is taken by position and kept only if its date is exactly
    ``offset`` days away, so holes in the calendar are handled."""
    w = _day_window()
    nb_date = F.lead("visit_date", offset).over(w) if offset > 0 else F.lag("visit_date", -offset).over(w)
    nb_val = F.lead(col, offset).over(w) if offset > 0 else F.lag(col, -offset).over(w)
    hit = nb_date == F.date_add("visit_date", offset)
    return cal.withColumn(out, F.coalesce(F.when(hit, nb_val), F.lit(0)).cast("long"))


def with_neighbours(cal: DataFrame) -> DataFrame:
    cal = neighbour_flag(cal, "holiday_flg", 1, "holiday_next1d")
    return neighbour_flag(cal, "holiday_flg", -1, "holiday_prev1d")


def with_holiday_rev(cal: DataFrame, weekend=(5, 6)) -> DataFrame:
    """Holidays falling on a weekend are not holidays."""
    rev = F.when(F.col("dow").isin(*weekend) & (F.col("holiday_flg") == 1), F.lit(0)).otherwise(
        F.col("holiday_flg"))
    return cal.withColumn("holiday_rev", rev.cast("long"))


def with_weight(cal: DataFrame, power: int = 1) -> DataFrame:
    """Recency weight (position + 1) / n**power over the calendar in
    date order. The constant cancels in every weighted mean."""
    pos = F.row_number().over(_day_window())
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return cal.withColumn("weight", pos.cast("double") / F.pow(n.cast("double"), F.lit(float(power))))


def enrich_calendar(calendar: DataFrame, power: int = 1) -> DataFrame:
    """Padded calendar with all derived columns."""
    cal = pad_calendar(calendar)
    cal = with_neighbours(cal)
    cal = with_holiday_rev(cal)
    return with_weight(cal, power)
