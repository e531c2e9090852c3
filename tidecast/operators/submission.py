"""Submission: id parsing and join (F11, J13, U5), date factors (M9, F16),
year-on-year comparison (J14, A22)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.scalars import id_date, id_store_key


def parse_ids(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """store key (first two tokens) and date (last token)."""
    return ids.select(id_col, id_store_key(id_col).alias("store_key"), id_date(id_col).alias("visit_date"))


def build_submission(ids: DataFrame, preds: DataFrame, pred: str = "pred",
                     store_key_of=lambda c: F.concat(F.lit("air_"), c.cast("string"))) -> DataFrame:
    """Predictions (log scale) onto the ids; ``visitors = expm1(pred)``."""
    p = preds.select(store_key_of(F.col("store_id")).alias("store_key"), "visit_date", F.col(pred).alias("_p"))
    j = parse_ids(ids).join(p, ["store_key", "visit_date"], "left")
    return j.select("id", "visit_date", F.expm1("_p").alias("visitors"))


def factor_table(spark, ini: dt.date, factors: Mapping[int, float]) -> DataFrame:
    """Date factors given as days after the horizon start."""
    rows = [(ini + dt.timedelta(days=k), float(v)) for k, v in factors.items()]
    return spark.createDataFrame(rows, "visit_date date, factor double")


def adjust_by_date(sub: DataFrame, factors: DataFrame, col: str = "visitors") -> DataFrame:
    """M9 + F16: multiply by the date's factor (1.0 where none); the factor
    table has one row per date: broadcast."""
    j = sub.join(F.broadcast(factors), "visit_date", "left")
    return j.withColumn(f"{col}_adj", F.col(col) * F.coalesce(F.col("factor"), F.lit(1.0))).drop("factor")


def yoy_compare(visits: DataFrame, sub: DataFrame, start: dt.date, end: dt.date, shift: int = 364) -> DataFrame:
    """J14 + A22: daily mean of last year's actuals (shifted by 364 days, so
    weekdays match) against the daily mean of raw and adjusted predictions."""
    act = (visits.select(F.date_add("visit_date", shift).alias("visit_date"), "visitors")
           .where(F.col("visit_date").between(F.lit(start), F.lit(end)))
           .groupBy("visit_date").agg(F.avg("visitors").alias("actual_last_year")))
    pred = sub.groupBy("visit_date").agg(F.avg("visitors").alias("pred"), F.avg("visitors_adj").alias("pred_adj"))
    return act.join(pred, "visit_date", "left")
