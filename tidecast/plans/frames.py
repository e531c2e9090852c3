"""Frames shared by the plans: enriched calendar, store dimension, log-scale
history with calendar and store attributes, target grids per origin set."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.scalars import rounded, rounded_in_bulk, weekday0
from tidecast.operators.bookings import parse_bookings
from tidecast.operators.calendar import enrich_calendar
from tidecast.operators.encoders import label_encode, store_dim
from tidecast.operators.origins import TEST, OriginSet, assign_origin
from tidecast.plans.partitioning import store_partitions
from tidecast.sources.tables import Fixtures

CAL_COLS = ("dow", "month", "holiday_flg", "holiday_next1d", "holiday_prev1d", "holiday_rev")
STORE_COLS = ("genre", "area_l1", "area_l2", "area_l3", "d_lat", "d_long")
STORE_LABELS = ("genre", "area_l1", "area_l2", "area_l3")

# Columns up to which Spark makes one function of a stage's operators.
WHOLE_STAGE_FIELDS = 100


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixtures(spark, sf_dir)

    @cached_property
    def tasks(self) -> int:
        """Tasks for rows by store; the facts are counted from file footers."""
        return store_partitions(self.spark, self.fx.n_facts)

    @cached_property
    def cal(self) -> DataFrame:
        """Padded calendar with neighbours, revised flag and weight; one row
        per day, so it is broadcast wherever it is joined."""
        return enrich_calendar(self.fx.calendar)

    @cached_property
    def stores(self) -> DataFrame:
        return store_dim(self.fx.stores)

    @cached_property
    def hist(self) -> DataFrame:
        """(store_id, visit_date, y, dow, holiday_flg, holiday_next1d,
        holiday_prev1d, holiday_rev, weight, genre, area_l1..3): every visit on the log scale."""
        cal = self.cal.select("visit_date", "holiday_flg", "holiday_next1d", "holiday_prev1d", "holiday_rev", "weight")
        st = self.stores.select("store_id", "genre", "area_l1", "area_l2", "area_l3")
        h = self.fx.history().join(F.broadcast(cal), "visit_date", "left").join(st, "store_id", "left")
        return h.withColumn("dow", weekday0("visit_date"))

    @cached_property
    def store_labels(self) -> DataFrame:
        """(store_id, <attribute>_lbl): label codes of the category columns."""
        st = self.stores.select("store_id", *STORE_LABELS)
        for c in STORE_LABELS:
            st = label_encode(st, c)
        return st.select("store_id", *[f"{c}_lbl" for c in STORE_LABELS])

    @cached_property
    def bookings(self) -> DataFrame:
        return parse_bookings(self.fx.bookings)

    def _decorate(self, t: DataFrame) -> DataFrame:
        cal = self.cal.select("visit_date", *[c for c in CAL_COLS if c != "dow"])
        t = t.withColumn("dow", weekday0("visit_date")).join(F.broadcast(cal), "visit_date", "left")
        return t.join(self.stores.select("store_id", *STORE_COLS), "store_id", "left")

    def train_targets(self, oset: OriginSet, by_day_flag: bool = False, decorate: bool = True) -> DataFrame:
        """Visits inside the target windows of the set, with origin_id,
        cutoff, horizon_day, flag, y (and calendar / store attributes)."""
        t = assign_origin(self.fx.visits, oset, by_day_flag=by_day_flag)
        t = t.withColumn("y", F.log1p(F.col("visitors").cast("double")))
        return self._decorate(t) if decorate else t.withColumn("dow", weekday0("visit_date"))

    def test_targets(self, decorate: bool = True) -> DataFrame:
        """The store x horizon grid as origin 1 of the test set."""
        t = self.fx.horizon_ids.select("id", "store_id", "visit_date")
        t = assign_origin(t, TEST)
        return self._decorate(t) if decorate else t.withColumn("dow", weekday0("visit_date"))


def finalize(df: DataFrame, cols=None) -> DataFrame:
    """Output projection: integers as bigint, doubles rounded to 6 places,
    so that results compare across engines."""
    cols = list(cols) if cols is not None else df.columns
    wide = len(cols) > WHOLE_STAGE_FIELDS
    out = []
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(F.col(c).cast("long").alias(c))
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append((rounded_in_bulk(c) if wide else rounded(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
