"""Parquet scans and the forecasting views over the test tables.

The views map the TPC-H-like tables onto the forecasting data model:

* visits: daily quantity per supplier (the "store") and ship date
* stores: supplier with nation / region as genre and area
* calendar: every day of the fact span, with a holiday flag
* bookings: line items as reservations made at order time
* weather: daily region-level covariates from orders
* partner_stores / id_relation: customers as a second store system
* horizon_ids: the store x 39-day forecast grid after the reference date

Each view is a lazy DataFrame; Catalyst prunes columns and pushes filters
into the parquet scans.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.scalars import weekday0
from tidecast.plans.partitioning import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Reference date of the forecast (first day of the test horizon) and its length.
INI = dt.date(2001, 8, 1)
HORIZON_DAYS = 39
# Levels of the category columns that the mapping gives: weather labels
# (order priorities) and the number of third area levels (supplier key % 10).
WEATHER_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
AREA_L3_LEVELS = 10

# Month-day of the holidays flagged in the calendar view.
HOLIDAY_MONTH_DAYS = ("01-01", "02-11", "04-29", "05-03", "05-04", "05-05",
                      "09-23", "11-03", "11-23", "12-23")


def read_table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """Scan one table (parquet, or CSV with header when given a schema
    and a ``.csv`` path)."""
    path = f"{sf_dir}/{name}" if name.endswith((".csv", ".parquet")) else f"{sf_dir}/{name}.parquet"
    if path.endswith(".csv"):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


class Fixtures:
    """Lazy views over one scale-factor directory.

    Properties are cached so that a view used twice in one plan is the same
    logical subtree, which lets Spark reuse its exchange.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, ini: dt.date = INI, span: tuple[dt.date, dt.date] | None = None):
        self.spark = spark
        self._span = span
        self.sf_dir = sf_dir.rstrip("/")
        self.ini = ini

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- facts ------------------------------------------------------------
    @cached_property
    def n_facts(self) -> int:
        """Line items, counted from file footers: the facts that tasks follow."""
        return self.table("lineitem").count()

    @cached_property
    def visits(self) -> DataFrame:
        """(store_id, visit_date, visitors): one row per store and open day;
        closed days are missing rows, never zeros. A hot supplier is spread
        over its days."""
        li = self.table("lineitem").select(F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("visit_date"), "l_quantity")
        return (spread(li, self.n_facts, "store_id", "visit_date").groupBy("store_id", "visit_date")
                .agg(F.sum("l_quantity").cast("long").alias("visitors")))

    @cached_property
    def bookings(self) -> DataFrame:
        """(store_id, visit_datetime, reserve_datetime, reserve_visitors):
        a line item is a booking made when its order was placed; only
        rows shipped on or after the order date."""
        li = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber",
                                           "l_quantity", "l_shipdate")
        od = self.table("orders").select("o_orderkey", "o_orderdate")
        li, od = spread(li, self.n_facts, "l_orderkey"), spread(od, self.n_facts, "o_orderkey")
        j = li.join(od, li.l_orderkey == od.o_orderkey, "inner").where(
            F.col("l_shipdate") >= F.col("o_orderdate"))
        return j.select(
            F.col("l_suppkey").alias("store_id"),
            F.timestamp_add("HOUR", F.col("l_linenumber") * 3, F.col("l_shipdate")).alias("visit_datetime"),
            F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate")).alias("reserve_datetime"),
            F.col("l_quantity").cast("long").alias("reserve_visitors"),
        )

    # ---- dimensions -------------------------------------------------------
    @cached_property
    def stores(self) -> DataFrame:
        """(store_id, genre, area, latitude, longitude); area has three
        blank-separated levels: region, nation, supplier group."""
        s = self.table("supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        j = (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
        return j.select(
            F.col("s_suppkey").alias("store_id"),
            F.col("n_name").alias("genre"),
            F.concat(F.regexp_replace("r_name", " ", "-"), F.lit(" "), F.col("n_name"),
                     F.lit(" S"), (F.col("s_suppkey") % 10).cast("string")).alias("area"),
            F.col("s_acctbal").cast("double").alias("latitude"),
            F.col("s_nationkey").cast("double").alias("longitude"),
        )

    @cached_property
    def span(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last fact date: given, or read once (two dates), so that
        no plan with a calendar scans the facts for it."""
        if self._span is None:
            li = self.table("lineitem").agg(F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi"))
            self._span = tuple(li.first())
        return self._span

    @cached_property
    def calendar(self) -> DataFrame:
        """(visit_date, holiday_flg) for every day from the first to the last
        fact date. Its size is bounded by the number of days, so joins
        broadcast it."""
        lo, hi = self.span
        days = self.spark.range(1).select(F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).alias("visit_date"))
        flag = F.date_format("visit_date", "MM-dd").isin(*HOLIDAY_MONTH_DAYS).cast("long")
        return days.select("visit_date", flag.alias("holiday_flg"))

    @cached_property
    def weather(self) -> DataFrame:
        """(prefecture, visit_date, rainfall, wind_max, weather_daytime):
        stand-in daily covariates per region."""
        o = self.table("orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        n = self.table("nation").select("n_nationkey", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        j = (o.join(c, o.o_custkey == c.c_custkey)
             .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
        return (j.groupBy(F.regexp_replace("r_name", " ", "-").alias("prefecture"),
                          F.to_date("o_orderdate").alias("visit_date"))
                .agg(F.count(F.lit(1)).cast("double").alias("rainfall"),
                     (F.max("o_totalprice") / 1000.0).alias("wind_max"),
                     F.min("o_orderpriority").alias("weather_daytime")))

    @cached_property
    def partner_stores(self) -> DataFrame:
        """Second store system: customers."""
        c = self.table("customer")
        return c.select(F.col("c_custkey").alias("partner_id"),
                        F.col("c_mktsegment").alias("partner_genre"),
                        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("partner_area"),
                        F.col("c_acctbal").cast("double").alias("latitude"),
                        F.col("c_nationkey").cast("double").alias("longitude"))

    @cached_property
    def id_relation(self) -> DataFrame:
        """Store to partner store: suppliers with key % 3 = 0 to the customer
        of the same key."""
        s = self.table("supplier").select("s_suppkey")
        return s.where(F.col("s_suppkey") % 3 == 0).select(
            F.col("s_suppkey").alias("store_id"), F.col("s_suppkey").alias("partner_id"))

    @cached_property
    def horizon_ids(self) -> DataFrame:
        """(id, store_id, visit_date, visitors=0): the submission grid, one row
        per store and horizon day, id = 'air_<store>_<yyyy-mm-dd>'."""
        start = F.lit(self.ini)
        days = F.sequence(start, F.date_add(start, HORIZON_DAYS - 1))
        g = self.stores.select("store_id", F.explode(days).alias("visit_date"))
        return g.select(
            F.concat(F.lit("air_"), F.col("store_id").cast("string"), F.lit("_"),
                     F.date_format("visit_date", "yyyy-MM-dd")).alias("id"),
            "store_id", "visit_date", F.lit(0).cast("long").alias("visitors"))

    # ---- derived helpers --------------------------------------------------
    def history(self, cutoff: dt.date | None = None) -> DataFrame:
        """Visits on the log scale, optionally strictly before a cutoff."""
        v = self.visits
        if cutoff is not None:
            v = v.where(F.col("visit_date") < F.lit(cutoff))
        return v.select("store_id", "visit_date", F.log1p(F.col("visitors").cast("double")).alias("y"))
