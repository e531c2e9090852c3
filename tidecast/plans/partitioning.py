"""Partitioning policy of the composed plans.

Facts are first reduced to one row per (store, day) (or per store, visit
day and booking bucket). After that, the rows of any store are bounded by the
number of days in the calendar, whatever the data volume, so ``store_id``
is a skew-safe partitioning key. Blocks keyed by a category (genre, area) or
by (region, day) are joined by broadcast, but only behind a bound computed from
the dimension tables; beyond it they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

# Largest lookup table (rows) the plans broadcast; beyond it they shuffle.
BROADCAST_MAX_ROWS = 2_000_000
# Facts whose stores one task sorts and aggregates: its memory stays the same
# on larger tables, which have more tasks.
FACTS_PER_TASK = 250_000


def store_partitions(spark: SparkSession, n_facts: int) -> int:
    """Tasks for rows by store: the session's number, or more on many facts."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_facts // FACTS_PER_TASK))


def spread(df: DataFrame, n_facts: int, *by: str | Column) -> DataFrame:
    """Facts moved by ``by`` to as many tasks as they need, before an aggregate
    or join on ``by``. Left to itself that step has the session's number of
    tasks, each of which would grow with the tables. What fits into one task
    isn't moved."""
    return df if n_facts <= FACTS_PER_TASK else df.repartition(store_partitions(df.sparkSession, n_facts), *by)


def distinct_count(df: DataFrame, cols) -> int:
    """Number of distinct level combinations in a dimension table (a small
    action on the dimension, never on facts)."""
    return df.select(*cols).distinct().count()
