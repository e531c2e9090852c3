"""Lags by calendar date.

Dates have holes (closed days are missing rows), so ``F.lag`` over rows is
wrong. Targets and facts are put on one day axis per store, and each offset
is a window frame that holds just the day that many days back. A target is
never copied, one sort by (store, day) serves all offsets, and a store's
rows are bounded by the number of days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.history import by_store
from tidecast.operators.origins import OriginSet

DAY_LAGS = (1, 3, 5, 10, 20, 30)
WEEK_LAGS = tuple(range(1, 21))
# Every day lag that the models read, of visits and of bookings.
ALL_DAY_LAGS = (1, 2, 3, 4, 5, 6, 10, 15, 20, 25, 30, 35, 40, 45, 50)


def lag_names(days: Sequence[int] = (), weeks: Sequence[int] = (), prefix: str = "lag") -> dict[str, int]:
    out = {f"{prefix}_{d}d": d for d in days}
    out.update({f"{prefix}_{w}w": 7 * w for w in weeks})
    return out


def at_offsets(targets: DataFrame, facts: DataFrame, wanted: Mapping[str, tuple[str, int]], partitions: int | None = None) -> DataFrame:
    """``targets`` with <name> = (value column of ``facts``, offset): its value
    on the day ``offset`` days before visit_date, null where that day has no
    row. ``facts``: (store_id, visit_date, values...), for each value one row
    that is not null per (store_id, visit_date)."""
    values = list(dict.fromkeys(v for v, _ in wanted.values()))
    day = F.unix_date("visit_date").alias("_day")
    own = targets.select("*", day, F.lit(True).alias("_own"))
    f = facts.select("store_id", day, *[F.col(v).alias(f"_of_{v}") for v in values])
    w = Window.partitionBy("store_id").orderBy("_day")
    cols = [F.first(f"_of_{v}", ignorenulls=True).over(w.rangeBetween(-d, -d)).alias(n) for n, (v, d) in wanted.items()]
    both = by_store(own.unionByName(f, allowMissingColumns=True), partitions)
    return both.select(*targets.columns, "_own", *cols).where("_own").drop("_own")


def needed_days(facts: DataFrame, oset: OriginSet | None, longest: int) -> DataFrame:
    """Facts that a lag of some target of the set can reach (literal bounds,
    which the scan takes)."""
    if oset is None:
        return facts
    import datetime as dt
    first, last = oset.target_range()
    return facts.where(F.col("visit_date").between(F.lit(first - dt.timedelta(days=longest)), F.lit(last)))


def known_lag(name: str, days: int) -> Column:
    """A lag counts only if its day lies before the row's cutoff."""
    return F.when(F.date_sub("visit_date", days) < F.col("cutoff"), F.col(name))


def lag_features(targets: DataFrame, history: DataFrame, offsets: Mapping[str, int],
                 keys: Sequence[str] = ("origin_id", "store_id", "visit_date"),
                 value: str = "y", oset: OriginSet | None = None, partitions: int | None = None) -> DataFrame:
    """(keys..., one column per offset): value on the date ``offset`` days
    before the target date, null when that date is on or after the cutoff
    or has no row. ``targets`` needs keys + cutoff; ``history`` has
    (store_id, visit_date, value) unique per (store_id, visit_date);
    ``oset``: the targets' origin set, which bounds the history read."""
    facts = needed_days(history.select("store_id", "visit_date", value), oset, max(offsets.values()))
    out = at_offsets(targets.select(*keys, "cutoff"), facts, {n: (value, d) for n, d in offsets.items()}, partitions)
    return out.select(*keys, *[known_lag(n, d).alias(n) for n, d in offsets.items()])


def known_by_day(bookings: DataFrame, known_at: Column) -> DataFrame:
    """(store_id, visit_date, known): party sums per visit date and moment
    ``known_at`` that they became known, as a list. Summed per key before
    listing, so a list is bounded by the number of moments, however busy the
    store."""
    per = bookings.groupBy("store_id", "visit_date", known_at.alias("k")).agg(F.sum("reserve_visitors").alias("s"))
    return per.groupBy("store_id", "visit_date").agg(F.collect_list(F.struct("k", "s")).alias("known"))


def sum_known(known: Column, is_known, field: str = "s") -> Column:
    """Sum over the entries that satisfy ``is_known``, null if there are none."""
    kept = F.filter(known, is_known)
    return F.when(F.exists(known, is_known), F.aggregate(kept, F.lit(0).cast("long"), lambda acc, x: acc + x[field]))


def lag_booking(targets: DataFrame, bookings: DataFrame, offsets: Mapping[str, int],
                keys: Sequence[str] = ("origin_id", "store_id", "visit_date"),
                oset: OriginSet | None = None) -> DataFrame:
    """Lagged reservation sums. A booking counts for an origin when it
    was made before that origin's cutoff (its visit may be later). With
    ``oset`` the bookings of a day are summed per origin that knows them,
    else per reserve date."""
    if oset is None:
        known_at, is_known = F.col("reserve_date"), lambda x: x["k"] < F.col("cutoff")
    else:
        known_at, is_known = oset.last_seen_by(F.col("reserve_date")), lambda x: x["k"] >= F.col("origin_id")
    known = known_by_day(needed_days(bookings, oset, max(offsets.values())), known_at)
    own = list(dict.fromkeys([*keys, "cutoff"]))
    out = at_offsets(targets.select(*own), known, {n: ("known", d) for n, d in offsets.items()})
    return out.select(*keys, *[sum_known(F.col(n), is_known).alias(n) for n in offsets])
