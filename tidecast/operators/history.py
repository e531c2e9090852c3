"""History statistics per key with fallback levels.

History is cut into buckets by the last origin that sees a row, so origin i
sees the buckets i and above. Rows are first counted per (key, bucket,
value); decomposable statistics (``expanding``) are cumulated over the
buckets, and the exact median (``level_stats``) is the middle rank of the
cumulated value counts. Neither holds a key's rows in an array, and both
spill. Inside a store (``level_cells``) the days bound a key's values, so its
median is the middle of their sorted array, and one row a store holds all cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.origins import OriginSet

STATS = ("wmean", "ymax", "ymin", "ymed", "ycnt")
#: Statistics of one level, in the order that cells hold them.
CELL = ("wmean", "mean", "ymax", "ymin", "ymed", "ycnt")


def _bucketed(history: DataFrame, oset: OriginSet, keys: Sequence[str], y: str, weight: str) -> DataFrame:
    """(keys, b, y, n, sw, w): history that some origin sees, counted per value."""
    seen = history.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
    w = F.col(weight).cast("double")
    return (seen.select(*keys, oset.last_seen_by(F.col("visit_date")).alias("b"), F.col(y).alias("y"), w.alias("w"))
            .where((F.col("b") >= 1) & F.col("y").isNotNull()).groupBy(*keys, "b", "y")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("y")).alias("sw"), F.sum("w").alias("w")))


def _cumulated(counts: DataFrame, keys: Sequence[str], median: bool) -> DataFrame:
    """(origin_id, keys, wmean, mean, ymax, ymin, ymed, ycnt) from value counts.
    What a key's origins see changes only at its own buckets: the statistics
    are taken once for each of those, over the counts of that bucket and above,
    and hold for the origins down to the next one. The median is the middle
    rank of the cumulated counts in value order. Null keys are left out."""
    state = [*keys, "s"]
    seen = counts.join(counts.select(*keys, F.col("b").alias("s")).distinct(), list(keys)).where(F.col("b") >= F.col("s"))
    n = F.sum("n")
    aggs = [F.sum("sw").alias("_sw"), F.sum("w").alias("_w"), (F.sum(F.col("y") * F.col("n")) / n).alias("mean"),
            F.max("y").alias("ymax"), F.min("y").alias("ymin"), n.alias("ycnt")]
    if median:
        by_value = Window.partitionBy(*state).orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        seen = seen.withColumns({"_end": n.over(by_value), "_all": n.over(Window.partitionBy(*state))})
        low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
        at = lambda k: F.max(F.when((F.col("_end") - F.col("n") <= k) & (k < F.col("_end")), F.col("y")))
        aggs.append(((at(low) + at(high)) / 2.0).alias("ymed"))
    else:
        aggs.append(F.lit(None).cast("double").alias("ymed"))
    stats = seen.groupBy(*state).agg(*aggs)
    below = F.coalesce(F.lead("s").over(Window.partitionBy(*keys).orderBy(F.col("s").desc())), F.lit(0).cast("long"))
    return stats.withColumn("_below", below).select(
        F.explode(F.sequence(F.col("_below") + 1, "s")).alias("origin_id"), *keys,
        F.when(F.col("_w") != 0, F.col("_sw") / F.col("_w")).alias("wmean"), "mean", "ymax", "ymin", "ymed", "ycnt")


def level_stats(history: DataFrame, oset: OriginSet, keys: Sequence[str],
                y: str = "y", weight: str = "weight") -> DataFrame:
    """(origin_id, *keys, wmean, mean, ymax, ymin, ymed, ycnt) over history
    strictly before each origin's cutoff; keys with no history are absent."""
    keys = list(keys)
    return _cumulated(_bucketed(history, oset, keys, y, weight), keys, True)


def slot_of(level: Sequence[str], among: Sequence[Sequence[str]]) -> Column:
    """Name of a level's cell inside one store: its number and key values;
    null where a key value is null."""
    return F.concat(F.lit(f"h{list(map(tuple, among)).index(tuple(level))}"),
                    *[F.concat(F.lit(":"), F.col(c).cast("string")) for c in level if c != "store_id"])


def by_store(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows moved by store, to as many tasks as the plan has found for them."""
    return df.repartition(partitions, "store_id") if partitions else df.repartition("store_id")


def level_cells(history: DataFrame, oset: OriginSet, levels: Sequence[Sequence[str]],
                y: str = "y", weight: str = "weight", median: bool = True, partitions: int | None = None) -> DataFrame:
    """All levels in one pass: (store_id, slot, s, vals), ``vals`` in the order
    of CELL. What origins see of a slot changes only at its own buckets ``s``:
    a row holds for the origins from ``s`` down to the next one, and isn't
    copied to each. History moves once, by store (a store has a row a day), and
    the levels are made from the sums and values of its finest groups."""
    cols = list(dict.fromkeys(c for lv in levels for c in lv if c != "store_id"))
    seen = history.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
    seen = by_store(seen.select("store_id", *cols, oset.last_seen_by(F.col("visit_date")).alias("b"), F.col(y).alias("y"),
                                F.col(weight).cast("double").alias("w"))
                    .where((F.col("b") >= 1) & F.col("y").isNotNull() & F.col("store_id").isNotNull()), partitions)
    combine = {"sw": F.sum, "w": F.sum, "sy": F.sum, "ymax": F.max, "ymin": F.min, "ycnt": F.sum}
    values = [F.collect_list("y").alias("ys")] if median else []
    finest = seen.groupBy("store_id", *cols, "b").agg(
        F.sum(F.col("w") * F.col("y")).alias("sw"), F.sum("w").alias("w"), F.sum("y").alias("sy"), F.max("y").alias("ymax"),
        F.min("y").alias("ymin"), F.count("y").alias("ycnt"), *values)
    slots = F.explode(F.array(*[slot_of(lv, levels) for lv in levels])).alias("slot")
    merged = [F.flatten(F.collect_list("ys")).alias("ys")] if median else []
    parts = (finest.select("store_id", slots, "b", *combine, *(["ys"] if median else [])).where(F.col("slot").isNotNull())
             .groupBy("store_id", "slot", "b").agg(*[f(c).alias(c) for c, f in combine.items()], *merged))
    w = Window.partitionBy("store_id", "slot").orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = parts.select("store_id", "slot", F.col("b").alias("s"), *[f(c).over(w).alias(c) for c, f in combine.items()],
                       *([F.sort_array(F.flatten(F.collect_list("ys").over(w))).alias("ys")] if median else []))
    at = lambda k: F.get("ys", F.floor(k).cast("int"))
    middle = (at((F.col("ycnt") - 1) / 2) + at(F.col("ycnt") / 2)) / 2.0 if median else F.lit(None)
    stats = cum.select("store_id", "slot", "s", F.when(F.col("w") != 0, F.col("sw") / F.col("w")).alias("wmean"),
                       (F.col("sy") / F.col("ycnt")).alias("mean"), "ymax", "ymin", middle.alias("ymed"), "ycnt")
    return stats.select("store_id", "slot", "s", F.array(*[F.col(c).cast("double") for c in CELL]).alias("vals"))


def gathered(cells: DataFrame) -> DataFrame:
    """(store_id, cells): all cells of a store as one map from slot to its
    states: their ``vals``, and ``at``, the place of the state that each origin
    sees. A level's state (slots ``h...``) holds for the origins down to the
    next one, any other for its own origin only. Slots are bounded by the
    levels' key values, states by the origins, whatever the data."""
    slots = cells.groupBy("store_id", "slot").agg(F.sort_array(F.collect_list(F.struct("s", "vals"))).alias("states"))
    span = lambda x, i: (x["s"] - F.coalesce(F.get("states", i - 1)["s"], F.lit(0))).cast("int")
    at = lambda f: F.flatten(F.transform("states", f))
    held = at(lambda x, i: F.array_repeat(i, span(x, i)))
    own = at(lambda x, i: F.concat(F.array_repeat(F.lit(None).cast("int"), span(x, i) - 1), F.array(i)))
    cell = F.struct(F.when(F.col("slot").startswith("h"), held).otherwise(own).alias("at"), F.col("states.vals").alias("vals"))
    return slots.groupBy("store_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", cell))).alias("cells"))


def cell_of(slot: Column) -> Column:
    """Values of the state that the row's origin sees in a slot."""
    cell = F.try_element_at("cells", slot)
    return F.get(cell["vals"], F.get(cell["at"], (F.col("origin_id") - 1).cast("int")))


def pick_levels(df: DataFrame, families: Mapping[str, Sequence[Sequence[str]]], among: Sequence[Sequence[str]],
                stats: Sequence[str] = STATS, more: Mapping[str, Column] | None = None) -> DataFrame:
    """J7 on rows with a ``cells`` map: ``<prefix><stat>`` of the first level
    whose key has history; the weighted mean falls back to the plain mean.
    ``more``: other columns read off the map, which is left out of the rows at
    once, as it is far larger than they are."""
    looked_up = {f"_cell{i}": cell_of(slot_of(lv, among)) for i, lv in enumerate(among)} | dict(more or {})
    df = df.select(*[c for c in df.columns if c != "cells"], *[x.alias(c) for c, x in looked_up.items()])
    place = {lv: i for i, lv in enumerate(map(tuple, among))}
    new = {}
    for prefix, levels in families.items():
        for stat in stats:
            of = [(CELL.index("mean") if stat == "wmean" and k else CELL.index(stat), place[tuple(lv)]) for k, lv in enumerate(levels)]
            value = F.coalesce(*[F.get(F.col(f"_cell{i}"), F.lit(c)) for c, i in of])
            new[f"{prefix}{stat}"] = value.cast("long") if stat == "ycnt" else value
    return df.withColumns(new).drop(*[f"_cell{i}" for i in place.values()])


def with_fallback(targets: DataFrame, history: DataFrame, oset: OriginSet,
                  levels: Sequence[Sequence[str]], prefix: str | None = None,
                  y: str = "y", weight: str = "weight", median: bool = True, partitions: int | None = None) -> DataFrame:
    """J6 + J7: statistics of the first level whose key group has history;
    the weighted mean falls back to the plain mean (as the reference does).
    ``targets`` needs origin_id and every level's key columns; every level has
    store_id. One join on the store, whatever the number of levels and origins."""
    among = list(dict.fromkeys(map(tuple, levels)))
    table = gathered(level_cells(history, oset, among, y, weight, median, partitions))
    stats = STATS if median else tuple(s for s in STATS if s != "ymed")
    out = targets.join(table, "store_id", "left")
    out = pick_levels(out, {f"{prefix}_" if prefix else "": among}, among, stats)
    rest = [c for c in out.columns if c not in targets.columns]
    return out.select(*targets.columns, *rest)


def expanding(history: DataFrame, oset: OriginSet, keys: Sequence[str],
              specs: Mapping[str, tuple[str, Column]], bucket: Column | None = None) -> DataFrame:
    """(origin_id, *keys, <name>...) for every origin of the set over all
    history strictly before its cutoff. ``specs`` maps output name to
    (kind, column) with kind in sum / count / min / max: decomposable
    aggregates only. Rows are partially aggregated per (key, last origin
    that sees them) and cumulated over origins by one window, so the cost
    is linear in the number of origins. ``bucket``: that last origin, where
    it doesn't follow from the visit date."""
    keys = list(keys)
    if bucket is None:
        history = history.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
        bucket = oset.last_seen_by(F.col("visit_date"))
    partial = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    combine = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    part = (history.withColumn("b", bucket.cast("long")).where(F.col("b") >= 1)
            .groupBy(*keys, "b")
            .agg(*[partial[k](c).alias(n) for n, (k, c) in specs.items()]))
    w = (Window.partitionBy(*keys).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = part.select(*keys, "b", F.lead("b").over(Window.partitionBy(*keys).orderBy(F.col("b").desc())).alias("_next"),
                      *[combine[k](n).over(w).alias(n) for n, (k, _) in specs.items()])
    # What bucket b has cumulated holds for the origins down to the next bucket.
    return cum.select(F.explode(F.sequence(F.coalesce(F.col("_next"), F.lit(0)) + 1, "b")).alias("origin_id"), *keys, *specs)


def expanding_stats(history: DataFrame, oset: OriginSet, keys: Sequence[str],
                    y: str = "y", weight: str = "weight") -> DataFrame:
    """W4 history statistics without median: (origin_id, *keys, wmean,
    ymax, ymin, ycnt)."""
    e = expanding(history, oset, keys, {
        "_sw": ("sum", F.col(weight) * F.col(y)), "_w": ("sum", F.col(weight)),
        "ymax": ("max", F.col(y)), "ymin": ("min", F.col(y)), "ycnt": ("count", F.col(y))})
    return e.select("origin_id", *keys, (F.col("_sw") / F.col("_w")).alias("wmean"), "ymax", "ymin",
                    F.col("ycnt").cast("long").alias("ycnt"))
