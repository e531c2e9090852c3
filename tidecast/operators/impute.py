"""Null fill and count (P10, P11), sentinel and infinity imputation
(P12-P14, A15), train/test union (U4, P21).

Column medians are exact and distributed: two quantiles of each column bracket
its median, the values between them are counted per distinct value and those
beyond as one value a side (map-side combined, so few rows are shuffled),
range-partitioned, ranked inside each range partition, and the one or two
middle ranks are picked; no task or driver ever holds a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import cut_lineage

INF = float("inf")


def fill_and_count(df: DataFrame, cols: Sequence[str], fill=-1, out: str = "na_cnt") -> DataFrame:
    """P11 then P10: count nulls per row (before the fill), then fill."""
    cnt = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    return df.withColumn(out, cnt).fillna(fill, subset=list(cols))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, v, n): how often each column holds each value, nulls left out."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v"))
                             for c in cols])).alias("kv")
    long = df.select(kv).select("kv.c", "kv.v").where(F.col("v").isNotNull())
    return long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))


def medians_of_counts(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Exact medians (name, median) of a (c, v, n) table, whose (c, v) may repeat."""
    p = partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds are sampled, so the partition numbers are frozen before two
    # branches read them (a checkpoint of one row per distinct value).
    ranged = cut_lineage(counts.repartitionByRange(p, "c", "v").withColumn("pid", F.spark_partition_id()))
    block = ranged.groupBy("c", "pid").agg(F.sum("n").alias("bn"))
    wb = Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    block = block.select("c", "pid", F.coalesce(F.sum("bn").over(wb), F.lit(0)).alias("offset"),
                         F.sum("bn").over(Window.partitionBy("c")).alias("total"))
    wr = Window.partitionBy("c", "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = (ranged.join(block, ["c", "pid"])
             .withColumn("_hi", F.col("offset") + F.sum("n").over(wr))   # exclusive end rank
             .withColumn("_lo", F.col("_hi") - F.col("n")))             # inclusive start rank
    k_lo = F.floor((F.col("total") - 1) / 2)
    k_hi = F.floor(F.col("total") / 2)
    inside = lambda k: (F.col("_lo") <= k) & (k < F.col("_hi"))
    picked = ranks.where(inside(k_lo) | inside(k_hi))
    return picked.groupBy("c").agg(
        ((F.max(F.when(inside(k_lo), F.col("v"))) + F.max(F.when(inside(k_hi), F.col("v")))) / 2.0)
        .alias("median")).select(F.col("c").alias("name"), "median")


def brackets(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(low, high) of each column with a value: approximate quantiles whose rank
    error is a tenth of their distance from the middle."""
    near = lambda c: F.percentile_approx(F.col(c).cast("double"), [0.49, 0.51], 1000)
    row = df.agg(*[near(c).alias(f"c{i}") for i, c in enumerate(cols)]).first()  # two numbers a column
    return {c: (row[i][0], row[i][1]) for i, c in enumerate(cols) if row[i] is not None}


def column_medians(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Exact medians of many columns in two distributed passes: (name, median).
    The second counts the values of a column inside its bracket; those below
    and above it keep their place in the order as -inf and NaN. A column whose
    median isn't found inside its bracket is counted again in full."""
    ends = brackets(df, list(cols)) if cols else {}
    if not ends:
        return medians_of_counts(value_counts(df, cols), partitions)

    def inside(c: str) -> Column:
        v, (low, high) = F.col(c).cast("double"), map(F.lit, ends[c])
        return F.when(v < low, F.lit(-INF)).when(v > high, F.lit(float("nan"))).otherwise(v).alias(c)

    found = cut_lineage(medians_of_counts(value_counts(df.select(*[inside(c) for c in ends]), list(ends)), partitions))
    ok = F.lit(False)
    for c, (low, high) in ends.items():
        ok = ok | ((F.col("name") == c) & F.col("median").between(F.lit(low), F.lit(high)))
    missed = [r["name"] for r in found.where(~F.coalesce(ok, F.lit(False))).collect()]  # at most a row a column
    if not missed:
        return found
    return found.where(~F.col("name").isin(missed)).unionByName(medians_of_counts(value_counts(df, missed), partitions))


def _attach(df: DataFrame, medians: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """Medians as columns: one row, joined on a constant key with a broadcast
    hint, a proven one-row side."""
    row = medians.agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(f"{prefix}{c}") for c in cols])
    row = row.withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(row), "_one").drop("_one")


def with_medians(df: DataFrame, cols: Sequence[str], src: DataFrame | None = None,
                 prefix: str = "_med_") -> DataFrame:
    """Attach the exact medians of ``cols`` (over ``src``, default ``df``) as
    columns ``<prefix><col>``. The medians are one row, joined on a constant
    key with a broadcast hint: a proven one-row side, computed once."""
    return _attach(df, column_medians(df if src is None else src, cols), cols, prefix)


def impute_sentinel(df: DataFrame, cols: Sequence[str], sentinel=-1,
                    exclude_sentinel: bool = False) -> DataFrame:
    """Sentinel -> column median over all rows (sentinels included,
    as written in the reference; ``exclude_sentinel`` leaves them out)."""
    src = df
    if exclude_sentinel:
        # Non-sentinel values only: turn sentinels into nulls for the median.
        src = df.select(*[F.when(F.col(c) != sentinel, F.col(c)).alias(c) for c in cols])
    out = with_medians(df, cols, src)
    out = out.withColumns({c: F.when(F.col(c) == sentinel, F.col(f"_med_{c}")).otherwise(F.col(c).cast("double"))
                           for c in cols})
    return out.drop(*[f"_med_{c}" for c in cols])


def replace_inf_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """+-inf -> 0."""
    return df.withColumns({c: F.when(F.abs(F.col(c)) == F.lit(INF), F.lit(0.0)).otherwise(F.col(c))
                           for c in cols})


def replace_inf_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """-inf -> median, then +inf -> median recomputed after that step. The
    rows are counted once: in the table of value counts the step moves the
    count of -inf to the first median, and the second is read off there."""
    counts = cut_lineage(value_counts(df, cols))
    first = cut_lineage(medians_of_counts(counts))
    moved = counts.join(F.broadcast(first), F.col("c") == F.col("name"))  # one row a column
    moved = moved.select("c", F.when(F.col("v") == F.lit(-INF), F.col("median")).otherwise(F.col("v")).alias("v"), "n")
    out = _attach(_attach(df, first, cols, "_low_"), medians_of_counts(moved), cols, "_high_")
    out = out.withColumns({c: F.when(F.col(c) == F.lit(-INF), F.col(f"_low_{c}")).when(F.col(c) == F.lit(INF), F.col(f"_high_{c}"))
                           .otherwise(F.col(c)) for c in cols})
    return out.drop(*[f"{p}{c}" for p in ("_low_", "_high_") for c in cols])


def union_train_test(train: DataFrame, test: DataFrame, label: str = "visitors") -> DataFrame:
    """U4 + P21: tagged union; the test label is the constant 0."""
    te = test.withColumn(label, F.lit(0).cast(train.schema[label].dataType))
    return (train.withColumn("is_test", F.lit(0).cast("long"))
            .unionByName(te.withColumn("is_test", F.lit(1).cast("long")), allowMissingColumns=True))
