"""Encoders: store dimension (F12, A14), label codes (M1, W5), one-hot
(M2), k-means clusters (M3) and hash folds (M4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.scalars import area_token, fold_of
from tidecast.session import cut_lineage


def store_dim(stores: DataFrame) -> DataFrame:
    """F12 + A14: area levels 1..3 and distance from the global maximum of
    the coordinates. The maxima are one distributed aggregate, joined back
    as a one-row broadcast on a constant key."""
    top = stores.agg(F.max("latitude").alias("_max_lat"), F.max("longitude").alias("_max_long"),
                     F.lit(1).alias("_one"))
    j = stores.withColumn("_one", F.lit(1)).join(F.broadcast(top), "_one")
    return j.withColumns({
        "area_l1": area_token("area", 0),
        "area_l2": area_token("area", 1),
        "area_l3": area_token("area", 2),
        "d_lat": F.col("_max_lat") - F.col("latitude"),
        "d_long": F.col("_max_long") - F.col("longitude"),
    }).drop("_one", "_max_lat", "_max_long")


def level_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(level, code) with codes 0..n-1 in sorted level order. The distinct
    levels are range-partitioned and numbered inside their partition after the
    levels of those before, so no task holds them all."""
    out = out or f"{col}_lbl"
    levels = df.select(col).where(F.col(col).isNotNull()).distinct()
    # Sampled bounds: frozen before two branches read the partition numbers.
    ranged = cut_lineage(levels.repartitionByRange(col).withColumn("_pid", F.spark_partition_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    start = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_pid").orderBy(col)) - 1
    return ranged.join(F.broadcast(start), "_pid").select(col, (F.col("_start") + place).cast("long").alias(out))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """M1: sorted level codes joined back onto the rows."""
    out = out or f"{col}_lbl"
    return df.join(level_codes(df, col, out), on=col, how="left")


def collect_levels(df: DataFrame, col: str, max_levels: int = 10_000) -> list:
    """Category levels of one column, collected once at fit time so that the
    output schema does not depend on the data of one slice. Guarded: a
    column with more levels is not categorical."""
    levels = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_levels + 1)
    vals = sorted(r[0] for r in levels.collect())
    if len(vals) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return vals


def one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = True,
            levels: dict[str, list] | None = None) -> DataFrame:
    """M2 / M2x: 0/1 columns ``<col>_<level>``; the first level is dropped
    unless ``drop_first=False``; the source column is kept."""
    new = {}
    for c in cols:
        lv = (levels or {}).get(c) or collect_levels(df, c)
        for lvl in (lv[1:] if drop_first else lv):
            new[f"{c}_{lvl}"] = (F.col(c) == F.lit(lvl)).cast("long")
    return df.withColumns(new)


def one_hot_vectors(df: DataFrame, cols: Sequence[str], drop_first: bool = True, suffix: str = "_vec") -> DataFrame:
    """M2 / M2x on open categories: a sparse vector ``<col>_vec`` for each
    column, with a place for each sorted level (but the first, unless
    ``drop_first=False``), however many there are. Nothing but the number of
    levels reaches the driver. Nulls, and the dropped level, are all zeros."""
    from pyspark.ml.feature import OneHotEncoder
    out, n = df, {}
    for c in cols:
        codes = cut_lineage(level_codes(df, c, f"_{c}_code"))
        n[c] = max(codes.count(), 1)
        out = out.join(codes, c, "left")
    # The encoder drops the last place: move the first level, or nulls, there.
    places = {c: n[c] if drop_first else n[c] + 1 for c in cols}
    code = {c: F.coalesce(F.col(f"_{c}_code"), F.lit(0 if drop_first else n[c])) for c in cols}
    out = out.withColumns({f"_{c}_place": (F.pmod(code[c] - 1, F.lit(places[c])) if drop_first else code[c]).cast("double") for c in cols})
    sizes = df.sparkSession.createDataFrame([tuple(float(places[c] - 1) for c in cols)], ", ".join(f"`_{c}_place` double" for c in cols))
    model = OneHotEncoder(inputCols=[f"_{c}_place" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=True).fit(sizes)
    return model.transform(out).drop(*[f"_{c}_{x}" for c in cols for x in ("code", "place")])


def geo_clusters(df: DataFrame, cols: Sequence[str] = ("latitude", "longitude"), k: int = 12,
                 seed: int = 0, out: str = "cluster") -> DataFrame:
    """M3: k-means label on coordinates (MLlib, distributed Lloyd steps)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    feats = VectorAssembler(inputCols=list(cols), outputCol="_geo").transform(df)
    model = KMeans(k=k, seed=seed, featuresCol="_geo", predictionCol=out).fit(feats)
    return model.transform(feats).drop("_geo").withColumn(out, F.col(out).cast("long"))


def with_fold(df: DataFrame, k: int, key_cols: Sequence[str], out: str = "fold") -> DataFrame:
    """M4: hash fold of the natural key, independent of row order."""
    return df.withColumn(out, fold_of(k, *key_cols))
