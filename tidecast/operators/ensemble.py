"""Ensembling on long-form predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("store_id", "visit_date")


def pivot_predictions(preds: DataFrame, models: Sequence, keys: Sequence[str] = KEYS,
                      model_col: str = "model_id", pred: str = "pred", prefix: str = "pred_") -> DataFrame:
    """One column per model. Model ids are given, so the pivot needs no
    extra job to find them."""
    wide = preds.groupBy(*keys).pivot(model_col, list(models)).agg(F.first(pred))
    return wide.withColumnsRenamed({str(m): f"{prefix}{m}" for m in models})


def corr_matrix(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair a < b, all in one aggregate."""
    pairs = list(combinations(cols, 2))
    row = wide.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                           F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]))
    return row.select(stacked.alias("p")).select("p.a", "p.b", "p.corr")


def blend(preds: DataFrame, weights: DataFrame, keys: Sequence[str] = KEYS,
          model_col: str = "model_id", pred: str = "pred", out: str = "pred_blend") -> DataFrame:
    """Sum of weight * prediction per key; null unless every weighted
    model has a prediction (as a NaN would propagate). ``weights`` is a
    (model_id, weight) table with one row per model: broadcast."""
    n = weights.agg(F.count(F.lit(1))).scalar()
    j = preds.join(F.broadcast(weights), model_col, "inner")
    return j.groupBy(*keys).agg(
        F.when(F.count(pred) == n, F.sum(F.col("weight") * F.col(pred))).alias(out))


def blends(preds: DataFrame, weights: Mapping[str, Mapping], keys: Sequence[str] = KEYS,
           model_col: str = "model_id", pred: str = "pred") -> DataFrame:
    """M8a for several weightings (output name -> model -> weight) in one
    aggregate; each is null unless all of its models have a prediction."""
    def one(of):
        part = lambda m: F.max(F.when(F.col(model_col) == m, F.col(pred)))
        return sum((part(m) * float(w) for m, w in of.items()), F.lit(0.0))
    return preds.groupBy(*keys).agg(*[one(of).alias(n) for n, of in weights.items()])


def blend2(a: DataFrame, b: DataFrame, col_a: str, col_b: str, alpha: float = 0.7,
           keys: Sequence[str] = KEYS, out: str = "pred_3rd") -> DataFrame:
    """M8b + J12: alpha * a + (1 - alpha) * b after a left join on the keys."""
    j = a.join(b.select(*keys, col_b), list(keys), "left")
    return j.select(*keys, (F.col(col_a) * alpha + F.col(col_b) * (1.0 - alpha)).alias(out))


def weights_table(spark, weights: Mapping) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "model_id long, weight double")

