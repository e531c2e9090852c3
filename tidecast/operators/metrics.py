"""Scores on the log scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _scored(y: str, pred: str) -> Column:
    return F.col(y).isNotNull() & F.col(pred).isNotNull()


def rmsle(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (),
          count_as: str = "n", unscored_as: str = "n_unscored") -> DataFrame:
    """sqrt(mean((y - pred)^2)) with y and pred already log1p-scaled, over
    the rows that have both; ``unscored_as`` counts the others, and a group of
    only such rows has a null score."""
    return df.groupBy(*by).agg(F.count_if(_scored(y, pred)).alias(count_as),
                               F.count_if(~_scored(y, pred)).alias(unscored_as),
                               F.sqrt(F.avg(F.pow(F.col(y) - F.col(pred), 2))).alias("rmsle"))


def horizon_score(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (),
                  flag: str = "flag", w1: int = 6, w2: int = 33, unscored_as: str = "n_unscored") -> DataFrame:
    """s1, s2 per segment and total (w1*s1 + w2*s2) / (w1 + w2), and the
    rows without a value or prediction, which no score covers."""
    sq = F.pow(F.col(y) - F.col(pred), 2)
    s = df.groupBy(*by).agg(F.sqrt(F.avg(F.when(F.col(flag) == 1, sq))).alias("s1"),
                            F.sqrt(F.avg(F.when(F.col(flag) == 2, sq))).alias("s2"),
                            F.count_if(~_scored(y, pred)).alias(unscored_as))
    return s.withColumn("total", (F.col("s1") * w1 + F.col("s2") * w2) / float(w1 + w2))


def mean_score(scores: DataFrame, col: str = "rmsle", out: str = "mean_rmsle") -> DataFrame:
    """Mean over folds / splits, attached to every row. One window over
    the scores, of which there are as many as folds or splits."""
    return scores.withColumn(out, F.avg(col).over(Window.partitionBy()))
