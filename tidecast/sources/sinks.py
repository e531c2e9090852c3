"""Sinks (features, predictions, submissions, importances) and the
prediction gatherer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """A folder per set and origin (as far as ``df`` has them). Only folders that ``df`` has rows for
    are replaced, the others stay; later reads prune by them."""
    partition_by = partition_by or [c for c in ("set", "origin_id") if c in df.columns]
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def written_origins(spark: SparkSession, path: str, set_name: str) -> set[int]:
    """Origins of a set that the folder holds (partition folders only)."""
    from pyspark.errors import AnalysisException
    try:
        have = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return set()
        raise
    return {r[0] for r in have.where(F.col("set") == set_name).select("origin_id").distinct().collect()}


def read_features(spark: SparkSession, path: str, set_name: str, origins: Sequence[int] | None = None) -> DataFrame:
    """Features of a set, of some origins only if given (pruned folders)."""
    df = spark.read.parquet(path).where(F.col("set") == set_name)
    return df if origins is None else df.where(F.col("origin_id").isin(*origins))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long-form predictions (model_id, keys, pred), one folder a model."""
    df.write.mode(mode).partitionBy("model_id").parquet(path)


def write_submission(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``id, visitors`` CSV with header."""
    df.select("id", "visitors").write.mode(mode).option("header", True).csv(path)


def write_importance(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature importances."""
    df.write.mode(mode).option("header", True).csv(path)


def gather_predictions(spark: SparkSession, path: str | Mapping[str, str]) -> DataFrame:
    """All predictions of one folder, with ``model_id`` from the partition
    folders; or of several folders, given as model id to folder."""
    if isinstance(path, str):
        return spark.read.parquet(path)
    parts = [spark.read.parquet(p).withColumn("model_id", F.lit(m)) for m, p in path.items()]
    return reduce(DataFrame.unionByName, parts)
