"""Naive first-stage forecasters as plain queries, so that gathering,
correlation, blending and scoring have checkable input.

1 = weekday weighted mean with store fallback, 2 = value seven weeks
earlier falling back to 1, 3 = trailing 50-day mean. All on the log scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.history import by_store, with_fallback
from tidecast.operators.lags import lag_features
from tidecast.operators.origins import OriginSet
from tidecast.operators.trailing import trailing_stats
from tidecast.plans import partitioning
from tidecast.plans.frames import Frames
from tidecast.session import stored

MODELS = (1, 2, 3)
KEYS = ["origin_id", "store_id", "visit_date"]


def naive_history(fr: Frames, oset: OriginSet) -> DataFrame:
    """History that some origin of the set sees, written once: three
    forecasters read it."""
    seen = fr.hist.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
    return stored(seen.select("store_id", "visit_date", "y", "dow", "weight"), "history")


def naive_wide(fr: Frames, oset: OriginSet, targets: DataFrame, hist: DataFrame | None = None) -> DataFrame:
    """(origin_id, store_id, visit_date, flag, y?, pred_1, pred_2, pred_3).
    ``hist``: the ``naive_history`` of a set that sees as much or more."""
    base = targets.select(*KEYS, "cutoff", "dow", "flag", *(["y"] if "y" in targets.columns else []))
    hist = naive_history(fr, oset) if hist is None else hist.where(F.col("visit_date") <= F.lit(oset.history_range(None)[1]))
    # Tasks of the targets follow the targets, of which there are far fewer than
    # facts: as many as the facts need would make the shuffles' blocks grow with
    # the square of the tables. Written once, as four steps read them.
    tasks = fr.tasks
    if fr.fx.n_facts > partitioning.FACTS_PER_TASK:
        base = stored(base, "targets")
        tasks = partitioning.store_partitions(fr.spark, base.count())
    m1 = with_fallback(base.select(*KEYS, "dow"), hist, oset, [("store_id", "dow"), ("store_id",)], median=False,
                       partitions=fr.tasks)
    lag = lag_features(base, hist, {"lag_7w": 49}, oset=oset, partitions=tasks)
    tr = trailing_stats(by_store(hist, tasks), oset, [50], scales=False, aggs=("mean",)).repartition(tasks, "origin_id", "store_id")
    w = (base.repartition(tasks, *KEYS).join(m1.select(*KEYS, "wmean"), KEYS, "left").join(lag, KEYS, "left")
         .join(tr, ["origin_id", "store_id"], "left"))
    return w.select(*KEYS, "flag", *(["y"] if "y" in base.columns else []),
                    F.col("wmean").alias("pred_1"),
                    F.coalesce("lag_7w", "wmean").alias("pred_2"),
                    F.col("mean_50d").alias("pred_3"))


def naive_long(wide: DataFrame) -> DataFrame:
    """Long form (model_id, keys, flag, [y], pred)."""
    extra = ["y"] if "y" in wide.columns else []
    each = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("model_id"), F.col(f"pred_{m}").alias("pred"))
                               for m in MODELS])).alias("p")
    return wide.select(*KEYS, "flag", *extra, each).select("p.model_id", *KEYS, "flag", *extra, "p.pred")
