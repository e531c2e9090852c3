"""Target encodings: from history (A13, J16) and out-of-fold.

Both aggregate to (key level) first and join the small result back, so a
low-cardinality key (a genre holding a third of all rows) never becomes one
window partition or one task: partial aggregation combines it map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Encoding name -> key columns (store attributes, optionally x weekday).
BASE_KEYSETS = {
    "genre_mean": ("genre",),
    "genre_dow_mean": ("genre", "dow"),
    "area_mean": ("area_l3",),
    "area_dow_mean": ("area_l3", "dow"),
}
MORE_KEYSETS = {
    "area_l1_mean": ("area_l1",),
    "area_l1_dow_mean": ("area_l1", "dow"),
    "area_l2_mean": ("area_l2",),
    "area_l2_dow_mean": ("area_l2", "dow"),
}


def target_encode_hist(targets: DataFrame, history: DataFrame,
                       keysets: Mapping[str, Sequence[str]] = BASE_KEYSETS,
                       y: str = "y", by: Sequence[str] = (), broadcast: bool = False) -> DataFrame:
    """Mean of y over the history rows of the same key (history is
    already cut at the origin's cutoff); ``by`` adds e.g. origin_id.
    ``broadcast``: the caller has bounded the number of key levels."""
    out = targets
    for name, cols in keysets.items():
        enc = history.groupBy(*by, *cols).agg(F.avg(y).alias(name))
        out = out.join(F.broadcast(enc) if broadcast else enc, on=[*by, *cols], how="left")
    return out


def target_encode_oof(targets: DataFrame, keysets: Mapping[str, Sequence[str]] = BASE_KEYSETS,
                      y: str = "y", fold: str = "fold", by: Sequence[str] = ("origin_id",),
                      broadcast: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """Each row gets the mean of y over the rows of its key in the
    *other* folds of the same origin: (S_key - S_key,fold) / (N_key -
    N_key,fold), null when the other folds have no row. ``rows``: the same
    rows as ``targets`` before other features were joined on; the sums are
    taken from them, so those joins are not evaluated again."""
    out = targets
    rows = targets if rows is None else rows
    for name, cols in keysets.items():
        per_fold = rows.groupBy(*by, *cols, fold).agg(F.sum(y).alias("_fold_sum"),
                                                      F.count(y).alias("_fold_cnt"))
        tot = per_fold.groupBy(*by, *cols).agg(F.sum("_fold_sum").alias("_key_sum"),
                                               F.sum("_fold_cnt").alias("_key_cnt"))
        rest_n = F.col("_key_cnt") - F.col("_fold_cnt")
        enc = per_fold.join(tot, on=[*by, *cols]).select(
            *by, *cols, fold,
            F.when(rest_n > 0, (F.col("_key_sum") - F.col("_fold_sum")) / rest_n).alias(name))
        out = out.join(F.broadcast(enc) if broadcast else enc, on=[*by, *cols, fold], how="left")
    return out
