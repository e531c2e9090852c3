"""Sequence packing with optimal length buckets.

Texts are cut into sequences of at most ``context`` tokens (words, unless a
length column is given). The global histogram of sequence lengths, at most
``context`` numbers, goes to the driver, where dynamic programming finds the
bucket boundaries that minimise padding. Inside each bucket sequences form
batches under a token budget.

Scale: positions inside a bucket come from hash slices: each slice is ranked
by itself and shifted by the sizes of the slices before it. The number of
slices follows the bucket's size, so a bucket with most rows is spread too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidecast.llm.common import store

CONTEXT = 2048
BUCKETS = 16
#: Tokens of a batch, padding included.
BUDGET = 65_536
#: Sequences ranked together.
SLICE = 100_000
BLANK_RUN = r"[^\x20\x09-\x0D]+"


def optimal_buckets(histogram: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets over lengths 0..len - 1 that
    minimise the total padding. Of equal choices the one with the smallest
    earlier ends; the last end is the largest length present."""
    lengths = np.flatnonzero(histogram)
    if not len(lengths):
        return []
    count = histogram[lengths].astype(np.float64)
    many = np.concatenate([[0.0], np.cumsum(count)])
    n, k = len(lengths), min(buckets, len(lengths))
    # Padded tokens of a bucket over lengths i..j - 1: lengths[j - 1] for each
    # of its sequences. (What they hold is the same for every choice.)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    back = np.zeros((k + 1, n + 1), dtype=np.int64)
    for b in range(1, k + 1):
        new = np.full(n + 1, np.inf)
        for j in range(b, n + 1):
            cost = best[:j] + lengths[j - 1] * (many[j] - many[:j])
            i = int(np.argmin(cost))
            new[j], back[b, j] = cost[i], i
        best = new
    ends, j = [], n
    for b in range(k, 0, -1):
        ends.append(int(lengths[j - 1]))
        j = back[b, j]
    return ends[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
         context: int = CONTEXT, buckets: int = BUCKETS, budget: int = BUDGET, slice_rows: int = SLICE,
         group_col: str | None = None) -> DataFrame:
    """One row for each sequence: doc_id, part (from 0), first_token, n_tokens,
    bucket (from 0), bucket_len (its padded length), batch_id and slot (both
    from 0 inside the bucket), batch_size (sequences of a full batch).

    Every token of every row is in exactly one sequence. Null and empty texts
    (or lengths) have no sequences. Ties of ids and repeated rows each get
    their own; null ids are kept. Other columns are ignored. ``budget`` must
    be at least ``context``. With ``group_col`` (its nulls count as ``und``),
    given back as last column, a batch holds rows of one group, and batches are
    numbered inside group and bucket."""
    if budget < context:
        raise ValueError("a batch must hold at least one sequence of full length")
    length = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(BLANK_RUN)) if length_col is None else F.coalesce(F.col(length_col), F.lit(0))
    own = [F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias(group_col)] if group_col else []
    group = [group_col] if group_col else []
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), length.cast("bigint").alias("length"), *own).where("length > 0")
    last = F.col("length") - F.lit(context) * F.col("part")
    pieces = (sized.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / context).cast("bigint"))))
              .select("doc_id", F.col("part").cast("int").alias("part"), (F.col("part") * context).alias("first_token"), F.least(F.lit(context).cast("bigint"), last).alias("n_tokens"), *group))
    pieces = store(pieces, "pieces")
    histogram = np.zeros(context + 1, dtype=np.int64)
    for r in pieces.groupBy("n_tokens").count().collect():  # at most ``context`` rows
        histogram[r["n_tokens"]] = r["count"]
    ends = optimal_buckets(histogram, buckets)
    low = [0, *ends[:-1]]
    table = [(i, int(e), int(histogram[lo + 1:e + 1].sum()), max(1, -(-int(histogram[lo + 1:e + 1].sum()) // slice_rows)))
             for i, (lo, e) in enumerate(zip(low, ends))]
    number = F.lit(0)
    size = F.lit(context)  # no bucket without rows, but the constant is divided by
    slices = F.lit(1)
    for i, e, _, s in reversed(table):  # at most ``buckets`` branches
        inside = F.col("n_tokens") <= e
        number = F.when(inside, F.lit(i)).otherwise(number)
        size = F.when(inside, F.lit(e)).otherwise(size)
        slices = F.when(inside, F.lit(s)).otherwise(slices)
    placed = pieces.select("*", number.alias("bucket"), size.alias("bucket_len"),
                           F.pmod(F.xxhash64("doc_id", "part"), slices).cast("int").alias("slice"))
    before = (placed.groupBy(*group, "bucket", "slice").agg(F.count("*").alias("rows"))
              .select(*group, "bucket", "slice", (F.sum("rows").over(W.partitionBy(*group, "bucket").orderBy("slice")) - F.col("rows")).alias("shift")))
    rank = F.row_number().over(W.partitionBy(*group, "bucket", "slice").orderBy("doc_id", "part", "n_tokens")) - 1
    at = placed.withColumn("rank", rank).join(before, [*group, "bucket", "slice"]).withColumn("at", F.col("rank") + F.col("shift"))
    per = F.floor(F.lit(budget) / F.col("bucket_len")).cast("bigint")
    return at.select("doc_id", "part", "first_token", "n_tokens", "bucket", "bucket_len",
                     F.floor(F.col("at") / per).cast("bigint").alias("batch_id"), (F.col("at") % per).cast("int").alias("slot"), per.cast("int").alias("batch_size"), *group)
