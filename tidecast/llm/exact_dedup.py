"""Exact deduplication with counting quotient filters.

Every partition builds a counting quotient filter (CQF) of the 64-bit
fingerprints of its texts, cut into blocks by their leading bits. Filters of
one block merge losslessly, as sorted (quotient, remainder) entries whose
counters add up. Fingerprints with a count above one are routed to byte
verification: their texts (and the few that a Bloom filter of those
fingerprints can't tell from them) are grouped by their actual bytes, the
others never leave the scan.

Scale: the filters hold about 8 bytes a text, a copy met again in the same
partition only raises a counter, and byte groups are pre-aggregated before
the shuffle, so a group with a third of all rows is a few rows by then.
Joins by key leave hot keys to the skew handling of adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import normalised, sieve, sifted, store

#: Leading fingerprint bits that name a block; a block is the unit of merging.
BLOCK_BITS = 10
#: Fingerprints gathered before a partition closes a filter (bounds memory).
FLUSH = 1 << 20


def cqf_encode(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """Filter of distinct sorted ``bits``-bit fingerprints and their counts.

    Layout: quotient bits (1 byte), slots and slot bytes (4 + 1), then the
    occupied bit of each quotient, the run-end and counter bits of each slot,
    and the slots. An entry takes one slot for its remainder, and a second,
    marked as counter, if it was seen more than once."""
    q = min(bits - 8, max(1, int(len(fingerprints)).bit_length()))
    r = bits - q
    quotient = (fingerprints >> np.uint64(r)).astype(np.int64)
    remainder = fingerprints & np.uint64((1 << r) - 1)
    width = (r + 7) // 8
    extra = (counts > 1).astype(np.int64)
    at = np.arange(len(fingerprints)) + np.cumsum(extra) - extra
    slots = np.zeros(len(fingerprints) + int(extra.sum()), dtype="<u8")
    slots[at] = remainder
    slots[at[extra > 0] + 1] = counts[extra > 0]
    counter = np.zeros(len(slots), dtype=bool)
    counter[at[extra > 0] + 1] = True
    occupied = np.zeros(1 << q, dtype=bool)
    occupied[quotient] = True
    last = np.append(quotient[1:] != quotient[:-1], True)
    run_end = np.zeros(len(slots), dtype=bool)
    run_end[(at + extra)[last]] = True
    body = slots.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return (bytes([q, width]) + len(slots).to_bytes(4, "little") + np.packbits(occupied).tobytes()
            + np.packbits(run_end).tobytes() + np.packbits(counter).tobytes() + body)


def cqf_decode(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints in order and their counts."""
    q, width, n = data[0], data[1], int.from_bytes(data[2:6], "little")
    raw = np.frombuffer(data, dtype=np.uint8)
    a, b = 6 + ((1 << q) + 7) // 8, (n + 7) // 8
    occupied = np.unpackbits(raw[6:a])[: 1 << q]
    run_end = np.unpackbits(raw[a:a + b])[:n]
    counter = np.unpackbits(raw[a + b:a + 2 * b])[:n].astype(bool)
    slots = np.zeros((n, 8), dtype=np.uint8)
    slots[:, :width] = raw[a + 2 * b:].reshape(n, width)
    slots = slots.view("<u8").ravel()
    run = np.cumsum(run_end) - run_end  # which run a slot is in
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    entry = np.flatnonzero(~counter)
    counts = np.ones(len(entry), dtype=np.int64)
    follows = np.append(counter[1:], False)[entry]
    counts[follows] = slots[entry[follows] + 1].astype(np.int64)
    return (quotient[entry] << np.uint64(bits - q)) | slots[entry], counts


def cqf_merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge entries of several filters by their sorted order, adding counts."""
    keys = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")  # merges the sorted runs
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _filters(fingerprints: np.ndarray, block_bits: int) -> pa.RecordBatch:
    keys, counts = np.unique(fingerprints, return_counts=True)
    bits = 64 - block_bits
    block = (keys >> np.uint64(bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(cuts[1:], len(keys))
    inner = keys & np.uint64((1 << bits) - 1)
    data = [cqf_encode(inner[a:b], counts[a:b], bits) for a, b in zip(cuts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(block[cuts].astype(np.int32)), pa.array(data, pa.binary())], ["block", "filter"])


def repeated_fingerprints(fingerprints: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(fp, n) of every fingerprint that column ``fp`` holds more than once."""
    bits = 64 - block_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            size += batch.num_rows
            if size >= FLUSH:
                yield _filters(np.concatenate(held), block_bits)
                held, size = [], 0
        if size:
            yield _filters(np.concatenate(held), block_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repeated(block, parts):
            keys, counts = cqf_merge(parts)
            hit = counts > 1
            fp = (keys[hit] | np.uint64(block << bits)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(counts[hit])], ["fp", "n"])

        block, parts = None, []
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != block:
                    if parts:
                        yield repeated(block, parts)
                    block, parts = b, []
                parts.append(cqf_decode(data.as_py(), bits))
                if len(parts) > 64:
                    parts = [cqf_merge(parts)]
        if parts:
            yield repeated(block, parts)

    return (fingerprints.select("fp").mapInArrow(build, "block int, filter binary")
            .repartition("block").sortWithinPartitions("block")
            .mapInArrow(merge, "fp bigint, n bigint"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256.

    Texts are equal when identical after every run of blanks became one
    space; null counts as empty. Of equal texts the row with the smallest id
    stays. Null ids lose against any id; where all ids of a group are null,
    keep_id is null and one row stays. Of repeated rows with the id that
    stays, one is kept. Other columns are ignored; no rows give no rows."""
    base = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    keys = store(base.select("doc_id", F.xxhash64("norm").alias("fp"), F.sha2("norm", 256).alias("sha")), "fingerprints")
    repeated = repeated_fingerprints(keys)
    # Texts that the sieve lets through without a copy form groups of one.
    routed = sifted(base, F.xxhash64("norm"), sieve(repeated, F.col("fp")))
    groups = (routed.groupBy("norm").agg(F.min("doc_id").alias("low"), F.count("*").alias("size")).where("size > 1")
              .select(F.sha2("norm", 256).alias("sha"), "low", "size"))
    rows = keys.groupBy("doc_id", "sha").agg(F.count("*").alias("times"))
    joined = rows.join(groups, "sha", "left").select(
        "doc_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"), F.col("sha").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("copy"))
    return joined.select("doc_id", "keep_id", "group_size",
                         (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns."""
    groups = store(exact_groups(docs, id_col, text_col), "groups")
    gone = groups.where(~F.col("kept"))
    lost = gone.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("gone__id"), F.col("text_sha256").alias("gone__sha"))
    sha = F.sha2(normalised(docs[text_col]), 256)
    table = sieve(lost, F.col("gone__sha"))
    left = sifted(docs, sha, table, inside=False).union(sifted(docs, sha, table).join(
        lost.distinct().hint("merge"), docs[id_col].eqNullSafe(F.col("gone__id")) & (sha == F.col("gone__sha")), "left_anti"))
    if gone.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).limit(1).count():  # repeated rows of the id that stays
        left = left.withColumn("text__sha", F.sha2(normalised(F.col(text_col)), 256)).dropDuplicates([id_col, "text__sha"]).drop("text__sha")
    return left
